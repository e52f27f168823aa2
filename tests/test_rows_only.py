"""Contents of the registered queries that have no SQL twin."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from reviewguard.operators import anomaly as An
from reviewguard.operators import augment as A
from reviewguard.operators import reports as R
from reviewguard.sources.tables import reviews_ev

PAIR = ["review_id_left", "review_id_right", "jaccard_distance"]


def _rows(df, cols):
    return {tuple(r) for r in df.select(*cols).collect()}


def test_user_windows_approx(built):
    key = ["user_id", "window_start", "low_rating_reviews_by_user_5m"]
    exact = {tuple(r)[:3]: r.distinct_products for r in built("user_windows_1d").select(*key, "distinct_products").collect()}
    got = {tuple(r)[:3]: r.distinct_products for r in built("user_windows_approx").select(*key, "distinct_products").collect()}
    assert got.keys() == exact.keys() and all(abs(got[k] - n) <= max(1, 0.15 * n) for k, n in exact.items())


def test_neardup_candidates_are_exact_pairs_with_recall(built):
    exact = _rows(built("neardup_exact"), PAIR)
    for name in ("neardup_lsh", "neardup_mllib"):
        got = _rows(built(name), PAIR)
        assert got <= exact and len(got) >= 0.95 * len(exact), name


def test_inject_spam_and_counts(spark, built):
    src = {r.review_id: r for r in reviews_ev(spark, SF_SMALL).collect()}
    rows = built("inject_spam").collect()
    changed = [r for r in rows if r != src[r.review_id]]
    assert len(rows) == len(src) and all(r.source == "synthetic_spam" and r.review_text in A.NEGATIVE_TEMPLATES and r.rating in A.INJECTED_RATINGS for r in changed)
    assert abs(len(changed) / len(rows) - 0.12) < 0.04
    n = built("augment_counts").collect()
    assert len(n) == 1 and n[0].asDict() == A.counts(A.valid_records(A.inject_spam(reviews_ev(spark, SF_SMALL), rate=0.12, seed=42))).first().asDict()


def test_anomaly_queries(built):
    scores = built("anomaly_scores").collect()
    top, report = built("anomaly_top20").collect(), {r["class"]: r for r in built("anomaly_report").collect()}
    assert all((r.anomaly_score < 0) == (r.predicted_suspicious == 1) for r in scores)
    share = sum(r.predicted_suspicious for r in scores) / len(scores)
    spam = sum(r.source_spam_label for r in scores) / len(scores)
    assert abs(share - min(max(spam, 0.05), 0.2)) < 0.02
    order = [r.anomaly_score for r in top]
    assert len(top) == 20 and order == sorted(order) and order[0] == min(r.anomaly_score for r in scores)
    assert set(An.FEATURES) <= set(top[0].asDict())
    hit = sum(r.predicted_suspicious == r.source_spam_label for r in scores) / len(scores)
    assert abs(report["accuracy"].f1 - hit) < 1e-6 and report["accuracy"].support == len(scores)


def test_correlation_of_pairs_with_nulls_and_constants(spark):
    import numpy as np
    import pandas as pd
    r = np.random.default_rng(1)
    x = pd.DataFrame({"a": r.normal(size=300), "b": 1e9 + r.normal(size=300), "c": np.full(300, 0.1), "d": r.integers(0, 5, 300).astype(float)})
    x["e"] = x.a * 2 + r.normal(size=300) * 0.1
    x.loc[::7, "d"] = np.nan
    df = spark.createDataFrame(x.astype(object).where(x.notna(), None).values.tolist(), "a double, b double, c double, d double, e double").repartition(5)
    want = x.corr()
    for row in R.correlation(df).collect():
        w = want.loc[row.a, row.b]
        assert row["corr"] is None if np.isnan(w) or "c" in (row.a, row.b) else abs(row["corr"] - w) < 2e-6, (row, w)
    assert R.correlation(df).count() == 10 and R.correlation(df.select("a")).count() == 0
    assert R.correlation(df.limit(0)).filter(F.col("corr").isNotNull()).count() == 0
