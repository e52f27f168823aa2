"""Step 6: feature merge, risk score, metrics, reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..operators import features as Fe
from ..operators import graph as G
from ..operators import metrics as M
from ..operators import reports as Rp
from ..operators import risk as Rk
from ..operators import sketches as S
from ..operators import windows as W
from ..schema import USER_GRAPH_FEATURES
from ..session import checkpoint
from .q_graph import FEATURES_SQL_BODY, FEATURES_SQL_SELECT, SPLIT_TS, UPSERT_CTES
from .q_windows import DAY, events_stream, uw_ctes
from .registry import query, with_ctes

MEASURES = ["low_rating_reviews_by_user_5m", "distinct_products", "num_products_in_window", "burst_detected",
            "suspicious_user_flag", "source_spam_label"]


def _text_times(uw):
    return uw.select(*[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if c in ("window_start", "window_end")
                       else F.col(c) for c in uw.columns])


def merged(spark, sf_dir):
    """features_for_ml: daily user windows (+ graph features), one batch."""
    uw = checkpoint(W.user_windows(events_stream(spark, sf_dir), DAY))
    g = G.window_graph(uw)
    uf = G.user_features(g["review_windows"], g["targeted_product"])
    sf = Fe.spark_features(_text_times(uw).withColumn("batch_id", F.lit(0)))
    return Fe.merge(sf, uf)


def scored(spark, sf_dir):
    """Risk-scored features. The merged feature table is a stage boundary:
    it is checkpointed to the shared checkpoint folder, so the score's
    column-wide min/max and every report read it instead of re-running
    the window and graph jobs."""
    return Rk.score(checkpoint(merged(spark, sf_dir)))


MERGED_CTES = ["\n" + ",\n".join(uw_ctes(86400)) + FEATURES_SQL_BODY + ", gf AS (" + FEATURES_SQL_SELECT + ")",
               """merged AS (
  SELECT w.user_id, w.window_start, w.window_end, w.low_rating_reviews_by_user_5m, w.distinct_products,
         w.num_products_in_window, w.burst_detected, w.suspicious_user_flag, w.source_spam_label,
         """ + ",\n         ".join(f"coalesce(gf.{c}, 0.0) AS {c}" for c in USER_GRAPH_FEATURES) + """
  FROM uw w LEFT JOIN gf USING (user_id))"""]


def _norm(c):
    return f"(coalesce(CAST({c} AS DOUBLE), 0.0) - mn_{c}) / (mx_{c} - mn_{c} + 1e-9)"


RISK_CTES = MERGED_CTES + ["mm AS (SELECT " + ", ".join(
    f"min(coalesce(CAST({c} AS DOUBLE), 0.0)) AS mn_{c}, max(coalesce(CAST({c} AS DOUBLE), 0.0)) AS mx_{c}"
    for c in Rk.RISK_FEATURES) + " FROM merged)", """sc0 AS (
  SELECT merged.*, (""" + " + ".join(_norm(c) for c in Rk.RISK_FEATURES) + f""") / {float(len(Rk.RISK_FEATURES))} AS risk_score
  FROM merged, mm)""", """scored AS (
  SELECT *, CASE WHEN risk_score >= 0.75 THEN 'High' WHEN risk_score >= 0.45 THEN 'Medium' ELSE 'Low' END AS risk_level,
         CAST(risk_score >= 0.55 AS INTEGER) AS predicted_suspicious FROM sc0)"""]


def risk_sql(body: str) -> str:
    """Statement over the ``scored`` CTE; a body that starts with "," first
    adds CTEs of its own."""
    return "WITH " + ",\n".join(RISK_CTES) + "\n" + body.lstrip("\n")


@query("feature_latest", with_ctes(*UPSERT_CTES, body="""
SELECT user_id, window_start, window_end, low_rating_reviews_by_user_5m, distinct_products, num_products_in_window,
       CAST(CASE WHEN low_rating_reviews_by_user_5m >= 3 THEN 1 ELSE 0 END AS INTEGER) AS burst_detected,
       CAST(CASE WHEN low_rating_reviews_by_user_5m >= 3 OR distinct_products >= 3 THEN 1 ELSE 0 END AS INTEGER) AS suspicious_user_flag,
       source_spam_label
FROM latest"""))
def q_feature_latest(spark, sf_dir):
    ev = events_stream(spark, sf_dir)
    b0 = W.user_windows(ev.filter(F.col("timestamp") < SPLIT_TS), DAY).withColumn("batch_id", F.lit(0))
    b1 = W.user_windows(ev.filter(F.col("timestamp") >= SPLIT_TS), DAY).withColumn("batch_id", F.lit(1))
    return Fe.spark_features(_text_times(b0.unionByName(b1)))


@query("merged_features", "WITH " + ",\n".join(MERGED_CTES) + "\nSELECT * FROM merged")
def q_merged_features(spark, sf_dir):
    return merged(spark, sf_dir)


@query("risk_scores", risk_sql("SELECT user_id, window_start, window_end, risk_score, risk_level, predicted_suspicious FROM scored"))
def q_risk_scores(spark, sf_dir):
    return scored(spark, sf_dir).select("user_id", "window_start", "window_end", "risk_score", "risk_level",
                                        "predicted_suspicious")


@query("risk_flagged", risk_sql("""SELECT user_id, window_start, risk_score, risk_level FROM scored
WHERE risk_score >= 0.55 AND risk_level IN ('High', 'Medium')"""))
def q_risk_flagged(spark, sf_dir):
    return Rk.flagged(scored(spark, sf_dir), 0.55, ("High", "Medium")).select(
        "user_id", "window_start", "risk_score", "risk_level")


@query("kpis", risk_sql("""SELECT count(*) AS total_records,
       count(*) FILTER (WHERE risk_score >= 0.55) AS flagged_records,
       count(*) FILTER (WHERE risk_level = 'High') AS high_risk,
       count(*) FILTER (WHERE risk_level = 'Medium') AS medium_risk,
       round(avg(risk_score), 6) AS avg_risk_score,
       CAST(sum(burst_detected) AS BIGINT) AS burst_records FROM scored"""))
def q_kpis(spark, sf_dir):
    k = Rp.kpis(scored(spark, sf_dir), 0.55)
    return k.withColumn("avg_risk_score", F.round("avg_risk_score", 6))


@query("risk_histogram", risk_sql(""", hb AS (SELECT min(risk_score) AS lo, max(risk_score) AS hi FROM scored)
SELECT CAST(CASE WHEN (hi - lo) / 40 > 0 THEN least(floor((risk_score - lo) / ((hi - lo) / 40)), 39) ELSE 0 END AS INTEGER) AS bin,
       risk_level, count(*) AS count,
       lo + CAST(CASE WHEN (hi - lo) / 40 > 0 THEN least(floor((risk_score - lo) / ((hi - lo) / 40)), 39) ELSE 0 END AS INTEGER) * ((hi - lo) / 40) AS bin_start,
       lo + (CAST(CASE WHEN (hi - lo) / 40 > 0 THEN least(floor((risk_score - lo) / ((hi - lo) / 40)), 39) ELSE 0 END AS INTEGER) + 1) * ((hi - lo) / 40) AS bin_end
FROM scored, hb WHERE risk_score IS NOT NULL GROUP BY ALL"""))
def q_risk_histogram(spark, sf_dir):
    return Rp.histogram(scored(spark, sf_dir), "risk_score", "risk_level", 40)


@query("level_freq", risk_sql("""SELECT 'risk_level' AS "column", risk_level AS value, count(*) AS count FROM scored GROUP BY 2
UNION ALL SELECT 'source_spam_label', CAST(source_spam_label AS VARCHAR), count(*) FROM scored GROUP BY 2
UNION ALL SELECT 'predicted_suspicious', CAST(predicted_suspicious AS VARCHAR), count(*) FROM scored GROUP BY 2"""))
def q_level_freq(spark, sf_dir):
    s = scored(spark, sf_dir)
    parts = [M.freq(s, c).select(F.lit(c).alias("column"), F.col("value").cast("string").alias("value"), "count")
             for c in ("risk_level", "source_spam_label", "predicted_suspicious")]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("level_means", risk_sql("SELECT risk_level, " + ", ".join(
    f"round(avg({c}), 6) AS {c}" for c in Rp.GRAPH_COLS) + " FROM scored GROUP BY risk_level"))
def q_level_means(spark, sf_dir):
    m = Rp.level_means(scored(spark, sf_dir))
    return m.select("risk_level", *[F.round(c, 6).alias(c) for c in Rp.GRAPH_COLS])


@query("box_stats", risk_sql("""SELECT risk_level, mn AS min, q[1] AS q1, q[2] AS median, q[3] AS q3, mx AS max FROM (
  SELECT risk_level, min(CAST(low_rating_reviews_by_user_5m AS DOUBLE)) AS mn,
         quantile_cont(CAST(low_rating_reviews_by_user_5m AS DOUBLE), [0.25, 0.5, 0.75]) AS q,
         max(CAST(low_rating_reviews_by_user_5m AS DOUBLE)) AS mx
  FROM scored GROUP BY risk_level)"""))
def q_box_stats(spark, sf_dir):
    return Rp.box(scored(spark, sf_dir), "low_rating_reviews_by_user_5m")


@query("box_stats_sketch", risk_sql("""SELECT risk_level, count(*) AS rows, true AS q1_ok, true AS median_ok, true AS q3_ok,
       min(CAST(low_rating_reviews_by_user_5m AS DOUBLE)) AS min, max(CAST(low_rating_reviews_by_user_5m AS DOUBLE)) AS max
FROM scored GROUP BY risk_level"""))
def q_box_stats_sketch(spark, sf_dir):
    """Box statistics out of daily KLL sketches, merged per level; the quartiles' ranks are checked on the rows."""
    df, col = checkpoint(scored(spark, sf_dir)), "low_rating_reviews_by_user_5m"
    days = checkpoint(S.value_sketches(df, col, ("risk_level", "window_start")))
    boxes = S.box(S.merge_values(days, ("risk_level",)), ("risk_level",))
    return Rp.rank_check(df, boxes, col).join(boxes.select("risk_level", "min", "max"), "risk_level")


CORR_COLS = MEASURES + USER_GRAPH_FEATURES + ["risk_score", "predicted_suspicious"]


def _corr_sql():
    from itertools import combinations
    parts = [f"SELECT '{a}' AS a, '{b}' AS b, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS c FROM scored"
             for a, b in combinations(CORR_COLS, 2)]
    return risk_sql("SELECT a, b, CASE WHEN isnan(c) THEN NULL ELSE round(c, 6) END AS corr FROM (\n"
                    + "\nUNION ALL ".join(parts) + ")")


@query("correlation", _corr_sql())
def q_correlation(spark, sf_dir):
    return Rp.correlation(scored(spark, sf_dir), CORR_COLS)


CONF_SQL = """SELECT count(*) FILTER (WHERE p = 0 AND a = 0) AS tn, count(*) FILTER (WHERE p = 1 AND a = 0) AS fp,
       count(*) FILTER (WHERE p = 0 AND a = 1) AS fn, count(*) FILTER (WHERE p = 1 AND a = 1) AS tp
FROM (SELECT CAST(risk_score >= 0.55 AS INTEGER) AS p, CAST(coalesce(source_spam_label, 0) AS INTEGER) AS a FROM scored)"""


@query("confusion", risk_sql(CONF_SQL))
def q_confusion(spark, sf_dir):
    return M.confusion(scored(spark, sf_dir), threshold=0.55)


@query("prf", risk_sql(f"""SELECT tn, fp, fn, tp, precision, recall,
       2 * precision * recall / (precision + recall + 1e-9) AS f1 FROM (
  SELECT tn, fp, fn, tp, tp / (tp + fp + 1e-9) AS precision, tp / (tp + fn + 1e-9) AS recall FROM ({CONF_SQL}))"""))
def q_prf(spark, sf_dir):
    return M.prf(M.confusion(scored(spark, sf_dir), threshold=0.55))


@query("class_report", risk_sql("""
, cells AS (SELECT CAST(source_spam_label AS INTEGER) AS y, predicted_suspicious AS p, count(*) AS n FROM scored GROUP BY 1, 2)
, cls AS (SELECT y AS c FROM cells UNION SELECT p FROM cells)
, t AS (SELECT c, sum(CASE WHEN y = c AND p = c THEN n ELSE 0 END) AS tp, sum(CASE WHEN y = c THEN n ELSE 0 END) AS support,
              sum(CASE WHEN p = c THEN n ELSE 0 END) AS predicted FROM cls, cells GROUP BY c)
, per AS (SELECT CAST(c AS VARCHAR) AS class, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
                 CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall, support, tp FROM t)
, per2 AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM per)
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM per2
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM per2
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM per2
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
          round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM per2"""))
def q_class_report(spark, sf_dir):
    r = M.class_report(scored(spark, sf_dir), "source_spam_label", "predicted_suspicious")
    return r.select("class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")],
                    F.col("support").cast("long").alias("support"))


ORDER = "ORDER BY risk_score DESC, user_id, window_start"


@query("alerts", risk_sql(f"""SELECT user_id, window_start, risk_score, risk_level,
       CASE risk_level WHEN 'High' THEN '{Rp.ALERT_TEXT['High']}' WHEN 'Medium' THEN '{Rp.ALERT_TEXT['Medium']}' END AS alert
FROM (SELECT * FROM scored {ORDER} LIMIT 15) WHERE risk_level IN ('High', 'Medium')"""))
def q_alerts(spark, sf_dir):
    return Rp.alerts(scored(spark, sf_dir), 15)


@query("top_risk", risk_sql("SELECT user_id, window_start, risk_score, risk_level, " + ", ".join(Rk.RISK_FEATURES)
                            + f" FROM scored {ORDER} LIMIT 20"))
def q_top_risk(spark, sf_dir):
    return Rp.top(scored(spark, sf_dir), 20)


@query("explore", risk_sql(f"SELECT user_id, window_start, window_end, risk_score, risk_level FROM scored {ORDER}"))
def q_explore(spark, sf_dir):
    return Rp.explore(scored(spark, sf_dir), ["user_id", "window_start", "window_end", "risk_score", "risk_level"])


@query("scatter", risk_sql("""SELECT user_id, window_start, num_other_users_shared_products AS x, risk_score AS y, risk_level
FROM scored"""))
def q_scatter(spark, sf_dir):
    return Rp.scatter(scored(spark, sf_dir), "num_other_users_shared_products")
