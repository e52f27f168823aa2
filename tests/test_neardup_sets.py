import itertools
import random

from reviewguard.operators import neardup as N
from test_graph_neardup import _shingles

COLS = "review_id string, user_id string, product_id string, rating double, review_text string"


def _rows(rng):
    words = [f"w{i}" for i in range(40)]
    base = [" ".join(rng.choice(words) for _ in range(rng.randint(3, 30))) for _ in range(25)]
    texts = base + [t + " tail" for t in base] + base[:3] * 8 + ["the same line here", None, " "]
    return [(f"r{i:03d}", f"u{i % 7}", "p", 1.0, t) for i, t in enumerate(texts)]


def test_copies_are_one_set_and_come_back_as_pairs(spark):
    rows = _rows(random.Random(4))
    df = spark.createDataFrame(rows, COLS)
    sets = {r[0]: _shingles(r[4]) for r in rows if r[4] and r[4].strip()}
    want = {}
    for a, b in itertools.combinations(sorted(k for k in sets if sets[k]), 2):
        d = 1.0 - len(sets[a] & sets[b]) / len(sets[a] | sets[b])
        if d < 0.3:
            want[a, b] = d
    got = {(r.review_id_left, r.review_id_right): r.jaccard_distance for r in N.pairs_exact(df, chunk=5).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    assert N._sets(N.prepare(df)).count() == len({frozenset(s) for s in sets.values() if s})
    assert {(r.review_id_left, r.review_id_right) for r in N.pairs_minhash(df).collect()} <= want.keys()


def test_texts_are_cleaned_and_split_once(spark):
    df = spark.createDataFrame(_rows(random.Random(5)), COLS)
    for made in (N.prepare(df, materialize=False, text=False), N.funnel(df)):
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("regexp_replace(") == 1 and plan.count("split(") == 1
