"""What the queries shuffle, store and send to the driver, and that rows stay the same (findings of round 4)."""

import itertools
import random
import uuid

import numpy as np
from pyspark.sql import functions as F

from reviewguard.llm import common
from reviewguard.operators import graph as G
from reviewguard.operators import neardup as N
from reviewguard.operators import overlap as O
from reviewguard.session import scratch_path
from reviewguard.streaming import neardup_index

COLS = "review_id string, user_id string, product_id string, rating double, review_text string"


def _texts(rng, n=60):
    words = [f"w{i}" for i in range(200)]
    base = [" ".join(rng.choice(words) for _ in range(rng.randint(20, 80))) for _ in range(n)]
    texts = base + [" ".join(t.split()[1:] + ["tail"]) for t in base] + base[:5] * 2
    return [(f"r{i:03d}", f"u{i % 7}", "p", 1.0, t) for i, t in enumerate(texts)]


def _brute(rows, most=0.3):
    sets = {}
    for r in rows:
        t = r[4].split()
        sets[r[0]] = {tuple(t[i:i + 3]) for i in range(len(t) - 2)}
    pairs = {(a, b): 1.0 - len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a, b in itertools.combinations(sorted(sets), 2)}
    return {k: d for k, d in pairs.items() if d < most}


def test_side_that_grows_is_not_broadcast_to_the_driver(spark):
    """the copies for salts are made after a side's size is measured."""
    edges = spark.createDataFrame([(2, 1), (3, 2)], "a long, b long")
    low = edges.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    plan = common._salted_left(edges, "a", low)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_stream_stores_no_sets_and_no_whole_shingle_lists(spark):
    """an index row holds the prefix only, sets are made again from texts."""
    rows = _texts(random.Random(2))
    root = scratch_path(spark, f"index-{uuid.uuid4().hex}")
    df = spark.createDataFrame(rows, COLS).withColumn("event_time", F.lit("2024-01-01").cast("timestamp_ntz"))
    for batch in range(2):
        neardup_index.add(df.filter(F.pmod(F.substring("review_id", 2, 3).cast("int"), F.lit(2)) == batch), root, batch)
    stored = spark.read.parquet(f"{root}/texts").collect()
    assert all(len(r["keys"]) < 0.35 * r.n_shingles + 2 and "sh_hash" not in r for r in stored)
    got = {}
    for batch in range(2):
        for r in neardup_index.pairs(spark, root, batch).collect():
            assert got.setdefault((r.review_id_left, r.review_id_right), r.jaccard_distance) == r.jaccard_distance
    want = _brute(rows)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_mllib_pairs_are_those_of_the_similarity_join(spark):
    """the rows that approxSimilarityJoin and the verification leave, found without joining all rows on single hashes."""
    from pyspark.ml.feature import HashingTF, MinHashLSH, NGram

    prep = N.prepare(spark.createDataFrame(_texts(random.Random(3)), COLS))
    ng = NGram(n=3, inputCol="tokens", outputCol="grams").transform(prep.withColumn("tokens", N.tokens("clean_review_text")))
    feat = HashingTF(inputCol="grams", outputCol="features", numFeatures=10000, binary=True).transform(ng).select("review_id", "features").localCheckpoint()
    model = MinHashLSH(inputCol="features", outputCol="hashes", numHashTables=3, seed=42).fit(feat)
    j = model.approxSimilarityJoin(feat, feat, 0.3, distCol="d").filter("datasetA.review_id < datasetB.review_id")
    near = _brute(_texts(random.Random(3)))
    want = {(r.a, r.b) for r in j.select(F.col("datasetA.review_id").alias("a"), F.col("datasetB.review_id").alias("b")).collect()} & near.keys()
    out = N.pairs_mllib(None, prepared=prep)
    assert len(want) > 20 and {(r.review_id_left, r.review_id_right) for r in out.collect()} == want
    assert "datasetA" not in out._jdf.queryExecution().logical().toString()


def test_user_pairs_shuffle_no_pair(spark):
    """pairs come out of tiles, counted."""
    rng = random.Random(4)
    held = {f"u{i}": set(rng.sample(range(30), rng.randint(0, 6))) for i in range(60)}
    edges = spark.createDataFrame([(u, f"p{x}") for u, s in held.items() for x in s], "user_id string, product_id string")
    want = {(a, b): len(held[a] & held[b]) for a, b in itertools.combinations(sorted(held), 2) if held[a] & held[b]}
    for chunk in (7, 4096):
        out = G.user_pairs(edges, chunk=chunk)
        assert "Join" not in out._jdf.queryExecution().logical().toString()
        got = [(r.user1, r.user2, r.common_products) for r in out.collect()]
        assert len(got) == len(want) and {(a, b): c for a, b, c in got} == want


def test_tile_pairs_dense_and_sparse_agree(monkeypatch):
    import pyarrow as pa

    r = np.random.default_rng(5)
    a, b = (pa.chunked_array([pa.array([r.choice(40, r.integers(0, 9), replace=False).tolist() for _ in range(90)], pa.list_(pa.int32()))]) for _ in "ab")
    want = {(i, j): n for i, x in enumerate(a.to_pylist()) for j, y in enumerate(b.to_pylist()) if (n := len({*x} & {*y}))}
    for dense in (0, 4096):
        monkeypatch.setattr(O, "DENSE", dense)
        got = [t for i, j, c in O.tile_pairs(a, b) for t in zip(i.tolist(), j.tolist(), c.tolist())]
        assert len(got) == len(want) and {(i, j): c for i, j, c in got} == want


def test_exact_pairs_write_prefixes_only(spark, monkeypatch):
    """neither whole sets nor texts are written, whatever the order of shingles was measured on."""
    rows = _texts(random.Random(6))
    want = _brute(rows)
    df = spark.createDataFrame(rows, COLS)
    source = N._source(df, N.V2, None)
    for sample in (16_384, 10):
        monkeypatch.setattr(N, "SAMPLE", sample)
        levels, behind = N._levels(df, source)
        index = N._index(N.with_keys(source(), levels, N.least(N.V2)))
        assert "sh_hash" not in index.columns and "clean_review_text" not in index.columns
        assert all(len(r["keys"]) < 0.35 * r.n_shingles + 2 for r in index.collect())
        for chunk in (2, 4096):
            got = {(r.review_id_left, r.review_id_right): r.jaccard_distance for r in N.pairs_exact(df, chunk=chunk).collect()}
            assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
