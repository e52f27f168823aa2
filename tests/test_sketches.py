import hashlib
import random

import pytest

from pyspark.sql import functions as F

from reviewguard.operators import bloom as B
from reviewguard.operators import dgim as D


def step_dgim(bit_list):
    """Insert ones one at a time; whenever a size has three buckets, the two
    oldest of them become one bucket of twice the size that keeps the newer
    end. Returns (events, [(size, end)] newest first)."""
    levels = {}  # size -> list of ends, newest first
    t = 0
    for bit in bit_list:
        t += 1
        if not bit:
            continue
        size, carry = 1, t
        while True:
            ends = levels.setdefault(size, [])
            ends.insert(0, carry)
            if len(ends) < 3:
                break
            older = ends.pop()
            newer = ends.pop()
            del older
            size, carry = size * 2, newer
    out = [(s, e) for s, ends in levels.items() for e in ends]
    return t, sorted(out, key=lambda x: -x[1])


def ref_estimate(t, bks, k):
    total = 0
    for s, e in bks:
        if e > t - k:
            total += s
        else:
            total += s // 2
            break
    return total


def test_dgim_closed_form_matches_step_procedure(spark):
    rng = random.Random(7)
    rows, expect = [], {}
    for key in range(40):
        n = rng.randint(0, 400)
        p = rng.random()
        bl = [1 if rng.random() < p else 0 for _ in range(n)]
        for i, b in enumerate(bl):
            rows.append((f"k{key}", i, f"r{i:05d}", b))
        expect[f"k{key}"] = (bl, step_dgim(bl))
    df = spark.createDataFrame(rows, "stream_key string, event_time long, review_id string, bit int")
    b, tot, ones = D.buckets(df, "stream_key", ["event_time", "review_id"], "bit")
    got = {}
    for r in b.collect():
        got.setdefault(r.stream_key, []).append((r.size, r.end))
    est = {r.stream_key: r.approx_low for r in D.estimate(b, tot, k=100).collect()}
    ex = {r.stream_key: r.exact_low for r in D.exact_last_k(ones, tot, k=100).collect()}
    for key, (bl, (t, bks)) in expect.items():
        assert sorted(got.get(key, []), key=lambda x: -x[1]) == bks, key
        if t:
            assert est.get(key, 0) == ref_estimate(t, bks, 100), key
            assert ex.get(key, 0) == sum(bl[-100:]), key


def test_dgim_textbook_error_bound(spark):
    rng = random.Random(3)
    rows, exact = [], {}
    for key in range(20):
        bl = [1 if rng.random() < 0.4 else 0 for _ in range(rng.randint(150, 600))]
        rows += [(f"k{key}", i, str(i), b) for i, b in enumerate(bl)]
        exact[f"k{key}"] = sum(bl[-100:])
    df = spark.createDataFrame(rows, "stream_key string, event_time long, review_id string, bit int")
    b, tot, _ = D.buckets(df)
    for r in D.estimate(b, tot, k=100, textbook=True).collect():
        x = exact[r.stream_key]
        assert abs(r.approx_low - x) <= 0.5 * x + 1


def py_positions(item, m=10000, k=3):
    return [int(hashlib.md5(f"{item}_{i}".encode()).hexdigest(), 16) % m for i in range(k)]


def test_bloom_positions_equal_hashlib(spark):
    ids = ["u1", "u150", "user_spam_7", "Ünïcödé", "", "x" * 200]
    df = spark.createDataFrame([(i,) for i in ids], "user_id string")
    got = {}
    for r in B.positions(df).collect():
        got.setdefault(r.user_id, {})[r.i] = r.pos
    for i in ids:
        assert [got[i][j] for j in range(3)] == py_positions(i)


def test_bloom_no_false_negatives_and_null(spark):
    users = [f"user{i}" for i in range(300)]
    df = spark.createDataFrame([(u, 1 if n % 3 == 0 else 0) for n, u in enumerate(users)] + [(None, 1)],
                               "user_id string, flagged int")
    bits = B.build(df.filter("flagged = 1"))
    out = B.might_contain(df, B.packed(bits)).collect()
    for r in out:
        if r.user_id is None:
            assert r.bloom_seen_before == 0
        elif r.flagged == 1:
            assert r.bloom_seen_before == 1
    py_bits = {p for n, u in enumerate(users) if n % 3 == 0 for p in py_positions(u)}
    assert {r.pos for r in bits.collect()} == py_bits
    words = B.packed(bits).first().words
    assert len(words) == 157 and {p for p in range(157 * 64) if (words[p // 64] >> (p % 64)) & 1} == py_bits


def test_bloom_sized_by_target_error(spark):
    m, k = B.size_for(2000, 0.01)
    inside = spark.range(2000).select(F.concat(F.lit("in"), "id").alias("user_id"))
    outside = spark.range(20_000).select(F.concat(F.lit("out"), "id").alias("user_id"))
    words = B.packed(B.build(inside, num_bits=m, num_hashes=k), m)
    hits = [B.might_contain(x, words, num_bits=m, num_hashes=k).agg(F.avg("bloom_seen_before")).first()[0] for x in (inside, outside)]
    assert hits[0] == 1.0 and hits[1] < 0.015
    both = B.either(B.packed(B.build(inside.limit(10))), B.packed(B.build(outside.limit(10))))
    probe = inside.limit(10).union(outside.limit(10))
    assert B.might_contain(probe, both).agg(F.min("bloom_seen_before")).first()[0] == 1
    assert B.might_contain(probe, B.empty(spark)).agg(F.max("bloom_seen_before")).first()[0] == 0
    plan = B.might_contain(probe, both)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan.split("Subquery")[0] if "Subquery" in plan else "Join" not in plan
    with pytest.raises(ValueError):
        B.size_for(0, 0.1)


def test_merged_distinct_sketches_keep_their_error_bound(spark):
    """Hour sketches of 48 hours merged to days and to one: within 5 % (3 standard errors) of the exact counts; small counts exact."""
    from reviewguard.operators import sketches as S
    rows = spark.range(300_000).select(
        F.timestamp_seconds(F.lit(1704067200) + F.pmod(F.xxhash64("id"), F.lit(172_800))).cast("timestamp_ntz").alias("event_time"),
        F.when(F.col("id") % 50 == 0, "small").otherwise("big").alias("user_id"),
        F.when(F.col("id") % 50 == 0, F.concat(F.lit("p"), F.col("id") % 70)).otherwise(F.concat(F.lit("q"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(60_000)))).alias("product_id"))
    hours = S.product_sketches(rows)
    assert hours.count() == 96
    for duration, size in (("1 day", 4), (None, 2)):
        merged = S.distinct_products(S.merge_products(hours, duration)).collect()
        by = ["user_id"] if duration is None else [F.window("event_time", duration).start.alias("window_start"), "user_id"]
        exact = {tuple(r)[:-2]: (r.n, r.d) for r in rows.groupBy(*by).agg(F.count("*").alias("n"), F.count_distinct("product_id").alias("d")).collect()}
        assert len(merged) == size == len(exact)
        for r in merged:
            n, d = exact[(r.user_id,) if duration is None else (r.window_start, r.user_id)]
            assert r.reviews == n and (r.distinct_products == d if r.user_id == "small" else abs(r.distinct_products / d - 1) < 0.05)


def test_merged_quantile_sketches_keep_their_rank_error(spark):
    from reviewguard.operators import reports as R
    from reviewguard.operators import sketches as S
    rows = spark.range(200_000).select(F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("risk_level"), (F.col("id") % 64).alias("part"),
                                       F.expr("CASE WHEN id % 97 = 0 THEN NULL ELSE exp(pmod(xxhash64(id), 10000) / 1000.0) END").alias("x"))
    boxes = S.box(S.merge_values(S.value_sketches(rows, "x", ("risk_level", "part")), ("risk_level",)), ("risk_level",))
    got = R.rank_check(rows, boxes, "x").collect()
    assert len(got) == 2 and all(r.q1_ok and r.median_ok and r.q3_ok for r in got)
    exact, box = ({r.risk_level: r for r in df.collect()} for df in (R.box(rows, "x"), boxes))
    assert all(box[k]["min"] == exact[k]["min"] and box[k]["max"] == exact[k]["max"] for k in exact)
    wrong = boxes.withColumn("median", F.col("q3"))
    assert not any(r.median_ok for r in R.rank_check(rows, wrong, "x").collect())
