"""Self-join of rows sharing a key, with hot keys split over many tasks.

A plain equi self-join on ``key`` processes every key in one task, so a
key holding a third of all rows would put its d^2 pairs into one task.
Here each key's rows are bucketed into k = ceil(d / chunk) buckets on
the left side and the right side is replicated over the k buckets; the
join key is (key, bucket), so a hot key's pairs are produced by k tasks of
at most ``chunk`` x d pairs each, while keys below ``chunk`` rows keep
k = 1 (no replication). The degree table has one row per key and is
joined like any other table (broadcast only when Spark measures it small).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_CHUNK = 4096


def max_key_degree(df: DataFrame, key: str) -> int:
    """Largest number of rows of one key (one aggregate, one number back)."""
    v = df.groupBy(key).agg(F.count(F.lit(1)).alias("_d")).agg(F.max("_d")).first()[0]
    return int(v or 0)


def salted_self_pairs(df: DataFrame, key: str, item: str, payload: list[str] | None = None,
                      chunk: int = DEFAULT_CHUNK, ordered: bool = True, max_degree: int | None = None) -> DataFrame:
    """Rows (key, a, b, <payload>_a, <payload>_b) for every pair of rows
    with the same ``key`` and a < b (``ordered``) or a != b.

    ``max_degree`` (the largest key size, or an upper bound of it) picks
    the plan: when no key exceeds ``chunk`` the plain equi self-join runs
    (no degree table, no replication); otherwise hot keys are bucketed.
    When not given it is measured with one aggregate."""
    payload = payload or []
    cols = [key, item, *payload]
    if max_degree is None:
        max_degree = max_key_degree(df, key)
    cond = F.col(f"{item}_a") < F.col(f"{item}_b") if ordered else F.col(f"{item}_a") != F.col(f"{item}_b")
    if max_degree <= chunk:
        l = df.select(F.col(key), *[F.col(c).alias(f"{c}_a") for c in [item, *payload]])
        r = df.select(F.col(key), *[F.col(c).alias(f"{c}_b") for c in [item, *payload]])
        return l.join(r, key).filter(cond).withColumnRenamed(f"{item}_a", "a").withColumnRenamed(f"{item}_b", "b")
    deg = df.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / F.lit(chunk)).cast("int").alias("_k"))
    d = df.select(*cols).join(deg, key)
    left = d.withColumn("_b", F.pmod(F.xxhash64(F.col(item)), F.col("_k")).cast("int"))
    right = d.withColumn("_b", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
    l = left.select(F.col(key), F.col("_b"), *[F.col(c).alias(f"{c}_a") for c in [item, *payload]])
    r = right.select(F.col(key), F.col("_b"), *[F.col(c).alias(f"{c}_b") for c in [item, *payload]])
    return l.join(r, [key, "_b"]).filter(cond).drop("_b").withColumnRenamed(f"{item}_a", "a").withColumnRenamed(
        f"{item}_b", "b")
