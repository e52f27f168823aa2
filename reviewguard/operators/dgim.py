"""DGIM sketch of the count of low ratings among the last K events (K1-K5).

The bucket layout the insert-and-merge procedure reaches after n ones is a
function of n alone: with L = floor(log2(n + 1)) and m = n - (2^L - 1),
level j < L holds 1 + bit_j(m) buckets of size 2^j, newest first. The
newest one of a bucket has c = (2^j - 1) + (m mod 2^j) + k * 2^j newer
ones (k = 0 or 1), and the bucket's end time is that one's position. So a
whole stream (or a batch appended to one) becomes: positions of the ones
(distributed, see ``positions``), a tiny per-key bucket table from n, and
an equi-join picking the O(log n) positions the buckets need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .positions import ones_with_positions

# Fixed values of the reference configuration.
DGIM_K = 100
DGIM_BURST_THRESHOLD = 30
DGIM_LOW_CUT = 2.0


def bits(df: DataFrame, rating_col: str = "rating", low_cut: float = DGIM_LOW_CUT) -> DataFrame:
    """1 for a low rating, 0 otherwise (null rating -> 0)."""
    return df.withColumn("bit", F.coalesce(F.col(rating_col) <= F.lit(low_cut), F.lit(False)).cast("int"))


def _levels(n: F.Column) -> F.Column:
    # floor(log2(n + 1)) without floating point
    return F.length(F.bin(n + 1)) - 1


def bucket_layout(totals: DataFrame, key: str) -> DataFrame:
    """key, size, c (ones newer than the bucket's newest one), one_idx of
    that newest one (1-based from the oldest)."""
    t = totals.filter(F.col("ones") > 0).withColumn("_L", _levels(F.col("ones")))
    t = t.withColumn("_m", F.col("ones") - (F.expr("shiftleft(1L, _L)") - 1))
    lv = t.select(key, "events", "ones", "_m", F.explode(F.sequence(F.lit(0), F.col("_L") - 1)).alias("j"))
    p = F.expr("shiftleft(1L, j)")
    lv = lv.withColumn("_cnt", F.lit(1) + (F.expr("shiftright(_m, j)") % 2).cast("int"))
    lv = lv.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("_cnt") - 1)))
    return lv.select(
        key, "events", "ones", p.alias("size"),
        ((p - 1) + (F.col("_m") % p) + F.col("k") * p).alias("c"),
    ).withColumn("one_idx", F.col("ones") - F.col("c"))


def buckets(df: DataFrame, key: str = "stream_key", order: list[str] | None = None,
            bit_col: str = "bit") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Returns (bucket rows: key, size, end, c, events), totals, ones-with-positions."""
    order = order or ["event_time", "review_id"]
    ones, totals = ones_with_positions(df, key, order, bit_col)
    lay = bucket_layout(totals, key)
    b = lay.join(ones.select(key, "one_idx", F.col("pos").alias("end")), [key, "one_idx"])
    return b.select(key, "size", "end", "c", "events"), totals, ones


def estimate(bucket_rows: DataFrame, totals: DataFrame, key: str = "stream_key", k: int = DGIM_K,
             threshold: int = DGIM_BURST_THRESHOLD, textbook: bool = False) -> DataFrame:
    """Estimated ones among the last k events, per key.

    reference form: buckets ending inside the window count in full, the
    first bucket ending outside it adds half its size (integer halving).
    textbook form: buckets inside count in full except the oldest inside
    one, which counts half (integer halving)."""
    b = bucket_rows.join(totals.select(key, "events"), [key, "events"]) if "events" not in bucket_rows.columns \
        else bucket_rows
    inside = F.col("end") > F.col("events") - k
    agg = b.groupBy(key).agg(
        F.sum(F.when(inside, F.col("size")).otherwise(0)).alias("_in"),
        F.min(F.when(~inside, F.struct(F.col("c"), F.col("size")))).alias("_first_out"),
        F.max(F.when(inside, F.struct(F.col("c"), F.col("size")))).alias("_oldest_in"),
    )
    if textbook:
        est = F.col("_in") - F.coalesce(F.floor(F.col("_oldest_in.size") / 2), F.lit(0))
    else:
        est = F.col("_in") + F.coalesce(F.floor(F.col("_first_out.size") / 2), F.lit(0))
    out = totals.join(agg, key, "left").select(
        key, "events", "ones", F.coalesce(est, F.lit(0)).cast("long").alias("approx_low"))
    return out.withColumn("dgim_burst_flag", (F.col("approx_low") >= threshold).cast("int"))


def exact_last_k(ones: DataFrame, totals: DataFrame, key: str = "stream_key", k: int = DGIM_K) -> DataFrame:
    """Exact ones among the last k events (for error reporting)."""
    recent = (ones.join(totals.select(key, "events"), key)
              .filter(F.col("pos") > F.col("events") - k)
              .groupBy(key).agg(F.count(F.lit(1)).alias("_x")))
    return totals.join(recent, key, "left").select(
        key, "events", "ones", F.coalesce("_x", F.lit(0)).cast("long").alias("exact_low"))


def bucket_arrays(bucket_rows: DataFrame, key: str = "stream_key") -> DataFrame:
    """Bucket listing per key as array<struct<size,end>>, newest first."""
    return bucket_rows.groupBy(key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(F.col("c"), F.col("size"), F.col("end")))),
                    lambda s: F.struct(s["size"].alias("size"), s["end"].alias("end"))).alias("buckets"))
