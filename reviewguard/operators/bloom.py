"""Bloom filter of flagged users as DataFrames (K6-K8).

The filter is the set of bit positions of every flagged user, packed into
one row of 64-bit words. Its size is the parameter ``num_bits`` (not the
data's), which ``size_for`` gets from a number of users and a target error.
A test shifts the words in the row -- no join, no Python UDF and no
driver-side object.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import bloom_positions

# Fixed values of the reference configuration.
NUM_BITS = 10000
NUM_HASHES = 3


def positions(users: DataFrame, user_col: str = "user_id", num_bits: int = NUM_BITS,
              num_hashes: int = NUM_HASHES) -> DataFrame:
    """user, i, pos for every hash i (null users skipped)."""
    u = users.select(user_col).filter(F.col(user_col).isNotNull()).distinct()
    return u.select(user_col, F.posexplode(bloom_positions(F.col(user_col), num_bits, num_hashes))
                    .alias("i", "pos"))


def build(flagged_users: DataFrame, user_col: str = "user_id", num_bits: int = NUM_BITS,
          num_hashes: int = NUM_HASHES) -> DataFrame:
    """Set bit positions (``pos``) of the filter after adding every user."""
    return positions(flagged_users, user_col, num_bits, num_hashes).select("pos").distinct()


def size_for(users: int, error: float) -> tuple[int, int]:
    """(num_bits, num_hashes) of a filter that answers wrongly for at most about
    ``error`` of the users it doesn't hold, once it holds ``users``."""
    if users < 1 or not 0 < error < 1:
        raise ValueError("users must be positive and error between 0 and 1")
    bits = max(64, math.ceil(-users * math.log(error) / math.log(2) ** 2))
    return bits, max(1, round(bits / users * math.log(2)))


def _words(num_bits: int) -> int:
    return (num_bits + 63) // 64


def empty(spark: SparkSession, num_bits: int = NUM_BITS) -> DataFrame:
    """A filter without users: one row ``words`` of zeros."""
    return spark.range(1).select(F.array_repeat(F.lit(0).cast("long"), _words(num_bits)).alias("words"))


def packed(bit_positions: DataFrame, num_bits: int = NUM_BITS) -> DataFrame:
    """The filter as one row ``words``: array<bigint>, bit p % 64 of word p / 64 set for every position p."""
    per_word = bit_positions.groupBy((F.col("pos") / 64).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(pos % 64 AS INT))")).alias("bits"))
    one = per_word.agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("m"))
    return one.select(F.transform(F.sequence(F.lit(0), F.lit(_words(num_bits) - 1)),
                                  lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0).cast("long"))).alias("words"))


def either(a: DataFrame, b: DataFrame) -> DataFrame:
    """The union of two filters of one size."""
    both = a.select("words").unionByName(b.select("words")).select(F.posexplode("words").alias("word", "bits"))
    joined = both.groupBy("word").agg(F.bit_or("bits").alias("bits"))
    return joined.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda s: s["bits"]).alias("words"))


def might_contain(df: DataFrame, filter_row: DataFrame, user_col: str = "user_id",
                  out_col: str = "bloom_seen_before", num_bits: int = NUM_BITS,
                  num_hashes: int = NUM_HASHES) -> DataFrame:
    """Adds ``out_col`` = 1 when every position of the row's user is set; null user -> 0.

    The packed filter (``num_bits`` / 8 bytes, a parameter) is a scalar of the plan; each row tests its
    own positions by shifts, so neither rows nor positions are shuffled."""
    rows = df.withColumn("_words", filter_row.select("words").scalar())
    hit = F.forall(bloom_positions(F.col(user_col), num_bits, num_hashes),
                   lambda p: F.call_function("getbit", F.get("_words", (p / 64).cast("int")), (p % 64).cast("int")) == 1)
    return rows.withColumn(out_col, F.coalesce(hit, F.lit(False)).cast("int")).drop("_words")


def flag_users(windows: DataFrame, flag_col: str = "suspicious_user_flag") -> DataFrame:
    """Users added to the filter: v2 adds suspicious users, v1 bursting ones."""
    return windows.filter(F.col(flag_col) == 1).select("user_id")
