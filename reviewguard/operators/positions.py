"""Global positions in an ordered stream, without a single-task window.

An un-partitioned ``row_number()`` moves every row into one task. Here the
rows are range-partitioned on (key, order...) -- the range partitioner
samples the order key, so even one key holding a third of all rows is cut
into many partitions -- and checkpointed to the shared checkpoint folder
(stable partitions, lineage cut). Per (partition, key) blocks are counted;
their prefix sums give each block its offset. A row's position is the
offset of its block plus its rank inside the block, which comes from the
partition-local row number of ``monotonically_increasing_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint

LOCAL_BITS = 33  # monotonically_increasing_id = partition << 33 | row-in-partition


def _local_index() -> F.Column:
    return F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), LOCAL_BITS)


def ones_with_positions(df: DataFrame, key: str, order: list[str], bit: str,
                        num_partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Returns ``(ones, totals)``.

    ``ones``: one row per 1-bit: key, ``pos`` (1-based position among all
    events of the key, in order) and ``one_idx`` (1-based index among the
    key's ones). ``totals``: key, ``events``, ``ones``.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    s = (df.select(key, *order, F.col(bit).cast("int").alias("_bit"))
         .repartitionByRange(n, key, *order).sortWithinPartitions(key, *order))
    s = checkpoint(s)
    s = s.withColumn("_pid", F.spark_partition_id()).withColumn("_loc", _local_index())
    # partition-local index among ones only: taken after the filter
    ones = (s.filter(F.col("_bit") == 1).select(key, "_pid", "_loc")
            .withColumn("_oloc", _local_index()))
    blocks = s.groupBy("_pid", key).agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_bit").alias("_n1"), F.min("_loc").alias("_loc0"))
    w = Window.partitionBy(key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (blocks.withColumn("_ev_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
              .withColumn("_one_off", F.coalesce(F.sum("_n1").over(w), F.lit(0))))
    oblocks = ones.groupBy("_pid", key).agg(F.min("_oloc").alias("_oloc0"))
    b = blocks.join(oblocks, ["_pid", key], "left")
    positioned = ones.join(b.select("_pid", key, "_ev_off", "_one_off", "_loc0", "_oloc0"), ["_pid", key])
    out = positioned.select(
        key,
        (F.col("_ev_off") + F.col("_loc") - F.col("_loc0") + 1).alias("pos"),
        (F.col("_one_off") + F.col("_oloc") - F.col("_oloc0") + 1).alias("one_idx"),
    )
    totals = blocks.groupBy(key).agg(F.sum("_n").alias("events"), F.sum("_n1").alias("ones"))
    return out, totals


def row_positions(df: DataFrame, order: list[str], key: list[str] | None = None,
                  out_col: str = "pos", num_partitions: int | None = None) -> DataFrame:
    """``df`` plus a 1-based position in ``order`` (within ``key`` when
    given), computed like :func:`ones_with_positions`: range partitioning,
    a checkpoint, per-block prefix sums joined back (the block table has at
    most partitions + keys rows)."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = key or []
    sort_cols = [*key, *order]
    s = checkpoint(df.repartitionByRange(n, *sort_cols).sortWithinPartitions(*sort_cols))
    s = s.withColumn("_pid", F.spark_partition_id()).withColumn("_loc", _local_index())
    blocks = s.groupBy("_pid", *key).agg(F.count(F.lit(1)).alias("_n"), F.min("_loc").alias("_loc0"))
    w = Window.partitionBy(*key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1) if key \
        else Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    out = s.join(blocks.select("_pid", *key, "_off", "_loc0"), ["_pid", *key])
    return out.withColumn(out_col, F.col("_off") + F.col("_loc") - F.col("_loc0") + 1).drop(
        "_pid", "_loc", "_off", "_loc0")
