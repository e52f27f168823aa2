"""Helpers of the operators: hand-off tables, text chunks, salted joins, components."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewguard.session import ensure_checkpoint_dir

#: Words: runs of anything but space and the five control blanks.
WORD = r"[^\x20\x09-\x0D]+"


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"


BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Whole texts go to Python in batches of BATCH_ROWS rows at most, so that a batch of long ones fits a worker."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "10000")) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    This cuts the lineage: a lost executor costs a reread, not the work before."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stage_path = path
    return out


def forget(df: DataFrame) -> None:
    """Delete the table that ``saved`` wrote for ``df``."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._stage_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def packed(docs: DataFrame, **computed: Column) -> DataFrame:
    """``docs`` as one column, ``row`` (a struct of all its columns), beside computed ones: no column name can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[v.alias(k) for k, v in computed.items()])


def unpacked(rows: DataFrame, names: list[str], **computed: Column) -> DataFrame:
    """The columns ``names`` out of ``row``; ``computed`` ones replace those of their name, or follow."""
    return rows.select(*[F.col("row").getField(c).alias(c) for c in names if c not in computed], *[v.alias(k) for k, v in computed.items()])


def text_chunks(column: pa.Array, limit: int = 4 << 20):
    """Cut a string column into runs of whole texts of about ``limit`` bytes.

    Yields (first row, last row + 1, bytes as uint8, offsets from 0). A null text
    is empty; one text above the limit is a run of its own."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if not n:
        return
    raw = column.buffers()
    offs = np.frombuffer(raw[1], np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(raw[2], np.uint8) if raw[2] is not None and raw[2].size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        yield lo, hi, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


def merged(facts: DataFrame) -> DataFrame:
    """A side that is never broadcast: a table of small numbers is a fraction on disk of what it takes on the driver, and
    rows that are made after its size was measured (copies for salts) aren't in that size."""
    return facts.hint("merge")


def components(n: int, a: np.ndarray, b: np.ndarray, lab: np.ndarray | None = None) -> np.ndarray:
    """Labels 0..n-1 of the connected parts of the links a-b: the smallest index reached.

    ``lab`` holds labels from earlier links; they are joined further."""
    lab = np.arange(n) if lab is None else lab
    a, b = lab[a], lab[b]
    while True:
        m = a != b
        if not m.any():
            return lab
        a, b = a[m], b[m]
        np.minimum.at(lab, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = lab[lab]
            if (up == lab).all():
                break
            lab = up
        a, b = lab[a], lab[b]


SALTS = 16


def connected(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """Connected parts of a link table: (node, component) with component the smallest node id reached.

    Alternating large-star and small-star rounds, each a partial-aggregated
    minimum and one salted join, so a hub never meets one task. Every round is
    a written table; the one before is deleted. Nodes without a link don't come
    back. An empty link table gives an empty result."""
    a, b = F.col(src).cast("long"), F.col(dst).cast("long")
    now = saved(edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "star")
    check = None
    while True:
        got = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if (got.n, got.s) == check or not got.n:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        check = (got.n, got.s)
        low = now.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        # large star: what is above u moves to the least neighbour of u
        large = _salted_left(now, "b", low).select("a", F.coalesce("m", "b").alias("b")).union(low.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()
        low = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        # small star: what is below u moves to the least of them
        small = _salted_left(large, "a", low).where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            low.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()
        new = saved(small, "star")
        forget(now)
        now = new


def _salted_left(rows: DataFrame, key: str, facts: DataFrame) -> DataFrame:
    """``rows`` left-joined with one fact row per key; rows of a key spread over SALTS tasks."""
    salted = rows.withColumn("_s", F.pmod(F.xxhash64("a", "b"), F.lit(SALTS)))
    spread = facts.select(F.col("u").alias(key), "m", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("_s"))
    return salted.join(merged(spread), [key, "_s"], "left")
