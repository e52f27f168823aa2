"""File sources: review corpora, labelled text trees, feature batches
(A2-A7). Schemas are always declared; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..schema import RAW_MARKETPLACE


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.globStatus(hpath)) and len(fs.globStatus(hpath)) > 0


def first_available(spark: SparkSession, paths: list[str]) -> str:
    """First path (or glob) the cluster file system can see."""
    for p in paths:
        if _exists(spark, p):
            return p
    raise FileNotFoundError(f"none of {paths} exists")


def _csv_by_header(spark: SparkSession, path: str, schema: StructType, multiline: bool = True) -> DataFrame:
    """CSV columns bound by the header's names, in whatever order the file has
    them. Quoted fields may hold doubled quotes and, with ``multiline``, newlines;
    a file is then read by one task. Without it files are split like any text. Files of one path share a header; another one is an
    error, not a shift of columns."""
    def opened():
        return spark.read.option("header", True).option("multiLine", multiline).option("escape", '"')
    header = opened().csv(path).columns
    text = StructType([StructField(c, StringType()) for c in header])
    df = opened().option("enforceSchema", False).schema(text).csv(path)
    cols = [F.col(f"`{f.name}`") if f.name in header else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields]
    return df.select(*cols, F.col("_metadata.file_path").alias("_file"))


def read_reviews(spark: SparkSession, path: str, schema: StructType = RAW_MARKETPLACE,
                 fmt: str | None = None, multiline: bool = True) -> DataFrame:
    """JSON lines (gzip by extension) or CSV with a header (columns by name),
    with every alternate column of the declared all-text schema; columns the
    file lacks are null, to be dropped by :func:`present_columns` so that the
    first-present rule sees the file's own columns only. Adds ``_file`` and
    ``_row`` (file order) for stable row numbers."""
    fmt = fmt or ("csv" if path.lower().endswith((".csv", ".csv.gz")) else "json")
    if fmt == "csv":
        df = _csv_by_header(spark, path, schema, multiline)
    else:
        df = spark.read.schema(schema).json(path).withColumn("_file", F.col("_metadata.file_path"))
    return df.withColumn("_row", F.monotonically_increasing_id())


def present_columns(df: DataFrame, candidates: list[str]) -> DataFrame:
    """Drop declared columns that are null in every row (absent in the file).
    One aggregate job; bounded output (one flag per column)."""
    flags = df.agg(*[F.max(F.col(c).isNotNull().cast("int")).alias(c) for c in candidates]).first()
    keep = [c for c in df.columns if c not in candidates or (flags[c] or 0) == 1]
    return df.select(*keep)


LABELLED_TEXT = StructType([StructField("value", StringType())])


def read_labelled_text_tree(spark: SparkSession, root: str, positive: str = "deceptive",
                            negative: str = "truthful") -> DataFrame:
    """One review per ``*.txt`` anywhere under ``root``; label 1 when the
    path contains ``positive``, 0 when it contains ``negative``, other files
    skipped. Invalid UTF-8 is replaced, text trimmed."""
    df = (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt")
          .option("wholetext", True).text(root)
          .select(F.col("value"), F.col("_metadata.file_path").alias("source_path")))
    low = F.lower("source_path")
    label = F.when(low.contains(positive), 1).when(low.contains(negative), 0)
    return (df.select(F.regexp_replace("value", r"^\s+|\s+$", "").alias("text"), label.alias("label"),
                      "source_path").filter(F.col("label").isNotNull()))


def read_feature_batches(spark: SparkSession, root: str, fmt: str = "parquet",
                         schema: StructType | None = None) -> DataFrame:
    """All per-batch folders ``<root>/batch_id=<n>/`` unioned, with
    ``batch_id`` from the folder name (partition discovery)."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        return r.option("header", True).csv(root)
    return r.parquet(root)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.option("header", True).csv(path) if fmt == "csv" else r.format(fmt).load(path)
