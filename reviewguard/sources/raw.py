"""Raw-corpus views of the given tables (for the standardising operators),
each with its SQL twin. Every row of the source table is kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table


def raw_marketplace_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as a marketplace dump: reviewerID, asin, overall (text, some
    unparsable), title (some blank), text, unixReviewTime (seconds)."""
    d = read_table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("_ord"),
        F.concat(F.lit("u"), (F.col("doc_id") % 150).cast("string")).alias("reviewerID"),
        F.col("source").alias("asin"),
        F.when(F.col("doc_id") % 23 == 0, F.lit("x")).otherwise(((F.col("doc_id") % 5) + 1).cast("string"))
        .alias("overall"),
        F.when(F.col("doc_id") % 7 == 0, F.lit("   ")).otherwise(F.col("lang")).alias("title"),
        F.col("text").alias("text"),
        (F.lit(1704067200) + F.col("doc_id") * 3600).cast("string").alias("unixReviewTime"),
    )


RAW_MARKETPLACE_DOCS_SQL = """raw_m AS (
  SELECT doc_id AS _ord, 'u' || CAST(doc_id % 150 AS VARCHAR) AS reviewerID, source AS asin,
         CASE WHEN doc_id % 23 = 0 THEN 'x' ELSE CAST(doc_id % 5 + 1 AS VARCHAR) END AS overall,
         CASE WHEN doc_id % 7 = 0 THEN '   ' ELSE lang END AS title, text,
         CAST(1704067200 + doc_id * 3600 AS VARCHAR) AS unixReviewTime
  FROM documents)"""


def raw_marketplace_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a marketplace dump with an epoch-millisecond ``timestamp``."""
    e = read_table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("_ord"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("user_id"),
        F.concat(F.lit("p"), F.get_json_object("props", "$.k")).alias("parent_asin"),
        F.col("value").cast("string").alias("rating"),
        F.concat_ws(" ", F.col("event_type"), F.lit("&amp;"), F.col("props"), F.lit("<b>"),
                    F.col("user_id").cast("string")).alias("text"),
        F.unix_millis(F.col("ts").cast("timestamp")).cast("string").alias("timestamp"),
    )


RAW_MARKETPLACE_EVENTS_SQL = """raw_e AS (
  SELECT event_id AS _ord, 'u' || CAST(user_id AS VARCHAR) AS user_id,
         'p' || json_extract_string(props, '$.k') AS parent_asin, CAST(value AS VARCHAR) AS rating,
         concat_ws(' ', event_type, '&amp;', props, '<b>', CAST(user_id AS VARCHAR)) AS text,
         CAST(epoch_us(ts) // 1000 AS VARCHAR) AS timestamp
  FROM events)"""


def raw_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """labelled documents as a deceptive-opinion CSV: deceptive (mixed case
    words), hotel (padded, upper case), text."""
    d = read_table(spark, sf_dir, "documents")
    lab = read_table(spark, sf_dir, "labels")
    j = d.join(lab, "doc_id")
    return j.select(
        F.col("doc_id").alias("_ord"),
        F.when(F.col("toxic") == 1, F.lit(" Deceptive")).otherwise(F.lit("TRUTHFUL ")).alias("deceptive"),
        F.concat(F.lit("  "), F.upper("source"), F.lit(" ")).alias("hotel"),
        F.col("text").alias("text"),
    )


RAW_LABELLED_SQL = """raw_l AS (
  SELECT d.doc_id AS _ord, CASE WHEN l.toxic = 1 THEN ' Deceptive' ELSE 'TRUTHFUL ' END AS deceptive,
         '  ' || upper(d.source) || ' ' AS hotel, d.text AS text
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


#: Layouts of the review times below, by doc_id mod 8; the last one is no time.
TIME_LAYOUTS = ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "MM d, yyyy", "MM dd, yyyy", "MM/dd/yyyy", "MMM d, yyyy", "d MMM yyyy"]


def raw_marketplace_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The marketplace dump of documents with free-text review times (``reviewTime``) of many layouts."""
    day = F.date_add(F.to_date(F.lit("2023-03-05")), (F.col("_ord") % 400).cast("int"))
    text = F.lit("some day")
    for i, layout in enumerate(TIME_LAYOUTS):
        text = F.when(F.col("_ord") % 8 == i, F.date_format(day, layout)).otherwise(text)
    return raw_marketplace_docs(spark, sf_dir).withColumn("reviewTime", text).drop("unixReviewTime")


def raw_labelled_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled documents with a text ``timestamp``, some of them blank."""
    t = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("_ord") * 61)
    return raw_labelled(spark, sf_dir).withColumn("timestamp", F.when(F.col("_ord") % 9 == 0, F.lit(" ")).otherwise(F.date_format(t, "yyyy-MM-dd HH:mm:ss")))


def raw_label_words(spark: SparkSession, sf_dir: str, column: str = "label") -> DataFrame:
    """labels with a text label column cycling through label words, numbers
    and an unknown word."""
    lab = read_table(spark, sf_dir, "labels")
    words = LABEL_WORD_CYCLE if column == "label" else ALT_WORD_CYCLE
    arr = F.array(*[F.lit(w) for w in words])
    v = F.get(arr, (F.col("doc_id") % len(words)).cast("int"))
    v = F.when(v == "#", F.col("toxic").cast("string")).otherwise(v)
    return lab.select("doc_id", v.alias(column))


LABEL_WORD_CYCLE = ["deceptive", " Truthful", "FAKE ", "real", "spam", "Ham", "neg", "pos", "#", "unknown", " 0 "]
ALT_WORD_CYCLE = ["deceptive", "truthful", "TRUE", "false", "yes", " No", "#", "maybe"]


def raw_label_words_sql(column: str = "label") -> str:
    words = LABEL_WORD_CYCLE if column == "label" else ALT_WORD_CYCLE
    cases = " ".join(f"WHEN {i} THEN " + ("CAST(toxic AS VARCHAR)" if w == "#" else "'" + w + "'")
                     for i, w in enumerate(words))
    return f"""raw_w AS (SELECT doc_id, CASE doc_id % {len(words)} {cases} END AS {column} FROM labels)"""
