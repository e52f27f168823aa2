"""Reading the given tables and adapting them to the review schema.

The adapters keep every row of the source table; each one has an SQL twin
(a CTE text for the DuckDB oracle) right next to it.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import REVIEW_COLUMNS

TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def reviews_ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> reviews: one review per event.

    product = props.k, rating = min(5, 1 + floor(value / 15)), the ``error``
    events play the injected spam (source ``synthetic_spam``).
    """
    return events_as_reviews(read_table(spark, sf_dir, "events"))


def events_as_reviews(ev: DataFrame) -> DataFrame:
    """The events -> reviews projection (works on batch and streaming frames)."""
    return ev.select(
        F.concat(F.lit("r"), F.col("event_id").cast("string")).alias("review_id"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("user_id"),
        F.concat(F.lit("p"), F.get_json_object("props", "$.k")).alias("product_id"),
        F.least(F.lit(5), F.floor(F.col("value") / 15) + 1).cast("double").alias("rating"),
        F.concat(F.lit("event "), F.col("event_type")).alias("review_text"),
        F.date_format("ts", TS_FORMAT).alias("timestamp"),
        F.lit(None).cast("double").alias("label"),
        F.when(F.col("event_type") == "error", "synthetic_spam").otherwise("amazon").alias("source"),
    )


REVIEWS_EV_SQL = """reviews_ev AS (
  SELECT 'r' || CAST(event_id AS VARCHAR) AS review_id,
         'u' || CAST(user_id AS VARCHAR) AS user_id,
         'p' || json_extract_string(props, '$.k') AS product_id,
         CAST(least(5, floor(value / 15) + 1) AS DOUBLE) AS rating,
         'event ' || event_type AS review_text,
         strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS timestamp,
         CAST(NULL AS DOUBLE) AS label,
         CASE WHEN event_type = 'error' THEN 'synthetic_spam' ELSE 'amazon' END AS source
  FROM events)"""


def reviews_doc(spark: SparkSession, sf_dir: str, n_users: int = 150) -> DataFrame:
    """documents (+ labels.toxic) -> reviews with real text."""
    return documents_as_reviews(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def documents_as_reviews(docs: DataFrame, labels: DataFrame, n_users: int = 150) -> DataFrame:
    """documents (batch or stream) left join labels (static) -> reviews."""
    labels = labels.select("doc_id", "toxic")
    return docs.join(labels, "doc_id", "left").select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("review_id"),
        F.concat(F.lit("u"), F.pmod(F.col("doc_id"), F.lit(n_users)).cast("string")).alias("user_id"),
        F.col("source").alias("product_id"),
        (F.pmod(F.col("doc_id"), F.lit(5)) + 1).cast("double").alias("rating"),
        F.col("text").alias("review_text"),
        F.date_format(F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") * 60), TS_FORMAT)
        .alias("timestamp"),
        F.col("toxic").cast("double").alias("label"),
        F.lit("amazon").alias("source"),
    )


REVIEWS_DOC_SQL = """reviews_doc AS (
  SELECT 'd' || CAST(d.doc_id AS VARCHAR) AS review_id,
         'u' || CAST(d.doc_id % 150 AS VARCHAR) AS user_id,
         d.source AS product_id,
         CAST(d.doc_id % 5 + 1 AS DOUBLE) AS rating,
         d.text AS review_text,
         strftime(make_timestamp((1704067200 + d.doc_id * 60) * 1000000), '%Y-%m-%d %H:%M:%S.%g') AS timestamp,
         CAST(l.toxic AS DOUBLE) AS label,
         'amazon' AS source
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def reviews_li(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem x orders -> reviews: customer reviews part, rating from quantity.

    (l_orderkey, l_linenumber) is not unique in the given tables, so the
    review id also carries the part and supplier keys; duplicates that remain
    are kept (they are separate rows).
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select(
        F.concat_ws("_", F.lit("li"), F.col("l_orderkey").cast("string"),
                    F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"),
                    F.col("l_suppkey").cast("string")).alias("review_id"),
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("user_id"),
        F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("product_id"),
        F.least(F.lit(5), F.ceil(F.col("l_quantity") / 10)).cast("double").alias("rating"),
        F.lit(None).cast("string").alias("review_text"),
        F.date_format("l_shipdate", TS_FORMAT).alias("timestamp"),
        F.lit(None).cast("double").alias("label"),
        F.lit("tpch").alias("source"),
    ).select(*REVIEW_COLUMNS)


REVIEWS_LI_SQL = """reviews_li AS (
  SELECT 'li_' || CAST(l.l_orderkey AS VARCHAR) || '_' || CAST(l.l_linenumber AS VARCHAR) || '_'
             || CAST(l.l_partkey AS VARCHAR) || '_' || CAST(l.l_suppkey AS VARCHAR) AS review_id,
         'c' || CAST(o.o_custkey AS VARCHAR) AS user_id,
         'p' || CAST(l.l_partkey AS VARCHAR) AS product_id,
         CAST(least(5, ceil(l.l_quantity / 10)) AS DOUBLE) AS rating,
         CAST(NULL AS VARCHAR) AS review_text,
         strftime(l.l_shipdate, '%Y-%m-%d %H:%M:%S.%g') AS timestamp,
         CAST(NULL AS DOUBLE) AS label,
         'tpch' AS source
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""
