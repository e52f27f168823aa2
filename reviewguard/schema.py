"""Declared schemas (no inference anywhere)."""

from pyspark.sql.types import (
    ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
    TimestampType,
)

# Standardised review row (output of cleaning, input of replay and graphs).
REVIEW_STANDARD = StructType([
    StructField("review_id", StringType()),
    StructField("user_id", StringType()),
    StructField("product_id", StringType()),
    StructField("rating", DoubleType()),
    StructField("review_text", StringType()),
    StructField("timestamp", StringType()),
    StructField("label", DoubleType()),
    StructField("source", StringType()),
])

REVIEW_COLUMNS = [f.name for f in REVIEW_STANDARD.fields]

# Wire event: JSON text read with this schema; label arrives as string.
REVIEW_WIRE = StructType([
    StructField("review_id", StringType()),
    StructField("user_id", StringType()),
    StructField("product_id", StringType()),
    StructField("rating", DoubleType()),
    StructField("review_text", StringType()),
    StructField("timestamp", StringType()),
    StructField("label", StringType()),
    StructField("source", StringType()),
])

USER_WINDOW_MEASURES = [
    "low_rating_reviews_by_user_5m", "distinct_products", "num_products_in_window",
    "burst_detected", "suspicious_user_flag", "source_spam_label",
]

DGIM_BUCKET = StructType([StructField("size", LongType()), StructField("end", LongType())])

USER_GRAPH_FEATURES = [
    "num_windows", "num_suspicious_windows", "num_total_targeted_products",
    "num_suspicious_products_targeted", "max_products_in_one_window", "avg_products_per_window",
    "has_multiple_suspicious_windows", "num_other_users_shared_products",
    "max_common_products_with_any_user",
]

# Raw marketplace rows: every alternate column name, all as text.
RAW_MARKETPLACE = StructType([StructField(c, StringType()) for c in (
    "user_id", "reviewerID", "parent_asin", "asin", "rating", "overall", "title", "text",
    "reviewText", "review_text", "timestamp", "unixReviewTime", "reviewTime")])

__all__ = [
    "REVIEW_STANDARD", "REVIEW_COLUMNS", "REVIEW_WIRE", "USER_WINDOW_MEASURES", "DGIM_BUCKET",
    "USER_GRAPH_FEATURES", "RAW_MARKETPLACE", "ArrayType", "IntegerType", "TimestampType",
]
