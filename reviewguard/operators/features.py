"""Feature hand-off: latest window rows, merge with graph features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import NumericType

from .dedupe import keep_max

KEY = ["user_id", "window_start", "window_end"]
SPARK_FEATURES = KEY + ["low_rating_reviews_by_user_5m", "distinct_products", "num_products_in_window",
                        "burst_detected", "suspicious_user_flag", "source_spam_label"]


def require(df: DataFrame, cols: list[str]) -> DataFrame:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required feature columns: {missing}")
    return df


def latest(batches: DataFrame, batch_col: str = "batch_id", key: list[str] = KEY) -> DataFrame:
    """One row per key: the row of the highest batch id (a replayed or stale
    batch never wins over a newer one)."""
    return keep_max(batches, key, [batch_col])


def spark_features(batches: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    require(batches, SPARK_FEATURES)
    return latest(batches.select(*SPARK_FEATURES, batch_col), batch_col).drop(batch_col)


def merge(window_features: DataFrame, user_features: DataFrame) -> DataFrame:
    """Window rows left join per-user graph features; missing numbers -> 0
    (text columns are left alone); one row per key.

    The user-feature side has one row per user; Spark broadcasts it only
    when its measured size is under the broadcast threshold, else both
    sides shuffle on user_id."""
    j = window_features.join(user_features, "user_id", "left")
    num_cols = [f.name for f in j.schema.fields if isinstance(f.dataType, NumericType)]
    j = j.fillna(0, subset=num_cols)
    return j.dropDuplicates(KEY)

