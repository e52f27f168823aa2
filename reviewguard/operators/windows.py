"""Per-user event-time window table and its flags."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class WindowParams:
    duration: str = "1 hour"
    low_cut: float = 3.0            # rating <= low_cut counts as low
    burst_threshold: int = 3        # low reviews in one window
    distinct_flag: int | None = 3   # distinct products that also flag; None = burst only
    approx: bool = False            # HLL++ distinct count instead of exact
    spam_source: str = "synthetic_spam"
    with_v2_columns: bool = True    # source_spam_label, num_products_in_window


# The two parameter presets of the two consumer versions.
V2 = WindowParams()
V1 = WindowParams(low_cut=2.0, burst_threshold=2, distinct_flag=None, with_v2_columns=False)


def low_rating(df: DataFrame, low_cut: float = 3.0, rating_col: str = "rating") -> DataFrame:
    """Low-rating rows; a null rating is never low."""
    return df.filter(F.col(rating_col) <= F.lit(low_cut))


def user_windows(df: DataFrame, p: WindowParams = V2, time_col: str = "event_time") -> DataFrame:
    """Tumbling event-time windows per (user, pseudonym) over low ratings.

    The group-by runs as a partial (map-side) + final hash aggregate, so a
    user holding a third of all rows is pre-aggregated per task before the
    shuffle; ``collect_set`` is merged the same way and its size is bounded
    by the products of one window.
    """
    low = low_rating(df, p.low_cut)
    distinct = (F.approx_count_distinct("product_id") if p.approx
                else F.size(F.collect_set("product_id")).cast("long"))
    aggs = [
        F.count(F.lit(1)).alias("low_rating_reviews_by_user_5m"),
        distinct.alias("distinct_products"),
        F.collect_set("product_id").alias("product_ids"),
    ]
    if p.with_v2_columns:
        aggs.append(F.max(F.when(F.col("source") == p.spam_source, 1).otherwise(0))
                    .alias("source_spam_label"))
    g = low.groupBy(F.window(time_col, p.duration).alias("window"), "user_id", "anonymous_user_id").agg(*aggs)
    out = g.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "user_id", "anonymous_user_id", "low_rating_reviews_by_user_5m", "distinct_products",
        "product_ids", *(["source_spam_label"] if p.with_v2_columns else []),
    )
    if p.with_v2_columns:
        out = out.withColumn("num_products_in_window", F.size("product_ids"))
    return flags(out, p)


def flags(df: DataFrame, p: WindowParams = V2) -> DataFrame:
    burst = (F.col("low_rating_reviews_by_user_5m") >= p.burst_threshold)
    out = df.withColumn("burst_detected", F.when(burst, 1).otherwise(0))
    susp: Column = F.col("burst_detected") == 1
    if p.distinct_flag is not None:
        susp = susp | (F.col("distinct_products") >= p.distinct_flag)
    return out.withColumn("suspicious_user_flag", F.when(susp, 1).otherwise(0))

