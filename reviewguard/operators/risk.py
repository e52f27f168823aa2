"""Risk score and levels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Features the risk score averages, in this order.
RISK_FEATURES = [
    "low_rating_reviews_by_user_5m", "distinct_products", "num_products_in_window", "burst_detected",
    "suspicious_user_flag", "num_suspicious_windows", "num_suspicious_products_targeted",
    "has_multiple_suspicious_windows", "num_other_users_shared_products", "max_common_products_with_any_user",
]
HIGH, MEDIUM = 0.75, 0.45
PREDICT_AT = 0.55
EPS = 1e-9


def score(df: DataFrame, features: list[str] = RISK_FEATURES) -> DataFrame:
    """risk_score = mean over the present features of
    (x - min) / (max - min + 1e-9), nulls as 0; min and max over the whole
    table come from one scalar subquery. 0.0 when no feature is present."""
    present = [c for c in features if c in df.columns]
    if "risk_score" in df.columns:
        out = df
    elif not present:
        out = df.withColumn("risk_score", F.lit(0.0))
    else:
        x = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in present}
        stats = df.select(F.struct(*[e for c in present for e in (F.min(x[c]).alias(f"mn{c}"),
                                                                   F.max(x[c]).alias(f"mx{c}"))]).alias("s"))
        # the scalar subquery enters the plan once, as a column; the score
        # refers to that column, not to copies of the subquery
        out = df.withColumn("_mm", stats.scalar())
        parts = [(x[c] - F.col(f"_mm.mn{c}")) / (F.col(f"_mm.mx{c}") - F.col(f"_mm.mn{c}") + F.lit(EPS))
                 for c in present]
        out = out.withColumn("risk_score", reduce(lambda a, b: a + b, parts) / F.lit(float(len(present)))).drop("_mm")
    if "risk_level" not in out.columns:
        out = out.withColumn("risk_level", level(F.col("risk_score")))
    if "predicted_suspicious" not in out.columns:
        out = out.withColumn("predicted_suspicious", (F.col("risk_score") >= PREDICT_AT).cast("int"))
    return out


def level(s: Column) -> Column:
    return F.when(s >= HIGH, "High").when(s >= MEDIUM, "Medium").otherwise("Low")


def flagged(df: DataFrame, threshold: float = PREDICT_AT, levels: tuple[str, ...] = ("High", "Medium", "Low")) -> DataFrame:
    return df.filter((F.col("risk_score") >= threshold) & F.col("risk_level").isin(*levels))
