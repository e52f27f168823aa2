"""Report aggregates behind the dashboard.

Each report is one aggregate or one ordered projection over the scored
table; nothing is computed on the driver."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from . import sketches
from .risk import RISK_FEATURES

# Fixed names of the graph features.
GRAPH_COLS = ["num_windows", "num_suspicious_windows", "num_total_targeted_products",
              "num_suspicious_products_targeted", "max_products_in_one_window", "avg_products_per_window",
              "has_multiple_suspicious_windows", "num_other_users_shared_products",
              "max_common_products_with_any_user"]
TIE = ["user_id", "window_start"]

# Alert texts per risk level (Low raises none).
ALERT_TEXT = {
    "High": "HIGH RISK CAMPAIGN ALERT: Burst behavior / suspicious graph overlap / repeated activity detected.",
    "Medium": "MEDIUM RISK WARNING: Some behavioral or graph indicators show abnormal activity.",
}


def kpis(df: DataFrame, threshold: float = 0.55, levels=("High", "Medium", "Low")) -> DataFrame:
    flagged = (F.col("risk_score") >= threshold) & F.col("risk_level").isin(*levels)
    return df.agg(
        F.count(F.lit(1)).alias("total_records"), F.count_if(flagged).alias("flagged_records"),
        F.count_if(F.col("risk_level") == "High").alias("high_risk"),
        F.count_if(F.col("risk_level") == "Medium").alias("medium_risk"),
        F.avg("risk_score").alias("avg_risk_score"),
        F.sum("burst_detected").cast("long").alias("burst_records"),
    )


def histogram(df: DataFrame, col: str = "risk_score", by: str = "risk_level", bins: int = 40) -> DataFrame:
    """Equal-width bins over [min, max] of ``col`` (bounds from a scalar
    subquery), counted per ``by`` value. The max lands in the last bin."""
    mm = df.select(F.struct(F.min(col).alias("lo"), F.max(col).alias("hi")).alias("s")).scalar()
    d = df.filter(F.col(col).isNotNull()).withColumn("_mm", mm)
    width = (F.col("_mm.hi") - F.col("_mm.lo")) / F.lit(bins)
    b = F.when(width > 0, F.least(F.floor((F.col(col) - F.col("_mm.lo")) / width), F.lit(bins - 1))).otherwise(0)
    g = (d.groupBy(b.cast("int").alias("bin"), F.col(by).cast("string").alias(by))
         .agg(F.count(F.lit(1)).alias("count"), F.first("_mm").alias("_mm")))
    return g.select("bin", by, "count", (F.col("_mm.lo") + F.col("bin") * width).alias("bin_start"),
                    (F.col("_mm.lo") + (F.col("bin") + 1) * width).alias("bin_end"))


def level_means(df: DataFrame, cols: list[str] = GRAPH_COLS, by: str = "risk_level") -> DataFrame:
    present = [c for c in cols if c in df.columns]
    return df.groupBy(by).agg(*[F.avg(c).alias(c) for c in present])


def box(df: DataFrame, col: str, by: str = "risk_level", exact: bool = True) -> DataFrame:
    """min, quartiles, median, max per group. Exact mode keeps a value ->
    count map per group (memory grows with distinct values, suited to count
    features); else a KLL sketch of fixed size per group (``operators.sketches``)."""
    if not exact:
        return sketches.box(sketches.value_sketches(df, col, (by,)), (by,))
    x = F.col(col).cast("double")
    g = df.groupBy(by).agg(F.min(x).alias("min"), F.percentile(x, F.array(*[F.lit(v) for v in sketches.QUARTILES])).alias("_q"), F.max(x).alias("max"))
    return g.select(by, "min", F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"),
                    F.col("_q")[2].alias("q3"), "max")


def rank_check(df: DataFrame, boxes: DataFrame, col: str, by: str = "risk_level", error: float = 0.01) -> DataFrame:
    """Whether the quartiles of ``boxes`` lie within ``error`` of their rank in the rows: by, rows, q1_ok, median_ok, q3_ok.

    ``boxes`` has one row per group and joins as the groups' facts; the rows are read once."""
    x = F.col(col).cast("double")
    j = df.filter(x.isNotNull()).select(by, x.alias("x")).join(boxes.select(by, "q1", "median", "q3"), by)
    aggs = [F.count(F.lit(1)).alias("rows")]
    for c in ("q1", "median", "q3"):
        aggs += [F.avg((F.col("x") < F.col(c)).cast("int")).alias(f"{c}_lt"), F.avg((F.col("x") <= F.col(c)).cast("int")).alias(f"{c}_le")]
    return j.groupBy(by).agg(*aggs).select(by, "rows", *[((F.col(f"{c}_lt") <= q + error) & (F.col(f"{c}_le") >= q - error)).alias(f"{c}_ok")
                                                         for c, q in zip(("q1", "median", "q3"), sketches.QUARTILES)])


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def correlation(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair of numeric columns, as a long
    table (a, b, corr); undefined (constant column) -> null. Rows where either is null don't count for a pair.

    Each task sums values and products of all column pairs at once (matrix products of
    its batches, shifted by the columns' means so that nothing cancels) and puts out one row
    per pair; those few rows are added and divided."""
    cols = cols or numeric_columns(df)
    if len(cols) < 2:
        return df.sparkSession.createDataFrame([], "a string, b string, corr double")
    x = [F.col(c).cast("double") for c in cols]
    facts = df.agg(*[F.struct(F.avg(v).alias("mean"), (F.min(v) < F.max(v)).alias("varies")).alias(f"c{i}") for i, v in enumerate(x)]).first()   # one row
    means, varies = [f["mean"] for f in facts], [bool(f["varies"]) for f in facts]
    x = df.select(*[(F.col(c).cast("double") - F.lit(float(means[i] or 0.0))).alias(f"x{i}") for i, c in enumerate(cols)])
    pairs = list(combinations(range(len(cols)), 2))

    def sums(batches):
        total = 0
        for b in batches:
            v = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in b.columns])
            there = ~np.isnan(v)
            v, m = np.where(there, v, 0.0), there.astype(float)
            total = total + np.stack([m.T @ m, v.T @ m, m.T @ v, (v * v).T @ m, m.T @ (v * v), v.T @ v])
        if not isinstance(total, int):
            at = [total[:, i, j] for i, j in pairs]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(pairs)), pa.int32()), *map(pa.array, zip(*at))], ["p", "n", "sx", "sy", "xx", "yy", "xy"])
    s = x.mapInArrow(sums, "p int, n double, sx double, sy double, xx double, yy double, xy double").groupBy("p").agg(
        *[F.sum(c).alias(c) for c in ("n", "sx", "sy", "xx", "yy", "xy")])
    cov, vx, vy = (F.col(ab) - F.try_divide(F.col(a) * F.col(b), F.col("n")) for ab, a, b in (("xy", "sx", "sy"), ("xx", "sx", "sx"), ("yy", "sy", "sy")))
    known = F.get(F.array(*[F.lit(varies[i] and varies[j]) for i, j in pairs]), F.col("p"))
    r = F.when(known & (vx > 0) & (vy > 0), F.try_divide(cov, F.sqrt(vx) * F.sqrt(vy)))
    name = [F.get(F.array(*[F.lit(cols[pair[k]]) for pair in pairs]), F.col("p")) for k in (0, 1)]
    return s.select(name[0].alias("a"), name[1].alias("b"), F.round(r, 6).alias("corr"))


def top(df: DataFrame, n: int = 20, cols: list[str] | None = None) -> DataFrame:
    """Highest risk first (ties by user and window), first ``n``."""
    cols = cols or ["risk_score", "risk_level"] + [c for c in RISK_FEATURES if c in df.columns]
    return df.orderBy(F.col("risk_score").desc(), *TIE).limit(n).select(*TIE, *[c for c in cols if c not in TIE])


def alerts(df: DataFrame, n: int = 15) -> DataFrame:
    """Alert rows for the ``n`` highest-risk records; Low raises none."""
    t = df.orderBy(F.col("risk_score").desc(), *TIE).limit(n)
    text = F.when(F.col("risk_level") == "High", F.lit(ALERT_TEXT["High"])).when(
        F.col("risk_level") == "Medium", F.lit(ALERT_TEXT["Medium"]))
    return t.select(*TIE, "risk_score", "risk_level", text.alias("alert")).filter(F.col("alert").isNotNull())


def explore(df: DataFrame, cols: list[str]) -> DataFrame:
    """Chosen columns, highest risk first (a full ordered projection)."""
    return df.select(*cols).orderBy(F.col("risk_score").desc(), *[c for c in TIE if c in cols])


def scatter(df: DataFrame, feature: str) -> DataFrame:
    return df.select(*TIE, F.col(feature).alias("x"), F.col("risk_score").alias("y"), "risk_level")
