"""Label normalisation and timestamp text helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Label words of a column named ``label``.
LABEL_WORDS = {"deceptive": 1, "truthful": 0, "fake": 1, "real": 0, "spam": 1, "ham": 0, "neg": 1, "pos": 0}
# Label words of the alternate columns, tried in this order.
ALT_LABEL_COLUMNS = ["deceptive", "class", "is_fake", "is_deceptive"]
ALT_LABEL_WORDS = {"deceptive": 1, "truthful": 0, "true": 1, "false": 0, "yes": 1, "no": 0}

DEFAULT_TS = "2024-01-01 00:00:00"

# Text timestamp layouts tried in order after Spark's own ISO parsing.
TEXT_TS_FORMATS = ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "MM d, yyyy", "MM dd, yyyy", "MM/dd/yyyy",
                   "MMM d, yyyy", "d MMM yyyy"]


def num(c) -> Column:
    """Numeric coercion; anything unparsable, NaN or infinite becomes null (never an error)."""
    c = F.col(c) if isinstance(c, str) else c
    x = c.cast("string").try_cast("double")
    return F.when(F.abs(x) < float("inf"), x)


def _map_words(c: Column, words: dict[str, int]) -> Column:
    m = F.create_map(*[x for k, v in words.items() for x in (F.lit(k), F.lit(float(v)))])
    key = F.lower(F.trim(c.cast("string")))
    return F.coalesce(F.try_element_at(m, key), num(c))


def normalize_label(df: DataFrame) -> Column:
    """Label as 1.0 / 0.0 / null from whichever label column the table has."""
    cols = set(df.columns)
    if "label" in cols:
        if dict(df.dtypes)["label"] == "string":
            return _map_words(F.col("label"), LABEL_WORDS)
        return num("label")
    for c in ALT_LABEL_COLUMNS:
        if c in cols:
            if dict(df.dtypes)[c] == "string":
                return _map_words(F.col(c), ALT_LABEL_WORDS)
            return num(c)
    return F.lit(None).cast("double")


def parse_text_ts(c) -> Column:
    """Free-text timestamp -> timestamp or null (tries ISO, then fixed layouts)."""
    c = F.col(c) if isinstance(c, str) else c
    s = F.trim(c.cast("string"))
    return F.coalesce(F.try_to_timestamp(s), *[F.try_to_timestamp(s, F.lit(f)) for f in TEXT_TS_FORMATS])


def with_pandas_style_text(df: DataFrame, ts_col: str, out_col: str) -> DataFrame:
    """Timestamp column -> text the way a whole column is printed: date only
    when every value is midnight, else seconds, with 3 or 6 fraction digits
    when any value needs them. The column-wide facts come from one scalar
    subquery that enters the plan once (as a column), not from the driver."""
    us = F.unix_micros(F.col(ts_col).cast("timestamp"))
    facts = df.agg(F.struct(
        F.coalesce(F.bool_and(us % 86_400_000_000 == 0), F.lit(False)).alias("dates"),
        F.coalesce(F.bool_or(us % 1000 != 0), F.lit(False)).alias("micros"),
        F.coalesce(F.bool_or(us % 1_000_000 != 0), F.lit(False)).alias("millis"),
    ).alias("s"))
    d = df.withColumn("_fmt", facts.scalar())
    t = F.col(ts_col)
    text = (F.when(F.col("_fmt.dates"), F.date_format(t, "yyyy-MM-dd"))
            .when(F.col("_fmt.micros"), F.date_format(t, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
            .when(F.col("_fmt.millis"), F.date_format(t, "yyyy-MM-dd HH:mm:ss.SSS"))
            .otherwise(F.date_format(t, "yyyy-MM-dd HH:mm:ss")))
    return d.withColumn(out_col, text).drop("_fmt")
