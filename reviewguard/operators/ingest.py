"""Standardising raw review corpora into the 8-column review table
(B5-B21, G7).

Every column choice is made from the schema (``df.columns``) while the
plan is built; every data-dependent choice (epoch unit, text layout of a
timestamp column) is a scalar subquery inside the same plan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import DEFAULT_TS, normalize_label, num, parse_text_ts, with_pandas_style_text
from ..functions.text import clean_for_storage
from ..schema import REVIEW_COLUMNS
from .positions import row_positions

# Alternate column names, first present wins.
USER_COLS = ["user_id", "reviewerID"]
PRODUCT_COLS = ["parent_asin", "asin"]
RATING_COLS = ["rating", "overall"]
TEXT_PARTS = ["title", "text", "reviewText", "review_text"]
LABELLED_TEXT_COLS = ["text", "review", "review_text", "Review", "TEXT"]
MS_THRESHOLD = 1e11   # epoch values at or above are milliseconds


def pick(df: DataFrame, names: list[str], default=None) -> Column:
    """First present column as text (a missing value prints as 'nan', the way
    a text conversion of a missing number prints), else the literal default."""
    for n in names:
        if n in df.columns:
            return F.coalesce(F.col(n).cast("string"), F.lit("nan"))
    return F.lit(default).cast("string")


def not_blank(c: Column) -> Column:
    return c.isNotNull() & (F.regexp_replace(c.cast("string"), r"^\s+|\s+$", "") != "")


def review_text_from_parts(df: DataFrame) -> Column:
    parts = [F.when(not_blank(F.col(c)), F.col(c).cast("string")) for c in TEXT_PARTS if c in df.columns]
    if not parts:
        return F.lit(None).cast("string")
    return clean_for_storage(F.nullif(F.concat_ws(" ", *parts), F.lit("")))


def epoch_to_ts(df: DataFrame, col: str, unit: str | None = None) -> Column:
    """Epoch number -> timestamp; unit ms when the column's max >= 1e11 (a
    scalar subquery), else s, unless ``unit`` is given. Values that are not
    numbers are parsed as text; what fails stays null."""
    x = num(col)
    if unit is None:
        mx = df.select(F.max(num(col))).scalar()
        is_ms = F.coalesce(mx >= F.lit(MS_THRESHOLD), F.lit(False))
    else:
        is_ms = F.lit(unit == "ms")
    micros = F.when(is_ms, x * 1000).otherwise(x * 1_000_000)
    from_num = F.timestamp_micros(micros.try_cast("long"))
    return F.when(x.isNotNull(), from_num).otherwise(parse_text_ts(F.col(col)))


def ts_or_default(ts: Column, default: str = DEFAULT_TS) -> Column:
    return F.coalesce(ts, F.to_timestamp(F.lit(default)))


def dedupe_first(df: DataFrame, subset: list[str], order: str) -> DataFrame:
    """Keep the first row (smallest ``order``) per ``subset`` value.

    ``min_by`` is partially aggregated per task, so a value repeated in a
    third of all rows is reduced before the shuffle. Texts are grouped by their SHA-256, so
    sorts and shuffles compare 64 characters, not texts."""
    types = dict(df.dtypes)
    keys = [F.sha2(c, 256) if types[c] == "string" else F.col(c) for c in subset]
    g = df.groupBy(*[k.alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.min_by(F.struct(*df.columns), F.col(order)).alias("_r"))
    return g.select(*[F.col(f"_r.{c}").alias(c) for c in df.columns])


def _with_row(raw: DataFrame, order: list[str], id_mode: str) -> tuple[DataFrame, Column]:
    """(frame with ``_row``, 0-based id text). ``row``: row numbers in
    ``order`` (one range-partitioned pass); ``hash``: a stable 64-bit hash
    of the order columns (no ordering pass; ``_row`` is then the order
    struct, so keep-first still follows ``order``)."""
    if id_mode == "hash":
        df = raw.withColumn("_row", F.struct(*[F.col(c) for c in order]))
        return df, F.lower(F.hex(F.xxhash64(*[F.col(c) for c in order])))
    df = row_positions(raw, order, out_col="_row")
    return df, (F.col("_row") - 1).cast("string")


def standardize_marketplace(raw: DataFrame, order: list[str], source: str = "amazon",
                            id_prefix: str = "amz_", id_mode: str = "row") -> DataFrame:
    """Marketplace corpus -> review table. Ids are row numbers in ``order``
    taken before any row is dropped (``id_mode="hash"``: stable hashed ids,
    no ordering pass); rows without text are dropped; equal texts keep
    their first row."""
    df, idx = _with_row(raw, order, id_mode)
    if "timestamp" in df.columns:
        ts = ts_or_default(epoch_to_ts(df, "timestamp"))
    elif "unixReviewTime" in df.columns:
        ts = ts_or_default(epoch_to_ts(df, "unixReviewTime", unit="s"))
    elif "reviewTime" in df.columns:
        ts = ts_or_default(parse_text_ts("reviewTime"))
    else:
        ts = None  # literal default text, not a formatted column
    rating = num(F.col(next(c for c in RATING_COLS if c in df.columns))) if any(
        c in df.columns for c in RATING_COLS) else F.lit(None).cast("double")
    std = df.select(
        F.concat(F.lit(id_prefix), idx).alias("review_id"),
        pick(df, USER_COLS, "unknown_user").alias("user_id"),
        pick(df, PRODUCT_COLS, "unknown_product").alias("product_id"),
        rating.alias("rating"),
        review_text_from_parts(df).alias("review_text"),
        (ts if ts is not None else F.lit(DEFAULT_TS)).alias("_ts"),
        F.lit(None).cast("double").alias("label"),
        F.lit(source).alias("source"),
        "_row",
    )
    return _finish(std)


def _finish(std: DataFrame) -> DataFrame:
    if dict(std.dtypes)["_ts"] == "string":
        std = std.withColumnRenamed("_ts", "timestamp")
    else:
        std = with_pandas_style_text(std, "_ts", "timestamp").drop("_ts")
    std = std.filter(F.col("review_text").isNotNull())
    return dedupe_first(std, ["review_text"], "_row").select(*REVIEW_COLUMNS)


def standardize_labelled(raw: DataFrame, order: list[str], source: str = "deceptive_spam",
                         id_mode: str = "row") -> DataFrame:
    """Labelled corpus (CSV or text tree) -> review table."""
    df, idx = _with_row(raw, order, id_mode)
    text_col = next((c for c in LABELLED_TEXT_COLS if c in df.columns), None)
    text = clean_for_storage(F.col(text_col)) if text_col else F.lit(None).cast("string")
    product = (F.lower(F.trim(F.coalesce(F.col("hotel").cast("string"), F.lit("nan"))))
               if "hotel" in df.columns else F.lit("hotel_review"))
    ts = ts_or_default(parse_text_ts("timestamp")) if "timestamp" in df.columns else None
    std = df.select(
        F.concat(F.lit("spam_"), idx).alias("review_id"),
        F.concat(F.lit("user_spam_"), idx).alias("user_id"),
        product.alias("product_id"),
        F.lit(None).cast("double").alias("rating"),
        text.alias("review_text"),
        (ts if ts is not None else F.lit(DEFAULT_TS)).alias("_ts"),
        normalize_label(df).alias("label"),
        F.lit(source).alias("source"),
        "_row",
    )
    return _finish(std)


def union_reviews(*frames: DataFrame) -> DataFrame:
    """Union by name; dedupe stays per corpus, not across the union."""
    return reduce(DataFrame.unionByName, [f.select(*REVIEW_COLUMNS) for f in frames])


def profile(df: DataFrame) -> DataFrame:
    """Null count per column and row counts per source and per label
    (missing included), as one long table: section, key, n."""
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    long_nulls = nulls.select(F.explode(F.array(*[
        F.struct(F.lit("null_count").alias("section"), F.lit(c).alias("key"), F.col(c).alias("n"))
        for c in df.columns])).alias("r")).select("r.*")
    by_source = df.groupBy(F.col("source").cast("string").alias("key")).agg(
        F.count(F.lit(1)).alias("n")).select(F.lit("source").alias("section"), "key", "n")
    by_label = df.groupBy(F.col("label").cast("string").alias("key")).agg(
        F.count(F.lit(1)).alias("n")).select(F.lit("label").alias("section"), "key", "n")
    total = df.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("shape").alias("section"), F.lit("rows").alias("key"), "n")
    return long_nulls.unionByName(by_source).unionByName(by_label).unionByName(total)
