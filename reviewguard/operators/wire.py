"""Wire format: JSON encoding of review rows and the parse back."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.hashing import pseudonymize
from ..schema import REVIEW_COLUMNS, REVIEW_WIRE

TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"


def wire_row(df: DataFrame) -> DataFrame:
    """Typed pass-through of a review row as sent on the wire: ids and text as
    strings, rating double, label as an integer (null stays null)."""
    return df.select(
        *[F.col(c).cast("string").alias(c) for c in ("review_id", "user_id", "product_id")],
        F.col("rating").cast("double").alias("rating"),
        F.col("review_text").cast("string").alias("review_text"),
        F.col("timestamp").cast("string").alias("timestamp"),
        F.col("label").try_cast("bigint").alias("label") if "label" in df.columns
        else F.lit(None).cast("bigint").alias("label"),
        F.coalesce(F.col("source").cast("string"), F.lit("amazon")).alias("source"),
    )


def to_wire_json(df: DataFrame, key_col: str | None = "review_id") -> DataFrame:
    """One JSON object per review in column ``value`` (nulls omitted), plus the
    message key, ready for a Kafka-style sink or a text/JSON file sink."""
    w = wire_row(df)
    cols = [F.to_json(F.struct(*[F.col(c) for c in REVIEW_COLUMNS])).alias("value")]
    if key_col:
        cols.insert(0, F.col(key_col).alias("key"))
    return w.select(*cols)


def parse_wire(df: DataFrame, value_col: str = "value", keep_raw: bool = False) -> DataFrame:
    """Bytes or text -> declared struct -> columns. Malformed JSON yields an
    all-null row (dropped later by the event-time filter).

    The struct goes through a generator of one row: filters on its columns
    stay behind it, so each message is parsed once, not again per filter."""
    js = F.col(value_col).cast("string")
    data = F.inline_outer(F.array(F.from_json(js, REVIEW_WIRE)))
    return df.select(*([js.alias("json_string")] if keep_raw else []), data)


def event_time(df: DataFrame, ts_col: str = "timestamp", fmt: str = TS_FORMAT,
               lenient: bool = False, keep_invalid: bool = False) -> DataFrame:
    """Strict event-time parse: only text matching ``fmt`` exactly gives a
    time; anything else is null (never an error, also under ANSI) and the row
    is dropped unless ``keep_invalid``. ``lenient`` also accepts no fraction,
    other fraction lengths and date-only text.

    The result is a wall-clock ``timestamp_ntz``, so windows do not move with
    the session time zone.
    """
    strict = F.try_to_timestamp(F.col(ts_col), F.lit(fmt))
    t = strict
    if lenient:
        t = F.coalesce(strict, F.try_to_timestamp(F.col(ts_col)))
    # wall clock regardless of session zone: parse in the session zone, then
    # drop the zone again
    out = df.withColumn("event_time", t.cast("timestamp_ntz"))
    if not keep_invalid:
        out = out.filter(F.col("event_time").isNotNull())
    return out


def with_pseudonym(df: DataFrame, user_col: str = "user_id",
                   out_col: str = "anonymous_user_id") -> DataFrame:
    return df.withColumn(out_col, pseudonymize(F.col(user_col)))


def stream_events(df: DataFrame, value_col: str = "value", lenient: bool = False) -> DataFrame:
    """parse -> event time -> valid rows -> pseudonym: the shared head of all
    consumers (the reference's ``clean_df`` plus the pseudonym)."""
    return with_pseudonym(event_time(parse_wire(df, value_col), lenient=lenient))


def reject_counts(wire: DataFrame, value_col: str = "value") -> DataFrame:
    """received / parsed / rejected counts of a wire table in one aggregate:
    a message is rejected when it is not a JSON object of the schema or its
    time fails the strict parse (it would be dropped silently otherwise)."""
    t = event_time(parse_wire(wire, value_col, keep_raw=True), keep_invalid=True)
    parsed = F.col("review_id").isNotNull() | F.col("timestamp").isNotNull() | F.col("user_id").isNotNull()
    return t.agg(F.count(F.lit(1)).alias("received"),
                 F.count_if(F.col("event_time").isNotNull()).alias("accepted"),
                 F.count_if(~parsed).alias("malformed"),
                 F.count_if(parsed & F.col("event_time").isNull()).alias("bad_time"))


def observed_rejects(wire: DataFrame, seen: Observation, value_col: str = "value") -> DataFrame:
    """The accepted messages; the counts of :func:`reject_counts` are taken by ``seen`` as
    the rows pass, without a second pass over them."""
    t = event_time(parse_wire(wire, value_col, keep_raw=True), keep_invalid=True)
    parsed = F.col("review_id").isNotNull() | F.col("timestamp").isNotNull() | F.col("user_id").isNotNull()
    return t.observe(seen, F.count(F.lit(1)).alias("received"), F.count_if(F.col("event_time").isNotNull()).alias("accepted"),
                     F.count_if(~parsed).alias("malformed"), F.count_if(parsed & F.col("event_time").isNull()).alias("bad_time")).filter(
        F.col("event_time").isNotNull())
