"""Step 1: wire, parse, user windows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import sketches as S
from ..operators import windows as W
from ..operators.wire import event_time, stream_events, to_wire_json, with_pseudonym
from ..session import scratch_path
from ..sources.tables import REVIEWS_EV_SQL, reviews_ev
from .registry import query, with_ctes

OUT_TS = "yyyy-MM-dd HH:mm:ss"


def fmt_ts(c: str) -> F.Column:
    return F.date_format(F.col(c), OUT_TS).alias(c)


def joined(c: str) -> F.Column:
    return F.nullif(F.array_join(F.array_sort(F.col(c)), ","), F.lit("")).alias(c)


def events_stream(spark, sf_dir, via_wire: bool = False) -> DataFrame:
    """Consumer view of the events reviews: strict event time, valid rows,
    pseudonym. ``via_wire`` sends them through JSON and parses them back,
    exactly as the streaming consumer sees them; batch analytics read the
    table directly (same rows and values, no encode/decode work)."""
    if via_wire:
        return stream_events(to_wire_json(reviews_ev(spark, sf_dir)))
    return with_pseudonym(event_time(reviews_ev(spark, sf_dir)))


def user_windows_out(df: DataFrame) -> DataFrame:
    cols = []
    for c in df.columns:
        if c in ("window_start", "window_end"):
            cols.append(fmt_ts(c))
        elif c == "product_ids":
            cols.append(joined(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


# --- SQL twins -------------------------------------------------------------

PARSED_EV_SQL = """parsed_ev AS (
  SELECT *, left(sha256(user_id), 12) AS anonymous_user_id
  FROM (SELECT *, try_strptime(timestamp, '%Y-%m-%d %H:%M:%S.%g') AS event_time FROM reviews_ev)
  WHERE event_time IS NOT NULL)"""


def uw_ctes(seconds: int, low_cut: float = 3.0, burst: int = 3, distinct_flag: int | None = 3,
            v2: bool = True, reviews_cte: str = REVIEWS_EV_SQL, reviews_name: str = "reviews_ev") -> list[str]:
    """CTEs ``uw`` (user windows, text times, flags) and ``tgt`` (window ->
    product edges) over ``parsed_ev``."""
    susp = f"burst_detected = 1 OR distinct_products >= {distinct_flag}" if distinct_flag else "burst_detected = 1"
    v2_cols = ("CAST(max(CASE WHEN source = 'synthetic_spam' THEN 1 ELSE 0 END) AS INTEGER) AS source_spam_label,\n"
               "         CAST(count(DISTINCT product_id) AS INTEGER) AS num_products_in_window,") if v2 else ""
    us = seconds * 1_000_000
    parsed = PARSED_EV_SQL.replace("FROM reviews_ev", f"FROM {reviews_name}")
    return [reviews_cte, parsed, f"""uw0 AS (
  SELECT make_timestamp(CAST(floor(epoch_us(event_time) / {us}) AS BIGINT) * {us}) AS ws,
         user_id, anonymous_user_id,
         count(*) AS low_rating_reviews_by_user_5m,
         count(DISTINCT product_id) AS distinct_products,
         string_agg(DISTINCT product_id, ',' ORDER BY product_id) AS product_ids,
         {v2_cols}
         0 AS _pad
  FROM parsed_ev WHERE rating <= {low_cut}
  GROUP BY 1, 2, 3)""", f"""uw1 AS (
  SELECT *, CAST(CASE WHEN low_rating_reviews_by_user_5m >= {burst} THEN 1 ELSE 0 END AS INTEGER) AS burst_detected
  FROM uw0)""", f"""uw AS (
  SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start,
         strftime(ws + INTERVAL {seconds} SECOND, '%Y-%m-%d %H:%M:%S') AS window_end,
         user_id, anonymous_user_id, low_rating_reviews_by_user_5m, distinct_products, product_ids,
         {"source_spam_label, num_products_in_window," if v2 else ""}
         burst_detected,
         CAST(CASE WHEN {susp} THEN 1 ELSE 0 END AS INTEGER) AS suspicious_user_flag
  FROM uw1)""", f"""tgt AS (
  SELECT DISTINCT user_id,
         strftime(make_timestamp(CAST(floor(epoch_us(event_time) / {us}) AS BIGINT) * {us}), '%Y-%m-%d %H:%M:%S') AS window_start,
         strftime(make_timestamp(CAST(floor(epoch_us(event_time) / {us}) AS BIGINT) * {us}) + INTERVAL {seconds} SECOND, '%Y-%m-%d %H:%M:%S') AS window_end,
         product_id
  FROM parsed_ev WHERE rating <= {low_cut} AND product_id IS NOT NULL AND user_id IS NOT NULL)"""]


def user_windows_sql(seconds: int, low_cut: float, burst: int, distinct_flag: int | None,
                     v2: bool = True) -> str:
    return with_ctes(*uw_ctes(seconds, low_cut, burst, distinct_flag, v2), body="SELECT * FROM uw")


WIRE_JSON_SQL = with_ctes(REVIEWS_EV_SQL, body="""
SELECT review_id AS key,
       '{' || concat_ws(',',
          '"review_id":' || to_json(review_id),
          '"user_id":' || to_json(user_id),
          '"product_id":' || to_json(product_id),
          '"rating":' || CAST(rating AS VARCHAR),
          '"review_text":' || to_json(review_text),
          '"timestamp":' || to_json(timestamp),
          '"label":' || CAST(CAST(label AS BIGINT) AS VARCHAR),
          '"source":' || to_json(source)) || '}' AS value
FROM reviews_ev""")


@query("wire_json", WIRE_JSON_SQL)
def q_wire_json(spark, sf_dir):
    return to_wire_json(reviews_ev(spark, sf_dir))


@query("parse_events", with_ctes(REVIEWS_EV_SQL, PARSED_EV_SQL, body="""
SELECT review_id, user_id, product_id, rating, review_text, timestamp, label, source,
       strftime(event_time, '%Y-%m-%d %H:%M:%S.%g') AS event_time, anonymous_user_id
FROM parsed_ev"""))
def q_parse_events(spark, sf_dir):
    df = events_stream(spark, sf_dir, via_wire=True)
    return df.select("review_id", "user_id", "product_id", "rating", "review_text", "timestamp",
                     "label", "source", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSS").alias("event_time"),
                     "anonymous_user_id")


DAY = W.WindowParams(duration="1 day")


@query("user_windows_1d", user_windows_sql(86400, 3.0, 3, 3))
def q_user_windows_1d(spark, sf_dir):
    return user_windows_out(W.user_windows(events_stream(spark, sf_dir), DAY))


@query("user_windows_1h", user_windows_sql(3600, 3.0, 3, 3))
def q_user_windows_1h(spark, sf_dir):
    return user_windows_out(W.user_windows(events_stream(spark, sf_dir), W.V2))


@query("user_windows_v1", user_windows_sql(86400, 2.0, 2, None, v2=False))
def q_user_windows_v1(spark, sf_dir):
    p = W.WindowParams(duration="1 day", low_cut=2.0, burst_threshold=2, distinct_flag=None,
                       with_v2_columns=False)
    return user_windows_out(W.user_windows(events_stream(spark, sf_dir), p))


@query("user_windows_approx")
def q_user_windows_approx(spark, sf_dir):
    p = W.WindowParams(duration="1 day", approx=True)
    return user_windows_out(W.user_windows(events_stream(spark, sf_dir), p))


USER_PRODUCTS_SQL = with_ctes(REVIEWS_EV_SQL, PARSED_EV_SQL, body="""
SELECT user_id, strftime(make_timestamp(CAST(floor(epoch_us(event_time) / 86400000000) AS BIGINT) * 86400000000), '%Y-%m-%d %H:%M:%S') AS window_start,
       count(*) AS reviews, count(DISTINCT product_id) AS distinct_products
FROM parsed_ev GROUP BY ALL""")


@query("user_products_sketch", USER_PRODUCTS_SQL)
def q_user_products_sketch(spark, sf_dir):
    """Distinct products per user and day out of stored hour sketches (counts this small are exact)."""
    path = scratch_path(spark, f"hours-{uuid.uuid4().hex}")
    S.product_sketches(events_stream(spark, sf_dir)).write.parquet(path)
    days = S.merge_products(spark.read.parquet(path), "1 day")
    return S.distinct_products(days).withColumn("window_start", F.date_format("window_start", OUT_TS))


@query("ingest_rejects", with_ctes(REVIEWS_EV_SQL, body="""
SELECT count(*) AS received,
       count(*) FILTER (WHERE try_strptime(timestamp, '%Y-%m-%d %H:%M:%S.%g') IS NOT NULL) AS accepted,
       CAST(0 AS BIGINT) AS malformed,
       count(*) FILTER (WHERE try_strptime(timestamp, '%Y-%m-%d %H:%M:%S.%g') IS NULL) AS bad_time
FROM reviews_ev"""))
def q_ingest_rejects(spark, sf_dir):
    from ..operators.wire import reject_counts
    return reject_counts(to_wire_json(reviews_ev(spark, sf_dir)))
