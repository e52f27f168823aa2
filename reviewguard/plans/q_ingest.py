"""Step 5: standardising, labels, timestamps, profile, replay operators."""

from __future__ import annotations

import uuid
from html.entities import html5

from pyspark.sql import Observation
from pyspark.sql import functions as F

from ..functions.labels import normalize_label
from ..functions.text import clean_for_storage
from ..operators import augment as A
from ..operators import ingest as I
from ..operators.wire import to_wire_json
from ..session import scratch_path
from ..sources import raw as R
from ..sources.tables import REVIEWS_DOC_SQL, REVIEWS_EV_SQL, read_table, reviews_doc, reviews_ev
from .registry import query, with_ctes


def _quoted(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def decode_sql(x: str) -> str:
    """SQL twin of functions.entities.decode_entities, on the whole table of names."""
    def table(items):
        return "MAP {" + ", ".join(f"{_quoted(k)}: {_quoted(v)}" for k, v in items) + "}"
    bare = [(n, v) for n, v in html5.items() if not n.endswith(";")]
    cp1252 = {i: (bytes([i]).decode("cp1252", "ignore") or chr(i)) for i in range(128, 160)}
    n = """(CASE WHEN regexp_matches(p, '^#[0-9]') THEN TRY_CAST(regexp_extract(p, '^#([0-9]+)', 1) AS HUGEINT)
             ELSE TRY_CAST('0x' || right('0000000' || left(ltrim(regexp_extract(p, '^#[xX]([0-9a-fA-F]+)', 1), '0'), 7), 7) AS BIGINT)
                  + CASE WHEN length(ltrim(regexp_extract(p, '^#[xX]([0-9a-fA-F]+)', 1), '0')) > 7 THEN 1114112 ELSE 0 END END)"""
    char = f"""(CASE WHEN {n} IS NULL OR {n} = 0 OR {n} > 1114111 OR {n} BETWEEN 55296 AND 57343 THEN '\uFFFD'
             WHEN {n} = 13 THEN chr(13)
             WHEN {n} BETWEEN 128 AND 159 THEN {table((str(k), v) for k, v in cp1252.items())}[CAST({n} AS VARCHAR)]
             WHEN {n} BETWEEN 1 AND 8 OR {n} = 11 OR {n} BETWEEN 14 AND 31 OR {n} = 127 OR {n} BETWEEN 64976 AND 65007
                  OR {n} % 65536 >= 65534 THEN '' ELSE chr(CAST({n} AS INTEGER)) END)"""
    name = r"regexp_extract(p, '^[^\t\n\f <&#;]{1,32};?', 0)"
    starts = ", ".join(f"CASE WHEN length({name}) > {k} THEN {table(bare)}[left(p, {k})] || substr(p, {k + 1}) END" for k in range(6, 1, -1))
    num = "regexp_extract(p, '^#([0-9]+|[xX][0-9a-fA-F]+);?', 0)"
    part = f"""CASE WHEN {num} <> '' THEN {char} || substr(p, length({num}) + 1)
             ELSE coalesce({table(html5.items())}[{name}] || substr(p, length({name}) + 1), {starts}, '&' || p) END"""
    cut = f"string_split({x}, '&')"
    return f"(CASE WHEN contains({x}, '&') THEN {cut}[1] || array_to_string([{part} FOR p IN {cut}[2:]], '') ELSE {x} END)"


def clean_sql(x: str) -> str:
    """SQL twin of functions.text.clean_for_storage."""
    x = decode_sql(x)
    x = f"regexp_replace({x}, '<.*?>', ' ', 'g')"
    x = f"lower({x})"
    x = f"regexp_replace({x}, '[^a-z0-9\\s]', ' ', 'g')"
    x = f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"
    return f"nullif({x}, '')"


def not_blank_sql(x: str) -> str:
    return f"({x} IS NOT NULL AND regexp_replace({x}, '^\\s+|\\s+$', '', 'g') <> '')"


def pandas_ts_sql(col: str, rel: str) -> str:
    """SQL twin of the column-wide timestamp text layout."""
    us = f"epoch_us({col})"
    return f"""CASE
      WHEN (SELECT coalesce(bool_and({us} % 86400000000 = 0), false) FROM {rel}) THEN strftime({col}, '%Y-%m-%d')
      WHEN (SELECT coalesce(bool_or({us} % 1000 <> 0), false) FROM {rel}) THEN strftime({col}, '%Y-%m-%d %H:%M:%S.%f')
      WHEN (SELECT coalesce(bool_or({us} % 1000000 <> 0), false) FROM {rel}) THEN strftime({col}, '%Y-%m-%d %H:%M:%S.%g')
      ELSE strftime({col}, '%Y-%m-%d %H:%M:%S') END"""


STD_DOCS_SQL = [R.RAW_MARKETPLACE_DOCS_SQL, """m1 AS (
  SELECT row_number() OVER (ORDER BY _ord) AS _row, * FROM raw_m)""", f"""m2 AS (
  SELECT 'amz_' || CAST(_row - 1 AS VARCHAR) AS review_id, coalesce(reviewerID, 'nan') AS user_id,
         coalesce(asin, 'nan') AS product_id, TRY_CAST(overall AS DOUBLE) AS rating,
         {clean_sql("nullif(concat_ws(' ', CASE WHEN " + not_blank_sql('title') + " THEN title END, CASE WHEN " + not_blank_sql('text') + " THEN text END), '')")} AS review_text,
         make_timestamp(CAST(TRY_CAST(unixReviewTime AS DOUBLE) * 1000000 AS BIGINT)) AS _ts,
         CAST(NULL AS DOUBLE) AS label, 'amazon' AS source, _row
  FROM m1)""", f"""m3 AS (
  SELECT review_id, user_id, product_id, rating, review_text, {pandas_ts_sql('_ts', 'm2')} AS timestamp,
         label, source, _row FROM m2 WHERE review_text IS NOT NULL)""", """std_m AS (
  SELECT review_id, user_id, product_id, rating, review_text, timestamp, label, source FROM (
    SELECT *, row_number() OVER (PARTITION BY review_text ORDER BY _row) AS rn FROM m3) WHERE rn = 1)"""]


@query("standardize_amazon", with_ctes(*STD_DOCS_SQL, body="SELECT * FROM std_m"))
def q_standardize_amazon(spark, sf_dir):
    return I.standardize_marketplace(R.raw_marketplace_docs(spark, sf_dir), ["_ord"])


STD_EV_SQL = [R.RAW_MARKETPLACE_EVENTS_SQL, """e1 AS (SELECT row_number() OVER (ORDER BY _ord) AS _row, * FROM raw_e)""",
              f"""e2 AS (
  SELECT 'amz_' || CAST(_row - 1 AS VARCHAR) AS review_id, coalesce(user_id, 'nan') AS user_id,
         coalesce(parent_asin, 'nan') AS product_id, TRY_CAST(rating AS DOUBLE) AS rating,
         {clean_sql("nullif(concat_ws(' ', CASE WHEN " + not_blank_sql('text') + " THEN text END), '')")} AS review_text,
         CASE WHEN (SELECT max(TRY_CAST(timestamp AS DOUBLE)) FROM e1) >= 1e11
              THEN make_timestamp(CAST(TRY_CAST(timestamp AS DOUBLE) * 1000 AS BIGINT))
              ELSE make_timestamp(CAST(TRY_CAST(timestamp AS DOUBLE) * 1000000 AS BIGINT)) END AS _ts,
         CAST(NULL AS DOUBLE) AS label, 'amazon' AS source, _row
  FROM e1)""", f"""e3 AS (
  SELECT review_id, user_id, product_id, rating, review_text,
         {pandas_ts_sql("coalesce(_ts, TIMESTAMP '2024-01-01 00:00:00')", 'e2')} AS timestamp,
         label, source, _row FROM e2 WHERE review_text IS NOT NULL)""", """std_e AS (
  SELECT review_id, user_id, product_id, rating, review_text, timestamp, label, source FROM (
    SELECT *, row_number() OVER (PARTITION BY review_text ORDER BY _row) AS rn FROM e3) WHERE rn = 1)"""]


@query("standardize_amazon_ms", with_ctes(*STD_EV_SQL, body="SELECT * FROM std_e"))
def q_standardize_amazon_ms(spark, sf_dir):
    return I.standardize_marketplace(R.raw_marketplace_events(spark, sf_dir), ["_ord"])


STD_LAB_SQL = [R.RAW_LABELLED_SQL, """l1 AS (SELECT row_number() OVER (ORDER BY _ord) AS _row, * FROM raw_l)""",
               f"""l2 AS (
  SELECT 'spam_' || CAST(_row - 1 AS VARCHAR) AS review_id, 'user_spam_' || CAST(_row - 1 AS VARCHAR) AS user_id,
         lower(trim(coalesce(hotel, 'nan'))) AS product_id, CAST(NULL AS DOUBLE) AS rating,
         {clean_sql('text')} AS review_text, '2024-01-01 00:00:00' AS timestamp,
         coalesce(CASE lower(trim(deceptive)) WHEN 'deceptive' THEN 1.0 WHEN 'truthful' THEN 0.0 WHEN 'true' THEN 1.0
                  WHEN 'false' THEN 0.0 WHEN 'yes' THEN 1.0 WHEN 'no' THEN 0.0 END, TRY_CAST(deceptive AS DOUBLE)) AS label,
         'deceptive_spam' AS source, _row
  FROM l1)""", """std_l AS (
  SELECT review_id, user_id, product_id, rating, review_text, timestamp, label, source FROM (
    SELECT *, row_number() OVER (PARTITION BY review_text ORDER BY _row) AS rn FROM l2 WHERE review_text IS NOT NULL)
  WHERE rn = 1)"""]


@query("standardize_labelled", with_ctes(*STD_LAB_SQL, body="SELECT * FROM std_l"))
def q_standardize_labelled(spark, sf_dir):
    return I.standardize_labelled(R.raw_labelled(spark, sf_dir), ["_ord"])


STD_TIMES_SQL = [c.replace("make_timestamp(CAST(TRY_CAST(unixReviewTime AS DOUBLE) * 1000000 AS BIGINT))",
                           "CASE WHEN _ord % 8 = 7 THEN TIMESTAMP '2024-01-01 00:00:00' ELSE TIMESTAMP '2023-03-05 00:00:00' + to_days(CAST(_ord % 400 AS INTEGER)) END")
                 for c in STD_DOCS_SQL]


@query("standardize_amazon_text_times", with_ctes(*STD_TIMES_SQL, body="SELECT * FROM std_m"))
def q_standardize_amazon_text_times(spark, sf_dir):
    return I.standardize_marketplace(R.raw_marketplace_times(spark, sf_dir), ["_ord"])


STD_LAB_TIMES_SQL = [STD_LAB_SQL[0], STD_LAB_SQL[1], STD_LAB_SQL[2].replace("'2024-01-01 00:00:00' AS timestamp",
    "CASE WHEN _ord % 9 = 0 THEN TIMESTAMP '2024-01-01 00:00:00' ELSE make_timestamp((1700000000 + _ord * 61) * 1000000) END AS _ts"), f"""l3 AS (
  SELECT *, {pandas_ts_sql('_ts', 'l2')} AS timestamp FROM l2 WHERE review_text IS NOT NULL)""", STD_LAB_SQL[3].replace("FROM l2 WHERE review_text IS NOT NULL", "FROM l3")]


@query("standardize_labelled_times", with_ctes(*STD_LAB_TIMES_SQL, body="SELECT * FROM std_l"))
def q_standardize_labelled_times(spark, sf_dir):
    return I.standardize_labelled(R.raw_labelled_times(spark, sf_dir), ["_ord"])


@query("union_reviews", with_ctes(*STD_DOCS_SQL, *STD_LAB_SQL, body="SELECT * FROM std_m UNION ALL SELECT * FROM std_l"))
def q_union_reviews(spark, sf_dir):
    return I.union_reviews(I.standardize_marketplace(R.raw_marketplace_docs(spark, sf_dir), ["_ord"]),
                           I.standardize_labelled(R.raw_labelled(spark, sf_dir), ["_ord"]))


@query("clean_text_pages", f"SELECT page_id, {clean_sql('html')} AS clean_text FROM pages")
def q_clean_text_pages(spark, sf_dir):
    p = read_table(spark, sf_dir, "pages")
    return p.select("page_id", clean_for_storage("html").alias("clean_text"))


def _label_sql(column: str, words: dict) -> str:
    cases = " ".join(f"WHEN '{k}' THEN {float(v)}" for k, v in words.items())
    return with_ctes(R.raw_label_words_sql(column), body=f"""
SELECT doc_id, coalesce(CASE lower(trim({column})) {cases} END, TRY_CAST({column} AS DOUBLE)) AS label FROM raw_w""")


@query("normalize_label", _label_sql("label", {"deceptive": 1, "truthful": 0, "fake": 1, "real": 0, "spam": 1,
                                                "ham": 0, "neg": 1, "pos": 0}))
def q_normalize_label(spark, sf_dir):
    raw = R.raw_label_words(spark, sf_dir, "label")
    return raw.select("doc_id", normalize_label(raw).alias("label"))


@query("normalize_label_alt", _label_sql("is_fake", {"deceptive": 1, "truthful": 0, "true": 1, "false": 0,
                                                      "yes": 1, "no": 0}))
def q_normalize_label_alt(spark, sf_dir):
    raw = R.raw_label_words(spark, sf_dir, "is_fake")
    return raw.select("doc_id", normalize_label(raw).alias("label"))


EPOCH_SQL = """ep AS (SELECT event_id, epoch_us(ts) // 1000 AS ms, epoch(ts) AS s FROM events)""", """ep2 AS (
  SELECT event_id,
         CASE WHEN (SELECT max(ms) FROM ep) >= 1e11 THEN make_timestamp(ms * 1000) ELSE make_timestamp(ms * 1000000) END AS t_ms,
         CASE WHEN (SELECT max(CAST(floor(s) AS BIGINT)) FROM ep) >= 1e11 THEN make_timestamp(CAST(floor(s) AS BIGINT) * 1000)
              ELSE make_timestamp(CAST(floor(s) AS BIGINT) * 1000000) END AS t_s
  FROM ep)"""


@query("epoch_to_ts", with_ctes(*EPOCH_SQL, body=f"""
SELECT event_id, {pandas_ts_sql('t_ms', 'ep2')} AS ts_from_ms, {pandas_ts_sql('t_s', 'ep2')} AS ts_from_s FROM ep2"""))
def q_epoch_to_ts(spark, sf_dir):
    from ..functions.labels import with_pandas_style_text
    e = read_table(spark, sf_dir, "events").select(
        "event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("s"))
    t = e.select("event_id", I.epoch_to_ts(e, "ms").alias("t_ms"), I.epoch_to_ts(e, "s").alias("t_s"))
    t = with_pandas_style_text(t, "t_ms", "ts_from_ms")
    t = with_pandas_style_text(t, "t_s", "ts_from_s")
    return t.select("event_id", "ts_from_ms", "ts_from_s")


@query("profile", with_ctes(REVIEWS_DOC_SQL, body="""
SELECT 'null_count' AS section, c AS key, n FROM (
  SELECT unnest(['review_id','user_id','product_id','rating','review_text','timestamp','label','source']) AS c,
         unnest([count(*) FILTER (WHERE review_id IS NULL), count(*) FILTER (WHERE user_id IS NULL),
                 count(*) FILTER (WHERE product_id IS NULL), count(*) FILTER (WHERE rating IS NULL),
                 count(*) FILTER (WHERE review_text IS NULL), count(*) FILTER (WHERE timestamp IS NULL),
                 count(*) FILTER (WHERE label IS NULL), count(*) FILTER (WHERE source IS NULL)]) AS n
  FROM reviews_doc)
UNION ALL SELECT 'source', source, count(*) FROM reviews_doc GROUP BY source
UNION ALL SELECT 'label', CAST(label AS VARCHAR), count(*) FROM reviews_doc GROUP BY label
UNION ALL SELECT 'shape', 'rows', count(*) FROM reviews_doc"""))
def q_profile(spark, sf_dir):
    return I.profile(reviews_doc(spark, sf_dir))


@query("valid_records", with_ctes(REVIEWS_DOC_SQL, body=f"""
SELECT * FROM reviews_doc WHERE {" AND ".join(not_blank_sql(c) for c in A.REQUIRED)}"""))
def q_valid_records(spark, sf_dir):
    return A.valid_records(reviews_doc(spark, sf_dir))


@query("slice_rows", with_ctes(REVIEWS_EV_SQL, """sl AS (
  SELECT * FROM (SELECT *, row_number() OVER (ORDER BY CAST(substr(review_id, 2) AS BIGINT)) AS row_num FROM reviews_ev)
  WHERE row_num BETWEEN 101 AND 5000)""", body=f"""
SELECT * EXCLUDE (k) FROM (
  SELECT *, row_number() OVER (ORDER BY row_num) AS k FROM sl
  WHERE {" AND ".join(not_blank_sql(c) for c in A.REQUIRED)})
WHERE k <= 1000"""))
def q_slice_rows(spark, sf_dir):
    ev = reviews_ev(spark, sf_dir).withColumn("_ord", F.expr("CAST(substr(review_id, 2) AS BIGINT)"))
    return A.slice_rows(ev, ["_ord"], start_row=101, end_row=5000, max_rows=1000).drop("_ord")


@query("inject_spam")
def q_inject_spam(spark, sf_dir):
    return A.inject_spam(reviews_ev(spark, sf_dir), rate=0.12, seed=42)


@query("augment_counts")
def q_augment_counts(spark, sf_dir):
    """Counters observed while the messages are written, without a second pass."""
    seen = Observation(f"augment-{uuid.uuid4().hex}")
    rows = A.observe_counts(A.valid_records(A.inject_spam(reviews_ev(spark, sf_dir), rate=0.12, seed=42)), seen)
    to_wire_json(rows).write.parquet(scratch_path(spark, f"wire-{uuid.uuid4().hex}"))
    return spark.createDataFrame([(seen.get["sent"], seen.get["real_rows"], seen.get["injected_rows"])], "sent long, real_rows long, injected_rows long")
