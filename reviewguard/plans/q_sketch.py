"""Step 3: DGIM and Bloom sketches."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import bloom as B
from ..operators import dgim as D
from ..operators import windows as W
from .q_windows import DAY, PARSED_EV_SQL, events_stream, uw_ctes
from ..sources.tables import REVIEWS_EV_SQL
from .registry import query, with_ctes


def dgim_input(spark, sf_dir, key_expr=None):
    ev = D.bits(events_stream(spark, sf_dir))
    return ev.withColumn("stream_key", key_expr if key_expr is not None else F.lit("all"))


def _dgim(spark, sf_dir, key_expr=None):
    df = dgim_input(spark, sf_dir, key_expr)
    return D.buckets(df, "stream_key", ["event_time", "review_id"], "bit")


def dgim_sql_ctes(key_sql: str = "'all'") -> list[str]:
    return [REVIEWS_EV_SQL, PARSED_EV_SQL, f"""bt AS (
  SELECT {key_sql} AS stream_key, event_time, review_id,
         CASE WHEN rating IS NOT NULL AND rating <= 2 THEN 1 ELSE 0 END AS bit FROM parsed_ev)""", """ps AS (
  SELECT *, row_number() OVER (PARTITION BY stream_key ORDER BY event_time, review_id) AS pos FROM bt)""", """os AS (
  SELECT stream_key, pos, row_number() OVER (PARTITION BY stream_key ORDER BY pos) AS one_idx FROM ps WHERE bit = 1)""",
            """tot AS (SELECT stream_key, count(*) AS events, sum(bit) AS ones FROM ps GROUP BY 1)""", """lay AS (
  SELECT stream_key, events, ones, length(bin(ones + 1)) - 1 AS L,
         ones - ((CAST(1 AS BIGINT) << (length(bin(ones + 1)) - 1)) - 1) AS m FROM tot WHERE ones > 0)""", """lv AS (
  SELECT stream_key, events, ones, m, j, CAST(1 AS BIGINT) << j AS p,
         1 + ((m >> j) & 1) AS cnt FROM lay, range(0, 64) r(j) WHERE j < L)""", """bk AS (
  SELECT lv.stream_key, lv.events, p AS size, (p - 1) + (m % p) + k * p AS c, ones - ((p - 1) + (m % p) + k * p) AS one_idx
  FROM lv, range(0, 2) q(k) WHERE k < cnt)""", """bke AS (
  SELECT bk.stream_key, bk.events, size, c, os.pos AS "end" FROM bk JOIN os USING (stream_key, one_idx))"""]


@query("dgim_buckets", with_ctes(*dgim_sql_ctes(), body='SELECT stream_key, size, "end", events FROM bke'))
def q_dgim_buckets(spark, sf_dir):
    b, _, _ = _dgim(spark, sf_dir)
    return b.select("stream_key", "size", "end", "events")


@query("dgim_bucket_list", with_ctes(*dgim_sql_ctes(key_sql="product_id"), body="""
SELECT stream_key, string_agg(CAST(size AS VARCHAR) || ':' || CAST("end" AS VARCHAR), ',' ORDER BY c) AS buckets
FROM bke GROUP BY stream_key"""))
def q_dgim_bucket_list(spark, sf_dir):
    b, _, _ = _dgim(spark, sf_dir, F.col("product_id"))
    lst = D.bucket_arrays(b)
    return lst.select("stream_key", F.array_join(F.transform(
        "buckets", lambda x: F.concat(x["size"].cast("string"), F.lit(":"), x["end"].cast("string"))), ",")
        .alias("buckets"))


def estimate_sql(textbook: bool, key_sql: str = "'all'", k: int = 100) -> str:
    if textbook:
        agg = f"""sum(CASE WHEN "end" > events - {k} THEN size ELSE 0 END)
             - coalesce(arg_max(CASE WHEN "end" > events - {k} THEN size END, CASE WHEN "end" > events - {k} THEN c END) // 2, 0)"""
    else:
        agg = f"""sum(CASE WHEN "end" > events - {k} THEN size ELSE 0 END)
             + coalesce(arg_min(CASE WHEN "end" <= events - {k} THEN size END, CASE WHEN "end" <= events - {k} THEN c END) // 2, 0)"""
    return with_ctes(*dgim_sql_ctes(key_sql), f"""est AS (
  SELECT stream_key, CAST({agg} AS BIGINT) AS approx_low FROM bke GROUP BY stream_key)""", body="""
SELECT t.stream_key, t.events, CAST(t.ones AS BIGINT) AS ones, CAST(coalesce(approx_low, 0) AS BIGINT) AS approx_low,
       CAST(CASE WHEN coalesce(approx_low, 0) >= 30 THEN 1 ELSE 0 END AS INTEGER) AS dgim_burst_flag
FROM tot t LEFT JOIN est USING (stream_key)""")


@query("dgim_estimate", estimate_sql(False))
def q_dgim_estimate(spark, sf_dir):
    b, tot, _ = _dgim(spark, sf_dir)
    return D.estimate(b, tot)


@query("dgim_textbook", estimate_sql(True))
def q_dgim_textbook(spark, sf_dir):
    b, tot, _ = _dgim(spark, sf_dir)
    return D.estimate(b, tot, textbook=True)


@query("dgim_exact", with_ctes(*dgim_sql_ctes(), body="""
SELECT t.stream_key, t.events, CAST(t.ones AS BIGINT) AS ones,
       CAST((SELECT count(*) FROM os WHERE os.stream_key = t.stream_key AND os.pos > t.events - 100) AS BIGINT) AS exact_low
FROM tot t"""))
def q_dgim_exact(spark, sf_dir):
    _, tot, ones = _dgim(spark, sf_dir)
    return D.exact_last_k(ones, tot)


@query("dgim_by_product", estimate_sql(False, key_sql="product_id"))
def q_dgim_by_product(spark, sf_dir):
    b, tot, _ = _dgim(spark, sf_dir, F.col("product_id"))
    return D.estimate(b, tot)


def _bloom_pos_sql(col: str, i: int, m: int = 10000) -> str:
    h = f"md5({col} || '_{i}')"
    acc = "0"
    for k in range(4):
        chunk = f"CAST(('0x' || substr({h}, {8 * k + 1}, 8)) AS BIGINT)"
        acc = f"(({acc}) * {(2 ** 32) % m} + {chunk}) % {m}"
    return acc


BLOOM_POS_CTE = """bp AS (
  SELECT user_id, i, CASE i WHEN 0 THEN {p0} WHEN 1 THEN {p1} ELSE {p2} END AS pos
  FROM (SELECT DISTINCT user_id FROM {src} WHERE user_id IS NOT NULL), range(0, 3) r(i))"""


def bloom_pos_cte(src: str, name: str = "bp") -> str:
    return BLOOM_POS_CTE.replace("bp AS", f"{name} AS").format(
        p0=_bloom_pos_sql("user_id", 0), p1=_bloom_pos_sql("user_id", 1), p2=_bloom_pos_sql("user_id", 2), src=src)


@query("bloom_positions", with_ctes(REVIEWS_EV_SQL, bloom_pos_cte("reviews_ev"), body="SELECT user_id, i, pos FROM bp"))
def q_bloom_positions(spark, sf_dir):
    from ..sources.tables import reviews_ev
    return B.positions(reviews_ev(spark, sf_dir)).select("user_id", F.col("i").cast("bigint").alias("i"), "pos")


UW_DAY = uw_ctes(86400)
FLAGGED_CTE = "flagged AS (SELECT DISTINCT user_id FROM uw WHERE suspicious_user_flag = 1)"


@query("bloom_build", with_ctes(*UW_DAY, FLAGGED_CTE, bloom_pos_cte("flagged"), body="SELECT DISTINCT pos FROM bp"))
def q_bloom_build(spark, sf_dir):
    uw = W.user_windows(events_stream(spark, sf_dir), DAY)
    return B.build(B.flag_users(uw))


@query("bloom_membership", with_ctes(*UW_DAY, FLAGGED_CTE, bloom_pos_cte("flagged"), bloom_pos_cte("uw", "qp"), """
bits AS (SELECT DISTINCT pos FROM bp)""", """mem AS (
  SELECT user_id FROM qp JOIN bits USING (pos) GROUP BY user_id HAVING count(*) = 3)""", body="""
SELECT uw.user_id, uw.window_start, CAST(CASE WHEN mem.user_id IS NOT NULL THEN 1 ELSE 0 END AS INTEGER) AS bloom_seen_before
FROM uw LEFT JOIN mem USING (user_id)"""))
def q_bloom_membership(spark, sf_dir):
    uw = W.user_windows(events_stream(spark, sf_dir), DAY)
    out = B.might_contain(uw, B.packed(B.build(B.flag_users(uw))))
    return out.select("user_id", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                      "bloom_seen_before")
