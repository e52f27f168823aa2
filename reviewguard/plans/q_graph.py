"""Step 2: window graph, review graph, per-user graph features."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import graph as G
from ..operators import windows as W
from ..session import scratch_path
from ..sources.tables import REVIEWS_DOC_SQL, REVIEWS_LI_SQL, reviews_doc, reviews_li
from .q_windows import DAY, events_stream, uw_ctes
from .registry import query, with_ctes

UW_DAY = uw_ctes(86400)
SPLIT_TS = "2024-01-16 12:00:00.000"


def day_graph(spark, sf_dir):
    return G.window_graph(W.user_windows(events_stream(spark, sf_dir), DAY))


# reference formulation of the features (seven pattern queries, left-joined)
FEATURES_SQL_BODY = """
, pw AS (SELECT user_id, window_start, window_end, count(DISTINCT product_id) AS pc FROM tgt GROUP BY ALL)
, base AS (
  SELECT w.user_id, count(*) AS num_windows,
         count(*) FILTER (WHERE suspicious_user_flag = 1) AS num_suspicious_windows,
         max(coalesce(pc, 0)) AS max_products_in_one_window,
         avg(coalesce(pc, 0)) AS avg_products_per_window
  FROM uw w LEFT JOIN pw USING (user_id, window_start, window_end) GROUP BY w.user_id)
, prod AS (
  SELECT t.user_id, count(DISTINCT t.product_id) AS num_total_targeted_products,
         count(DISTINCT CASE WHEN w.suspicious_user_flag = 1 THEN t.product_id END) AS num_suspicious_products_targeted
  FROM tgt t JOIN uw w USING (user_id, window_start, window_end) GROUP BY t.user_id)
, e AS (SELECT DISTINCT user_id, product_id FROM tgt)
, pairs AS (SELECT a.user_id AS u1, b.user_id AS u2, count(*) AS c
            FROM e a JOIN e b ON a.product_id = b.product_id AND a.user_id < b.user_id GROUP BY 1, 2)
, sides AS (SELECT u1 AS user_id, u2 AS other, c FROM pairs UNION ALL SELECT u2, u1, c FROM pairs)
, pf AS (SELECT user_id, count(DISTINCT other) AS num_other_users_shared_products,
                max(c) AS max_common_products_with_any_user FROM sides GROUP BY 1)
"""

FEATURES_SQL_SELECT = """
SELECT b.user_id,
       CAST(num_windows AS DOUBLE) AS num_windows,
       CAST(num_suspicious_windows AS DOUBLE) AS num_suspicious_windows,
       CAST(coalesce(num_total_targeted_products, 0) AS DOUBLE) AS num_total_targeted_products,
       CAST(coalesce(num_suspicious_products_targeted, 0) AS DOUBLE) AS num_suspicious_products_targeted,
       CAST(max_products_in_one_window AS DOUBLE) AS max_products_in_one_window,
       CAST(avg_products_per_window AS DOUBLE) AS avg_products_per_window,
       CAST(CASE WHEN num_suspicious_windows > 1 THEN 1 ELSE 0 END AS DOUBLE) AS has_multiple_suspicious_windows,
       CAST(coalesce(num_other_users_shared_products, 0) AS DOUBLE) AS num_other_users_shared_products,
       CAST(coalesce(max_common_products_with_any_user, 0) AS DOUBLE) AS max_common_products_with_any_user
FROM base b LEFT JOIN prod USING (user_id) LEFT JOIN pf USING (user_id)"""

def _features_sql(ctes):
    body = FEATURES_SQL_BODY.strip()
    assert body.startswith(",")
    return "WITH " + ",\n".join(ctes) + "\n" + body + "\n" + FEATURES_SQL_SELECT


@query("graph_nodes_edges", with_ctes(*UW_DAY, body="""
SELECT 'users' AS kind, user_id, CAST(NULL AS VARCHAR) AS window_start, CAST(NULL AS VARCHAR) AS window_end,
       CAST(NULL AS VARCHAR) AS product_id FROM (SELECT DISTINCT user_id FROM uw)
UNION ALL SELECT 'review_windows', user_id, window_start, window_end, NULL FROM uw
UNION ALL SELECT 'products', NULL, NULL, NULL, product_id FROM (SELECT DISTINCT product_id FROM tgt)
UNION ALL SELECT 'active_in_window', user_id, window_start, window_end, NULL FROM uw
UNION ALL SELECT 'targeted_product', user_id, window_start, window_end, product_id FROM tgt"""))
def q_graph_nodes_edges(spark, sf_dir):
    return G.graph_long(day_graph(spark, sf_dir))


UPSERT_CTES = [*uw_ctes(86400), f"""b AS (
  SELECT *, CASE WHEN timestamp < '{SPLIT_TS}' THEN 0 ELSE 1 END AS batch_id,
         make_timestamp(CAST(floor(epoch_us(event_time) / 86400000000) AS BIGINT) * 86400000000) AS ws
  FROM parsed_ev WHERE rating <= 3)""", """bw AS (
  SELECT batch_id, user_id, strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start,
         strftime(ws + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS window_end,
         anonymous_user_id, count(*) AS low_rating_reviews_by_user_5m,
         count(DISTINCT product_id) AS distinct_products,
         CAST(count(DISTINCT product_id) AS INTEGER) AS num_products_in_window,
         CAST(max(CASE WHEN source = 'synthetic_spam' THEN 1 ELSE 0 END) AS INTEGER) AS source_spam_label
  FROM b GROUP BY batch_id, user_id, ws, anonymous_user_id)""", """latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, window_start, window_end ORDER BY batch_id DESC) AS rn FROM bw)
  WHERE rn = 1)""", """edges AS (
  SELECT DISTINCT user_id, strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, product_id FROM b)"""]
GRAPH_UPSERT_SQL = with_ctes(*UPSERT_CTES, body="""
SELECT l.user_id, l.window_start, l.window_end, anonymous_user_id, low_rating_reviews_by_user_5m,
       distinct_products, num_products_in_window,
       CAST(CASE WHEN low_rating_reviews_by_user_5m >= 3 THEN 1 ELSE 0 END AS INTEGER) AS burst_detected,
       CAST(CASE WHEN low_rating_reviews_by_user_5m >= 3 OR distinct_products >= 3 THEN 1 ELSE 0 END AS INTEGER) AS suspicious_user_flag,
       source_spam_label,
       (SELECT count(*) FROM edges e WHERE e.user_id = l.user_id AND e.window_start = l.window_start) AS num_targeted
FROM latest l""")


@query("graph_upsert", GRAPH_UPSERT_SQL)
def q_graph_upsert(spark, sf_dir):
    ev = events_stream(spark, sf_dir)
    b0 = W.user_windows(ev.filter(F.col("timestamp") < SPLIT_TS), DAY).withColumn("batch_id", F.lit(0))
    b1 = W.user_windows(ev.filter(F.col("timestamp") >= SPLIT_TS), DAY).withColumn("batch_id", F.lit(1))
    g = G.window_graph(b0.unionByName(b1), batch_col="batch_id")
    nt = g["targeted_product"].groupBy(*G.WINDOW_KEY).agg(F.count(F.lit(1)).alias("num_targeted"))
    return (g["review_windows"].join(nt, G.WINDOW_KEY, "left")
            .withColumn("num_targeted", F.coalesce("num_targeted", F.lit(0)))
            .drop("batch_id"))


REVIEW_GRAPH_SQL = with_ctes(REVIEWS_DOC_SQL, body="""
SELECT user_id, product_id, review_id, CAST(trunc(rating) AS INTEGER) AS rating, review_text, timestamp,
       coalesce(CAST(CAST(label AS BIGINT) AS VARCHAR), '') AS label, source
FROM reviews_doc
WHERE user_id IS NOT NULL AND trim(user_id) <> '' AND product_id IS NOT NULL AND trim(product_id) <> ''
  AND review_id IS NOT NULL AND trim(review_id) <> ''""")


@query("review_graph", REVIEW_GRAPH_SQL)
def q_review_graph(spark, sf_dir):
    return G.review_graph(reviews_doc(spark, sf_dir))["reviewed"]


@query("unique_audit", with_ctes(REVIEWS_DOC_SQL, body="""
SELECT 'user' AS kind, user_id AS key, count(*) AS occurrences FROM reviews_doc GROUP BY user_id HAVING count(*) > 1
UNION ALL
SELECT 'product', product_id, count(*) FROM reviews_doc GROUP BY product_id HAVING count(*) > 1"""))
def q_unique_audit(spark, sf_dir):
    r = reviews_doc(spark, sf_dir)
    u = G.check_unique(r, "user_id", "user").select("kind", F.col("user_id").alias("key"), "occurrences")
    p = G.check_unique(r, "product_id", "product").select("kind", F.col("product_id").alias("key"), "occurrences")
    return u.unionByName(p)


@query("user_features", _features_sql(UW_DAY))
def q_user_features(spark, sf_dir):
    g = day_graph(spark, sf_dir)
    return G.user_features(g["review_windows"], g["targeted_product"])


@query("user_features_hot", _features_sql(UW_DAY))
def q_user_features_hot(spark, sf_dir):
    """The same features from the graph written as tables and read back."""
    root = scratch_path(spark, f"graph-{uuid.uuid4().hex}")
    G.save_graph(day_graph(spark, sf_dir), root)
    g = G.load_graph(spark, root)
    return G.user_features(g["review_windows"], g["targeted_product"])


@query("user_pairs", with_ctes(*UW_DAY, body="""
SELECT user1, user2, common_products FROM (
  SELECT a.user_id AS user1, b.user_id AS user2, count(DISTINCT a.product_id) AS common_products
  FROM tgt a JOIN tgt b ON a.product_id = b.product_id AND a.user_id < b.user_id GROUP BY 1, 2)"""))
def q_user_pairs(spark, sf_dir):
    g = day_graph(spark, sf_dir)
    return G.user_pairs(G.user_product_edges(g["targeted_product"]))


@query("shared_users", with_ctes(*UW_DAY, body="""
SELECT a.user_id, count(DISTINCT b.user_id) AS num_other_users_shared_products
FROM tgt a JOIN tgt b ON a.product_id = b.product_id AND a.user_id <> b.user_id GROUP BY 1"""))
def q_shared_users(spark, sf_dir):
    g = day_graph(spark, sf_dir)
    return G.pair_features(G.user_product_edges(g["targeted_product"])).select(
        "user_id", "num_other_users_shared_products")


@query("max_overlap", with_ctes(*UW_DAY, body="""
SELECT user_id, max(c) AS max_common_products_with_any_user FROM (
  SELECT u1 AS user_id, c FROM (SELECT a.user_id AS u1, b.user_id AS u2, count(DISTINCT a.product_id) AS c
       FROM tgt a JOIN tgt b ON a.product_id = b.product_id AND a.user_id < b.user_id GROUP BY 1, 2)
  UNION ALL
  SELECT u2, c FROM (SELECT a.user_id AS u1, b.user_id AS u2, count(DISTINCT a.product_id) AS c
       FROM tgt a JOIN tgt b ON a.product_id = b.product_id AND a.user_id < b.user_id GROUP BY 1, 2))
GROUP BY user_id"""))
def q_max_overlap(spark, sf_dir):
    g = day_graph(spark, sf_dir)
    return G.pair_features(G.user_product_edges(g["targeted_product"])).select(
        "user_id", "max_common_products_with_any_user")


LI_EDGES = uw_ctes(30 * 86400, reviews_cte=REVIEWS_LI_SQL, reviews_name="reviews_li")


LI_PAIRS_SQL = "WITH " + ",\n".join(LI_EDGES) + """
, e AS (SELECT DISTINCT user_id, product_id FROM tgt)
, p AS (SELECT a.user_id AS u1, b.user_id AS u2, count(*) AS c
        FROM e a JOIN e b ON a.product_id = b.product_id AND a.user_id < b.user_id GROUP BY 1, 2)
SELECT user_id, count(DISTINCT other) AS num_other_users_shared_products,
       max(c) AS max_common_products_with_any_user
FROM (SELECT u1 AS user_id, u2 AS other, c FROM p UNION ALL SELECT u2, u1, c FROM p) GROUP BY 1"""


@query("user_pairs_lineitem", LI_PAIRS_SQL)
def q_user_pairs_lineitem(spark, sf_dir):
    from ..operators.wire import event_time, with_pseudonym
    r = with_pseudonym(event_time(reviews_li(spark, sf_dir)))
    uw = W.user_windows(r, W.WindowParams(duration="30 days"))
    g = G.window_graph(uw)
    return G.pair_features(G.user_product_edges(g["targeted_product"]))
