"""User -> ReviewWindow -> Product graph as DataFrames, and per-user graph
features (A12, A14, A15, E8-E10, F1-F5, M1-M8).

Nodes and edges are plain DataFrames keyed like the graph's MERGE keys; an
upsert is a union followed by "latest batch wins" per key. The pair features
come from ``operators.overlap``, without user pairs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import USER_GRAPH_FEATURES
from ..session import checkpoint
from .dedupe import keep_max
from .overlap import pair_features, tiled_pairs
from .pairs import DEFAULT_CHUNK

WINDOW_KEY = ["user_id", "window_start", "window_end"]
WINDOW_PROPS = ["anonymous_user_id", "low_rating_reviews_by_user_5m", "distinct_products",
                "num_products_in_window", "burst_detected", "suspicious_user_flag", "source_spam_label"]
TS_TEXT = "yyyy-MM-dd HH:mm:ss"


def _ts_text(c: str):
    return F.date_format(F.col(c), TS_TEXT).alias(c)


def window_graph(uw: DataFrame, batch_col: str | None = None, materialize: bool = True) -> dict[str, DataFrame]:
    """Node and edge tables of one batch of user windows. Window times are
    stored as text, as the graph stores them. The window rows feed five
    tables, so they are checkpointed once (``materialize``) instead of
    being recomputed per table."""
    extra = [batch_col] if batch_col else []
    w = uw.select(
        "user_id", _ts_text("window_start"), _ts_text("window_end"),
        *[F.col(c) for c in WINDOW_PROPS if c in uw.columns], "product_ids", *extra,
    ).filter(F.col("user_id").isNotNull())
    if materialize:
        w = checkpoint(w)
    return upsert_window_graph(w, batch_col)


def upsert_window_graph(w: DataFrame, batch_col: str | None = "batch_id") -> dict[str, DataFrame]:
    """MERGE semantics over many batches: node properties come from the
    latest batch per key (SET overwrites), edges accumulate (MERGE never
    deletes). ``w`` holds window rows with text times and ``product_ids``."""
    if batch_col:
        latest = keep_max(w, WINDOW_KEY, [batch_col])
        # latest pseudonym per user as an aggregate (partial per task), so a
        # user with a huge number of windows is never gathered in one task
        users = w.groupBy("user_id").agg(
            F.max_by("anonymous_user_id", F.struct(F.col(batch_col), F.col("window_start"))).alias(
                "anonymous_user_id"))
    else:
        latest = w
        users = w.groupBy("user_id").agg(F.max("anonymous_user_id").alias("anonymous_user_id"))
    windows = latest.drop("product_ids", *( [batch_col] if batch_col else []))
    active = windows.select(*WINDOW_KEY)
    targeted = (w.select(*WINDOW_KEY, F.explode("product_ids").alias("product_id"))
                .filter(F.col("product_id").isNotNull()).distinct())
    products = targeted.select("product_id").distinct()
    return {"users": users, "review_windows": windows, "products": products,
            "active_in_window": active, "targeted_product": targeted}


def merged_graph(windows: DataFrame, targeted: DataFrame, batch_col: str = "batch_id") -> dict[str, DataFrame]:
    """MERGE over stored batches of window nodes and target edges: properties of the latest
    batch per key, edges accumulated; users and products follow from them."""
    latest = keep_max(windows, WINDOW_KEY, [batch_col]).drop(batch_col)
    users = windows.groupBy("user_id").agg(
        F.max_by("anonymous_user_id", F.struct(F.col(batch_col), F.col("window_start"))).alias("anonymous_user_id"))
    edges = targeted.drop(batch_col).distinct()
    return {"users": users, "review_windows": latest, "products": edges.select("product_id").distinct(),
            "active_in_window": latest.select(*WINDOW_KEY), "targeted_product": edges}


def save_graph(g: dict[str, DataFrame], root: str, mode: str = "overwrite") -> None:
    """Persist node and edge tables (one parquet table each) -- the stored
    graph that later feature jobs read instead of a graph server."""
    for name, df in g.items():
        df.write.mode(mode).parquet(f"{root}/{name}")


def load_graph(spark, root: str, names: tuple[str, ...] = ("users", "review_windows", "products",
                                                            "active_in_window", "targeted_product")) -> dict[str, DataFrame]:
    """Read a stored graph back as DataFrames (graph query source)."""
    return {n: spark.read.parquet(f"{root}/{n}") for n in names}


def graph_long(g: dict[str, DataFrame]) -> DataFrame:
    """All node and edge tables in one long table (kind + key columns)."""
    cols = ["user_id", "window_start", "window_end", "product_id"]

    def norm(df, kind):
        return df.select(F.lit(kind).alias("kind"),
                         *[(F.col(c) if c in df.columns else F.lit(None).cast("string")).alias(c)
                           for c in cols])
    return reduce(DataFrame.unionByName, [norm(g[k], k) for k in
                                          ("users", "review_windows", "products", "active_in_window",
                                           "targeted_product")])


def review_graph(reviews: DataFrame) -> dict[str, DataFrame]:
    """User -[REVIEWED {review_id}]-> Product from standardised reviews.
    Null or blank ids are skipped; rating truncated to int (null stays
    null); missing label becomes ''. Edge properties: last row per key wins
    (ordered by timestamp, then review text, for determinism)."""
    ok = reduce(lambda a, b: a & b, [F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != "")
                                     for c in ("user_id", "product_id", "review_id")])
    r = reviews.filter(ok).select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("product_id").cast("string").alias("product_id"),
        F.col("review_id").cast("string").alias("review_id"),
        F.col("rating").cast("double").try_cast("int").alias("rating"),
        F.col("review_text").cast("string").alias("review_text"),
        F.col("timestamp").cast("string").alias("timestamp"),
        F.coalesce(F.col("label").try_cast("bigint").cast("string"), F.lit("")).alias("label"),
        F.col("source").cast("string").alias("source"),
    )
    edges = keep_max(r, ["user_id", "product_id", "review_id"], ["timestamp", "review_text"])
    return {"users": r.select("user_id").distinct(), "products": r.select("product_id").distinct(),
            "reviewed": edges}


def check_unique(nodes: DataFrame, key: str | list[str], kind: str = "") -> DataFrame:
    """Uniqueness audit: keys occurring more than once."""
    keys = [key] if isinstance(key, str) else key
    return (nodes.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences"))
            .filter("occurrences > 1").withColumn("kind", F.lit(kind)))


# --------------------------------------------------------------------------
# Per-user features
# --------------------------------------------------------------------------

def window_features(windows: DataFrame, targeted: DataFrame) -> DataFrame:
    """M1-M5: one pass per table, no chain of six joins.

    Users without any window are absent (the window table is the base)."""
    per_window = targeted.groupBy(*WINDOW_KEY).agg(F.count_distinct("product_id").alias("_pc"))
    w = windows.select(*WINDOW_KEY, "suspicious_user_flag").join(per_window, WINDOW_KEY, "left")
    base = w.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("num_windows"),
        F.count_if(F.col("suspicious_user_flag") == 1).alias("num_suspicious_windows"),
        F.max(F.coalesce("_pc", F.lit(0))).alias("max_products_in_one_window"),
        F.avg(F.coalesce("_pc", F.lit(0))).alias("avg_products_per_window"),
    ).withColumn("has_multiple_suspicious_windows",
                 F.when(F.col("num_suspicious_windows") > 1, 1).otherwise(0))
    tp = targeted.join(windows.select(*WINDOW_KEY, "suspicious_user_flag"), WINDOW_KEY)
    prod = tp.groupBy("user_id").agg(
        F.count_distinct("product_id").alias("num_total_targeted_products"),
        F.count_distinct(F.when(F.col("suspicious_user_flag") == 1, F.col("product_id")))
        .alias("num_suspicious_products_targeted"),
    )
    return base.join(prod, "user_id", "left")


def user_product_edges(targeted: DataFrame) -> DataFrame:
    return targeted.select("user_id", "product_id").filter(
        F.col("user_id").isNotNull() & F.col("product_id").isNotNull()).distinct()


def user_pairs(edges: DataFrame, chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """(user1 < user2, common_products): distinct products both reach.

    This is the pair table itself, so its size is the output size; users are
    compared in tiles of two blocks of ``chunk``, and no pair is shuffled."""
    return tiled_pairs(edges, users=chunk)


def user_features(windows: DataFrame, targeted: DataFrame) -> DataFrame:
    """M8: window features left join pair features, nulls -> 0, all double."""
    wf = window_features(windows, targeted)
    pf = pair_features(user_product_edges(targeted))
    out = wf.join(pf, "user_id", "left")
    return out.select("user_id", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
                                   for c in USER_GRAPH_FEATURES])
