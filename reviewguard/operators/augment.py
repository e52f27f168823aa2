"""Replay-side operators: record validation, row slicing, labelled spam
injection, counters (C1-C5)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.hashing import unit_hash
from .ingest import not_blank
from .positions import row_positions

REQUIRED = ["review_id", "user_id", "product_id", "review_text", "timestamp"]

# Hours that injected reviews fall into.
SUSPICIOUS_HOURS = ["2024-04-01 10", "2024-04-01 14", "2024-04-02 09", "2024-04-02 19"]
# Ratings of injected reviews, drawn uniformly from this list.
INJECTED_RATINGS = [1, 1, 2, 2, 3]
# Review texts of injected reviews.
NEGATIVE_TEMPLATES = [
    "The quality is not as expected. It worked initially but had issues later.",
    "I am not fully satisfied with this product. It could be better.",
    "The product is okay, but I faced some performance problems.",
    "It doesn’t meet the expectations set by the description.",
    "The build quality seems a bit weak for the price.",
    "I had higher expectations, but the performance was average.",
    "It works, but not consistently. Sometimes it behaves unexpectedly.",
    "The product is usable, but there are noticeable issues.",
    "Not the best experience. It could definitely be improved.",
    "The item is average. Not bad, but not great either.",
    "I was disappointed with the performance after a few uses.",
    "The product feels less durable than I expected.",
    "It looked promising at first, but the overall experience was disappointing.",
    "I think the product is overpriced for what it offers.",
    "It performs the basic job, but I expected better quality.",
    "There are some issues that make it hard to recommend.",
    "The design is fine, but the reliability could be improved.",
    "I used it for a short time and started noticing problems.",
    "The item is usable, but not as good as the reviews suggested.",
    "The quality control could definitely be better.",
    "The product arrived fine, but the performance has not been consistent.",
    "This was not the experience I expected from the description.",
    "The overall quality feels average and not very durable.",
    "It works, but I am not completely satisfied with the results.",
    "There are some noticeable drawbacks after regular use.",
    "The product is acceptable, but I expected better performance.",
    "I would say the quality is just average for the price.",
    "The item has some useful aspects, but also several issues.",
    "It is not terrible, but it does not feel reliable enough.",
    "The product does the job, but only at a basic level.",
]
N_SPAM_USERS = 50
N_SPAM_PRODUCTS = 20


def valid_records(df: DataFrame, required: list[str] = REQUIRED) -> DataFrame:
    """Rows whose required fields are present and not blank."""
    return df.filter(reduce(lambda a, b: a & b, [not_blank(F.col(c)) for c in required]))


def slice_rows(df: DataFrame, order: list[str], start_row: int = 1, end_row: int = 0,
               max_rows: int = 0) -> DataFrame:
    """Rows start_row..end_row (1-based, in ``order``, 0 = to the end), then
    valid ones only, then the first ``max_rows`` valid ones (0 = all)."""
    if start_row < 1:
        raise ValueError("start_row must be 1 or greater")
    if end_row and end_row < start_row:
        raise ValueError("end_row must be 0 or >= start_row")
    d = row_positions(df, order, out_col="row_num")
    d = d.filter(F.col("row_num") >= start_row)
    if end_row:
        d = d.filter(F.col("row_num") <= end_row)
    d = valid_records(d)
    if max_rows:
        d = row_positions(d, ["row_num"], out_col="_k").filter(F.col("_k") <= max_rows).drop("_k")
    return d


def _pool_users() -> F.Column:
    # 50 ids of 28 characters from a fixed rule (no random state)
    ids = []
    for i in range(N_SPAM_USERS):
        h = F.sha2(F.lit(f"spam-user-{i}"), 512)
        ids.append(F.upper(F.substring(h, 1, 28)))
    return F.array(*ids)


def _pool_products() -> F.Column:
    return F.array(*[F.concat(F.lit("B0"), (F.pmod(F.xxhash64(F.lit(f"spam-product-{i}")), F.lit(90_000_000))
                                            + 10_000_000).cast("string")) for i in range(N_SPAM_PRODUCTS)])


def inject_spam(df: DataFrame, rate: float = 0.12, seed: int = 42) -> DataFrame:
    """Replace a seeded fraction ``rate`` of rows by injected spam: user,
    product, text, rating, time and source are drawn from the pools; the
    review id and label stay. Deterministic per review id, so a replay
    injects the same rows."""
    if not 0 <= rate <= 1:
        raise ValueError("rate must be within [0, 1]")
    rid = F.col("review_id")

    def draw(arr: F.Column, n: int, salt: int) -> F.Column:
        return F.get(arr, F.pmod(F.xxhash64(rid, F.lit(seed * 7919 + salt)), F.lit(n)).cast("int"))

    def num_draw(lo: int, hi: int, salt: int) -> F.Column:
        return F.pmod(F.xxhash64(rid, F.lit(seed * 7919 + salt)), F.lit(hi - lo + 1)) + lo

    hit = unit_hash(rid, seed) < F.lit(int(round(rate * 1_000_000)))
    ts = F.format_string("%s:%02d:%02d.%03d", draw(F.array(*map(F.lit, SUSPICIOUS_HOURS)), 4, 5),
                         num_draw(0, 44, 6), num_draw(0, 59, 7), num_draw(0, 999, 8))
    repl = {
        "user_id": draw(_pool_users(), N_SPAM_USERS, 1),
        "product_id": draw(_pool_products(), N_SPAM_PRODUCTS, 2),
        "review_text": draw(F.array(*map(F.lit, NEGATIVE_TEMPLATES)), len(NEGATIVE_TEMPLATES), 3),
        "rating": draw(F.array(*[F.lit(float(r)) for r in INJECTED_RATINGS]), len(INJECTED_RATINGS), 4),
        "timestamp": ts,
        "source": F.lit("synthetic_spam"),
    }
    return df.select(*[F.when(hit, repl[c]).otherwise(F.col(c)).alias(c) if c in repl else F.col(c)
                       for c in df.columns])


def _counters() -> list[F.Column]:
    inj = F.col("source") == "synthetic_spam"
    return [F.count(F.lit(1)).alias("sent"), F.count_if(~inj).alias("real_rows"), F.count_if(inj).alias("injected_rows")]


def counts(df: DataFrame) -> DataFrame:
    """sent / real / injected in one aggregate."""
    return df.agg(*_counters())


def observe_counts(df: DataFrame, seen: Observation) -> DataFrame:
    """``df`` unchanged; ``seen`` holds its sent / real / injected once an action has passed its rows."""
    return df.observe(seen, *_counters())
