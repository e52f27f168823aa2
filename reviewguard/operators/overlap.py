"""Shared products between users without user pairs.

Users with equal product sets are one row (``product_sets``: a 128-bit
fingerprint per user, merged per task). ``pair_features`` then counts in tiles (``tiled_overlap``): the sets are cut into
blocks of about ``BLOCK`` entries, and each pair of blocks is one task, which keeps only two numbers for each of its
sets. No pair of users, bitmap or candidate is ever shuffled, whatever the products' frequencies; a set is sent once per block.

Two other ways suit special inputs:

* ``shared_users`` (M6): the users of each product as bitmaps of 32,768
  neighbouring user numbers. A set's bitmaps, or-ed, count every user that shares
  a product. Users are numbered in the order of their sets, so a product touches few bitmaps.
* ``max_overlap`` (M7): for a set that several users have, its size. For others a
  search for the best partner that starts from a lower bound and looks only at partners that can beat it.

The bound, all from aggregates over the edges: any shared product gives 1; another set with the same k most
frequent products gives k; the largest set of each product, counted over the products for which it is that, gives the
count. Products are ordered rarest first. Two sets with more than L common products have their first common one at
places behind which both still hold L products: only such places meet. The most frequent product of a set is never
looked at, the second most frequent only where L is 1, and so on.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint
from .positions import row_positions

# tile functions travel with the task: workers need no copy of the library
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Parts of a hot key's rows where one fact per product or set is joined, and where places of two sets meet.
SALTS, PLACES = 16, 4
#: Entries (set, product) of a block of sets, and of a block of few sets, of which there are ``FEW`` at most.
BLOCK, SMALL_BLOCK, FEW = 4_000_000, 100_000, 16
#: Matches expanded at a time, and the most products for which sets are compared as matrices.
MATCHES, DENSE = 4_000_000, 4096


def _salts(n: int = SALTS) -> F.Column:
    return F.explode(F.array(*[F.lit(i).cast("long") for i in range(n)]))


def product_sets(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct product sets: (users: user_id, rep, size, users), (sets: rep, product_id, size, users).

    ``rep`` is the smallest user of the set, ``users`` how many have it. ``edges``: distinct user_id, product_id."""
    e = checkpoint(edges.select("user_id", "product_id"))
    marks = e.groupBy("user_id").agg(F.bit_xor(F.xxhash64("product_id")).alias("x"), F.bit_xor(F.xxhash64("product_id", F.lit(1))).alias("y"),
                                     F.count(F.lit(1)).alias("size"))
    sets = marks.groupBy("x", "y", "size").agg(F.min("user_id").alias("rep"), F.count(F.lit(1)).alias("users"))
    # a set that a third of all users have is joined in SALTS parts
    members = checkpoint(marks.withColumn("salt", F.pmod(F.xxhash64("user_id"), F.lit(SALTS).cast("long"))).join(
        sets.withColumn("salt", _salts()), ["x", "y", "size", "salt"]).select("user_id", "rep", "size", "users"))
    own = members.filter("user_id = rep").select("rep", "size", "users")
    return members, checkpoint(e.withColumnRenamed("user_id", "rep").join(own, "rep"))


def shared_users(edges: DataFrame, members: DataFrame, sets: DataFrame) -> DataFrame:
    """(rep, others): how many other users share a product with a user of the set."""
    ids = row_positions(members.select("rep", "user_id"), ["rep", "user_id"], out_col="uid").select("user_id", "uid")
    maps = edges.select("user_id", "product_id").join(ids, "user_id").groupBy("product_id", F.bitmap_bucket_number("uid").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("uid")).alias("bits"))
    met = sets.select("rep", "product_id").withColumn("salt", F.pmod(F.xxhash64("rep"), F.lit(SALTS).cast("long"))).join(
        maps.withColumn("salt", _salts()), ["product_id", "salt"])
    return met.groupBy("rep", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n")).groupBy("rep").agg((F.sum("n") - 1).alias("others"))


def placed(sets: DataFrame) -> DataFrame:
    """Products that two sets and more hold, with their place in each set, rarest first: rep, product_id, size, users, rest (products behind it)."""
    held = sets.groupBy("product_id").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    row = sets.withColumn("salt", F.pmod(F.xxhash64("rep"), F.lit(SALTS).cast("long"))).join(held.withColumn("salt", _salts()), ["product_id", "salt"])
    back = Window.partitionBy("rep").orderBy(F.col("df").desc(), F.col("product_id").desc())
    return checkpoint(row.select("rep", "product_id", "users", F.count(F.lit(1)).over(Window.partitionBy("rep")).alias("size"),
                                 (F.row_number().over(back) - 1).alias("rest"),
                                 F.bit_xor(F.xxhash64("product_id")).over(back.rowsBetween(Window.unboundedPreceding, 0)).alias("tail")))


def lower_bounds(at: DataFrame) -> DataFrame:
    """(rep, low): a number of common products that some other set reaches, at least 1."""
    row = at.groupBy("rep").agg(F.lit(1).alias("low"))
    ends = at.groupBy("rest", "tail").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("rest", "tail")
    # as many facts as ends that recur, so they aren't copied; of an end that very many sets have Spark splits the other side
    same_end = at.select("rep", "rest", "tail").join(ends, ["rest", "tail"]).groupBy("rep").agg((F.max("rest") + 1).alias("low"))
    largest = at.groupBy("product_id").agg(F.max(F.struct("size", "rep"))["rep"].alias("other"))
    counted = at.select("rep", "product_id").withColumn("salt", F.pmod(F.xxhash64("rep"), F.lit(SALTS).cast("long"))).join(
        largest.withColumn("salt", _salts()), ["product_id", "salt"]).filter("rep != other").groupBy("rep", "other").agg(F.count(F.lit(1)).alias("low"))
    parts = [row, same_end, counted.groupBy("rep").agg(F.max("low").alias("low"))]
    return reduce(DataFrame.unionByName, [p.select("rep", F.col("low").cast("int").alias("low")) for p in parts]).groupBy("rep").agg(F.max("low").alias("low"))


def candidates(at: DataFrame, low: DataFrame) -> DataFrame:
    """(rep, other, met): sets that may share more than ``low`` products with a set that one user has.

    ``met`` counts the common places behind which both still hold ``low`` products. All others are among the last
    ``low`` common ones, so two sets share ``met`` to ``met`` + ``low`` products: who can't beat the largest ``met`` is left out."""
    asked = at.filter("users = 1").join(low, "rep").filter((F.col("rest") >= F.col("low")) & (F.col("size") > F.col("low")))
    asked = asked.select("rep", "product_id", "low").withColumn("salt", _salts(PLACES))
    held = at.filter("rest >= 1").select(F.col("rep").alias("other"), "product_id", F.col("rest").alias("behind")).withColumn(
        "salt", F.pmod(F.xxhash64("other"), F.lit(PLACES).cast("long")))
    places = asked.join(held, ["product_id", "salt"]).filter((F.col("behind") >= F.col("low")) & (F.col("rep") != F.col("other")))
    met = checkpoint(places.groupBy("rep", "other", "low").agg(F.count(F.lit(1)).alias("met")))
    best = met.groupBy("rep").agg(F.max("met").alias("best"))
    return met.join(best, "rep").filter(F.col("met") + F.col("low") > F.col("best")).select("rep", "other", "met")


def max_overlap(at: DataFrame) -> DataFrame:
    """(rep, most): the most products that a user of the set shares with any other user."""
    low = checkpoint(lower_bounds(at))
    met = candidates(at, low)
    arrays = at.groupBy("rep").agg(F.collect_list(F.xxhash64("product_id")).alias("held"))
    sizes = met.join(arrays, "rep").join(arrays.select(F.col("rep").alias("other"), F.col("held").alias("theirs")), "other").groupBy("rep").agg(
        F.max(F.size(F.array_intersect("held", "theirs"))).alias("found"))
    return low.join(sizes, "rep", "left").select("rep", F.greatest("low", F.coalesce("found", F.lit(0))).cast("long").alias("most"))


def _flat(lists: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of each entry of a list column."""
    lists = lists.combine_chunks()
    return np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False)), lists.flatten().to_numpy()


def _matches_dense(left, right, n, m, products):
    """Yields (rows, columns, common products) of the sets that share some, by products of 0/1 matrices."""
    def block(rows, cols, lo, hi):
        a, b = np.searchsorted(rows, (lo, hi))
        x = np.zeros((hi - lo, products), np.float32)
        x[rows[a:b] - lo, cols[a:b]] = 1
        return x
    for c in range(0, m, 4096):
        y = block(*right, c, min(c + 4096, m)).T
        for r in range(0, n, 1024):
            yield r, c, block(*left, r, min(r + 1024, n)) @ y


def _matches_sparse(left, right, n, m, products):
    """Yields (rows, columns, common products) of the sets that share some, by the sets of each product."""
    rows, cols = left
    order = np.argsort(right[1], kind="stable")
    holders, counts = right[0][order], np.bincount(right[1], minlength=products)
    starts = np.cumsum(counts) - counts
    each = counts[cols]
    upto = np.concatenate(([0], np.cumsum(each)))
    first = np.searchsorted(rows, np.arange(n + 1))     # entries of row r: first[r] to first[r + 1]
    r = 0
    while r < n:
        end = max(r + 1, int(np.searchsorted(upto[first], upto[first[r]] + MATCHES, "right")) - 1)
        a, b = first[r], first[end]
        k = each[a:b]
        at = np.arange(k.sum()) + np.repeat(starts[cols[a:b]] - (np.cumsum(k) - k), k)
        pair, common = np.unique(np.repeat(rows[a:b], k) * m + holders[at], return_counts=True)
        yield pair // m, pair % m, common
        r = end


def tile_overlaps(left: pa.ChunkedArray, right: pa.ChunkedArray | None, weights: np.ndarray, other_weights: np.ndarray | None) -> tuple:
    """(others, most) of the left and of the right sets: the weights of the sets of the other side that share a product, and the most
    products shared with one of them. Without a right side the left sets meet each other, and none itself."""
    same = right is None
    x = _flat(left)
    y = x if same else _flat(right)
    n, m = len(left), len(left) if same else len(right)
    v, w = weights.astype(np.float64), (weights if same else other_weights).astype(np.float64)
    others, most, others2, most2 = np.zeros(n), np.zeros(n, np.int64), np.zeros(m), np.zeros(m, np.int64)
    known, number = np.unique(np.concatenate([x[1], y[1]]), return_inverse=True)
    x, y = (x[0], number[:len(x[0])]), (y[0], number[len(x[0]):])
    products = len(known)
    met = int(np.bincount(x[1], minlength=products).astype(np.float64) @ np.bincount(y[1], minlength=products))
    if products <= DENSE and met * 30 > n * m * (2 + products / 25):      # nanoseconds of either way
        for r, c, common in _matches_dense(x, y, n, m, products):
            if same:
                d = np.arange(max(r, c), min(r + common.shape[0], c + common.shape[1]))
                common[d - r, d - c] = 0
            rows, cols, shared = slice(r, r + common.shape[0]), slice(c, c + common.shape[1]), (common > 0).astype(np.float64)
            others[rows] += shared @ w[cols]
            others2[cols] += v[rows] @ shared
            most[rows] = np.maximum(most[rows], common.max(axis=1))
            most2[cols] = np.maximum(most2[cols], common.max(axis=0))
    elif met:
        for rows, cols, common in _matches_sparse(x, y, n, m, products):
            if same:
                rows, cols, common = (z[rows != cols] for z in (rows, cols, common))
            others += np.bincount(rows, w[cols], n)
            others2 += np.bincount(cols, v[rows], m)
            np.maximum.at(most, rows, common)
            np.maximum.at(most2, cols, common)
    return (others.astype(np.int64), most), (others2.astype(np.int64), most2)


def _numbered(sets: DataFrame, rep: str, *others: str) -> DataFrame:
    """One row of each set (``rep``) that holds a product of two sets and more: its numbers as ``products``, and the ``others`` columns."""
    held = sets.groupBy("product_id").agg(F.count(F.lit(1)).alias("df")).filter("df > 1").select("product_id")
    held = row_positions(held, ["product_id"], out_col="number").select("product_id", F.col("number").cast("int").alias("number"), _salts().alias("salt"))
    return checkpoint(sets.withColumn("salt", F.pmod(F.xxhash64(rep), F.lit(SALTS).cast("long"))).join(held, ["product_id", "salt"]).groupBy(rep).agg(
        *[F.first(c).alias(c) for c in others], F.collect_list("number").alias("products")))


def tile_pairs(left: pa.ChunkedArray, right: pa.ChunkedArray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row of left, row of right, common products) of the sets that share some, a bounded number at a time."""
    x, y, n, m = _flat(left), _flat(right), len(left), len(right)
    known, number = np.unique(np.concatenate([x[1], y[1]]), return_inverse=True)
    x, y = (x[0], number[:len(x[0])]), (y[0], number[len(x[0]):])
    products = len(known)
    met = float(np.bincount(x[1], minlength=products).astype(np.float64) @ np.bincount(y[1], minlength=products))
    if products <= DENSE and met * 30 > n * m * (2 + products / 25):      # nanoseconds of either way
        for r, c, common in _matches_dense(x, y, n, m, products):
            for lo in range(0, len(common), 64):
                i, j = np.nonzero(common[lo:lo + 64])
                yield r + lo + i, c + j, common[lo + i, j].astype(np.int64)
    elif met:
        yield from _matches_sparse(x, y, n, m, products)


def tiled_pairs(edges: DataFrame, block: int = BLOCK, users: int = 4096) -> DataFrame:
    """(user1 < user2, common_products) of all users that share a product. ``edges``: distinct user_id, product_id.

    Users are dealt into blocks of about ``users`` of them and ``block`` entries; a task has two blocks and puts each of their pairs out
    once, counted, a bounded number at a time. So no pair is shuffled, and a user's products are sent once a block."""
    rows = _numbered(edges.filter(F.col("user_id").isNotNull() & F.col("product_id").isNotNull()).select("user_id", "product_id"), "user_id")
    have, entries = rows.agg(F.count(F.lit(1)), F.sum(F.size("products"))).first()
    n = max(1, -(-have // users), -(-(entries or 0) // block), min(4, -(-have // 256)))
    mine, other = F.pmod(F.xxhash64("user_id"), F.lit(n)), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    dealt = rows.withColumn("block", mine).withColumn("other", other).select(
        "user_id", "products", (F.least("block", "other") * n + F.greatest("block", "other")).alias("tile"), (F.col("block") <= F.col("other")).alias("left"))
    kind = rows.schema["user_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(list(batches))
        a = t.filter(t["left"])
        diagonal = t["tile"][0].as_py() // n == t["tile"][0].as_py() % n
        b = a if diagonal else t.filter(pc.invert(t["left"]))
        if not (len(a) and len(b)):
            return
        one, two = a["user_id"].combine_chunks(), b["user_id"].combine_chunks()
        rank = np.empty(len(one) + len(two), np.int64)
        rank[pc.sort_indices(pa.concat_arrays([one, two])).to_numpy()] = np.arange(len(rank))
        for i, j, common in tile_pairs(a["products"], b["products"]):
            if diagonal:
                keep = i < j
                i, j, common = i[keep], j[keep], common[keep]
            first = rank[i] < rank[len(one) + j]      # of one tile's users: in a diagonal one the two sides' ranks are in the same order
            for u, v, turned in ((one.take(pa.array(i[first])), two.take(pa.array(j[first])), common[first]),
                                 (two.take(pa.array(j[~first])), one.take(pa.array(i[~first])), common[~first])):
                for lo in range(0, len(u), 65_536):
                    yield pa.RecordBatch.from_arrays([u[lo:lo + 65_536], v[lo:lo + 65_536], pa.array(turned[lo:lo + 65_536], pa.int64())],
                                                     ["user1", "user2", "common_products"])

    tiles = n * (n + 1) // 2
    return dealt.repartition(1 if n == 1 else min(2 * tiles, 4096), "tile").groupBy("tile").applyInArrow(run, f"user1 {kind}, user2 {kind}, common_products long")


def tiled_overlap(sets: DataFrame, block: int = BLOCK, small: int = SMALL_BLOCK) -> DataFrame:
    """(rep, others, most): how many users of other sets share a product with the set, and the most products that another set shares.

    Sets that share no product may be absent. ``sets`` as from ``product_sets``."""
    rows = _numbered(sets, "rep", "users")
    entries = rows.agg(F.sum(F.size("products"))).first()[0] or 0
    n = max(1, -(-entries // block), min(FEW, -(-entries // small)))
    mine, other = F.pmod(F.xxhash64("rep"), F.lit(n)), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    dealt = rows.withColumn("block", mine).withColumn("other", other).select(
        "rep", "users", "products", (F.least("block", "other") * n + F.greatest("block", "other")).alias("tile"), (F.col("block") <= F.col("other")).alias("left"))
    kind = rows.schema["rep"].dataType.simpleString()

    def run(t: pa.Table) -> pa.Table:
        a, b = t.filter(t["left"]), t.filter(pc.invert(t["left"]))
        diagonal = t["tile"][0].as_py() // n == t["tile"][0].as_py() % n
        if not diagonal and not (len(a) and len(b)):
            a = b = t.slice(0, 0)
        got = tile_overlaps(a["products"], None if diagonal else b["products"], a["users"].to_numpy(), None if diagonal else b["users"].to_numpy()) if len(a) else ()
        parts = [pa.table({"rep": x["rep"], "others": pa.array(o), "most": pa.array(k)}) for x, (o, k) in zip([a] if diagonal else [a, b], got)]
        return pa.concat_tables(parts or [pa.table({"rep": t["rep"].slice(0, 0), "others": pa.array([], pa.int64()), "most": pa.array([], pa.int64())})])

    tiles = n * (n + 1) // 2
    got = dealt.repartition(1 if n == 1 else 2 * tiles, "tile").groupBy("tile").applyInArrow(run, f"rep {kind}, others long, most long")
    return got.groupBy("rep").agg(F.sum("others").alias("others"), F.max("most").alias("most"))


def pair_features(edges: DataFrame) -> DataFrame:
    """Per user ``num_other_users_shared_products`` and ``max_common_products_with_any_user``, exactly.

    ``edges``: distinct user_id, product_id. Users that share no product with anyone are absent; the caller fills 0."""
    members, sets = product_sets(edges)
    per_set = tiled_overlap(sets).withColumn("salt", _salts())
    out = members.withColumn("salt", F.pmod(F.xxhash64("user_id"), F.lit(SALTS).cast("long"))).join(per_set, ["rep", "salt"], "left")
    # the other users of the same set share it too, whole
    others = F.coalesce("others", F.lit(0).cast("long")) + F.col("users") - 1
    return out.select("user_id", others.alias("num_other_users_shared_products"),
                      F.when(F.col("users") > 1, F.col("size")).otherwise(F.col("most")).alias("max_common_products_with_any_user")).filter(
                          "num_other_users_shared_products > 0")
