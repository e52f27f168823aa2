"""Exact top-k by inner product: M-trees searched best first.

floor(1024 * x) makes integer vectors. One more coordinate, sqrt(M^2 - |x|^2) for
stored vectors and 0 for queries, turns the largest inner product into the least Euclidean
distance, a metric. Vectors are dealt to shards by their nearest pivot; a shard is an M-tree
of paged nodes with routing objects, covering radii and parent distances. A search takes
the page with the least possible distance first and skips entries whose stored parent
distance already rules them out by the triangle inequality.

First every query searches its home shard; its k-th distance then bounds which shards can
hold something nearer, and only these are searched. Queries come in blocks.
"""

from __future__ import annotations

import heapq
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

SCALE, PAGE, SHARD, PIVOTS, SAMPLE, BLOCK = 1024, 512, 4096, 1024, 16_384, 4096
_EXACT = 2.0**53


def integer_rows(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, x array<long>, rid) of the vectors that take part: neither null nor holding null or non-finite components."""
    x = F.transform(F.col(vector), lambda v: v.cast("double"))
    bad = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    got = rows.select(F.col(vec_id).cast("long").alias("vec_id"), x.alias("x")).where(F.col("x").isNotNull() & F.col("vec_id").isNotNull()).where(~F.coalesce(bad, F.lit(True)))
    return got.select("vec_id", F.transform("x", lambda v: F.floor(v * SCALE).cast("long")).alias("x"), F.monotonically_increasing_id().alias("rid"))


def matrix(column, dim: int) -> np.ndarray:
    """Long matrix of an array column; shorter vectors read as ended by zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    out = np.zeros((len(column), dim), np.int64)
    size = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out[np.repeat(np.arange(len(out)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def lifted(x: np.ndarray, top: float) -> np.ndarray:
    """Points of the metric space: one coordinate more."""
    f = x.astype(np.float64)
    return np.concatenate([f, np.sqrt(np.maximum(top - (f * f).sum(1), 0))[:, None]], 1)


def build(points: np.ndarray, page: int = PAGE, seed: int = 1) -> list[dict]:
    """Nodes of an M-tree over ``points``, root first. A node: its entries' routing points or rows, distances to the
    node's own routing point (parent distances), covering radii and children (leaf: none)."""
    r, nodes = np.random.default_rng(seed), []

    def grow(rows: np.ndarray, centre: np.ndarray) -> int:
        me = len(nodes)
        nodes.append({})
        if len(rows) <= page:
            nodes[me] = {"rows": rows, "parent": np.linalg.norm(points[rows] - centre, axis=1)}
            return me
        picks = points[rows[r.choice(len(rows), min(page // 4, len(rows)), replace=False)]]
        near = np.argmin(((points[rows][:, None, :] - picks[None]) ** 2).sum(2), 1) if len(rows) <= 1024 else np.concatenate(
            [np.argmin((picks ** 2).sum(1) - 2 * points[b] @ picks.T, 1) for b in np.array_split(rows, len(rows) // 512)])
        if np.bincount(near).max() == len(rows):      # equal points: cut anyhow
            near = np.arange(len(rows)) * len(picks) // len(rows)
        kids = [(picks[c], rows[near == c]) for c in np.unique(near)]
        centres = np.array([c for c, _ in kids])
        nodes[me] = {"centres": centres, "parent": np.linalg.norm(centres - centre, axis=1), "radius": np.array([np.linalg.norm(points[m] - c, axis=1).max() for c, m in kids]),
                     "kids": [grow(m, c) for c, m in kids]}
        return me
    root = points.mean(0)
    grow(np.arange(len(points)), root)
    nodes[0]["centre"] = root
    return nodes


def search(nodes: list[dict], points: np.ndarray, ints: np.ndarray, ids: np.ndarray, q: np.ndarray, own: int, k: int, bound: float) -> list[tuple[int, int]]:
    """The k best (score, id) of the tree for one query, of those within distance ``bound``; ties to smaller ids."""
    p = np.append(q.astype(np.float64), 0.0)
    length = float(points[0] @ points[0])       # |x|^2 + a^2, the same for every stored point
    in_floats = length + float(p @ p) < _EXACT   # then no sum of products leaves what floats hold exactly
    slack = 1e-7 * np.sqrt(1 + length + float(p @ p))
    best: list[tuple[int, int]] = []        # heap of (score, -id)
    queue = [(0.0, 0, float(np.linalg.norm(p - nodes[0]["centre"])))]
    limit = bound + slack
    while queue:
        least, at, to_parent = heapq.heappop(queue)
        if least > limit:
            break
        node = nodes[at]
        gap = np.abs(to_parent - node["parent"])        # by the stored parent distances, without computing one
        if "kids" in node:
            maybe = np.nonzero(gap - node["radius"] <= limit)[0]
            far = np.linalg.norm(node["centres"][maybe] - p, axis=1)
            low = np.maximum(far - node["radius"][maybe], least)
            for i, d, b in zip(maybe.tolist(), far.tolist(), low.tolist()):
                if b <= limit:
                    heapq.heappush(queue, (b, node["kids"][i], d))
            continue
        rows = node["rows"][gap <= limit]
        rows = rows[ids[rows] != own]
        if not len(rows):
            continue
        score = (points[rows, :-1] @ p[:-1]).astype(np.int64) if in_floats else ints[rows] @ q
        if len(best) == k and int(score.max()) < best[0][0]:
            continue
        for i in np.lexsort((ids[rows], -score))[:k].tolist():
            entry = (int(score[i]), -int(ids[rows[i]]))
            if len(best) < k:
                heapq.heappush(best, entry)
            elif entry > best[0]:
                heapq.heapreplace(best, entry)
            else:
                break
        if len(best) == k:
            limit = min(limit, np.sqrt(max(length + float(p @ p) - 2 * best[0][0], 0.0)) + slack)
    return [(s, -i) for s, i in best]


def top_k(rows: DataFrame, every: int = 100, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest integer inner products of each query, ties to smaller vec_id.

    Queries are the rows whose id is divisible by ``every``; candidates are all rows with another id. Rows with a null id, or whose
    vector is null or holds null or non-finite components, take no part. Shorter vectors read as ended by zeros. Equal vectors are
    candidates each. A repeated row of a query asks once. Squared lengths must stay below 2**62. Fewer
    candidates than k: all of them. An empty table gives an empty result."""
    spark = rows.sparkSession
    data = saved(integer_rows(rows, vec_id, vector), "mtree")
    norm = F.aggregate(F.transform("x", lambda v: v.cast("double") * v), F.lit(0.0), lambda a, v: a + v)
    n, top, dim = data.agg(F.count("*"), F.max(norm), F.max(F.size("x"))).first()
    empty = "query_id long, rank int, vec_id long, score long"
    if not n:
        return spark.createDataFrame([], empty)
    dim = max(int(dim), 1)
    few = data.orderBy(F.xxhash64("vec_id")).limit(min(SAMPLE, 16 * -(-n // SHARD))).select("x").toArrow()
    r = np.random.default_rng(7)
    sample = lifted(matrix(few["x"], dim), top)
    pivots = sample[r.choice(len(sample), min(len(sample), max(1, min(PIVOTS, -(-n // SHARD)))), replace=False)]
    shared = spark.sparkContext.broadcast((pivots, dim, float(top)))

    def nearest(batches):
        pivots, dim, top = shared.value
        for b in batches:
            p = lifted(matrix(b.column(1), dim), top)
            d = np.sqrt(np.maximum((p * p).sum(1)[:, None] + (pivots * pivots).sum(1) - 2 * p @ pivots.T, 0))
            at = d.argmin(1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at.astype(np.int32)), pa.array(d[np.arange(len(d)), at])], ["vec_id", "x", "rid", "pivot", "far"])
    placed = saved(data.mapInArrow(nearest, "vec_id long, x array<long>, rid long, pivot int, far double"), "mtree")
    # a pivot with many vectors (a hot vector's copies) has several shards; at most PIVOTS rows come to the driver
    balls = {r.pivot: (r.far, -(-r.n // SHARD)) for r in placed.groupBy("pivot").agg(F.max("far").alias("far"), F.count("*").alias("n")).collect()}
    split = F.element_at(F.create_map(*[F.lit(int(v)) for p, (_, m) in balls.items() for v in (p, m)]), F.col("pivot"))
    stored = placed.withColumn("salt", F.pmod(F.xxhash64("rid"), split).cast("int"))
    queries = placed.where((F.col("vec_id") % every == 0)).select("vec_id", "x", "pivot").dropDuplicates(["vec_id", "x"])
    blocks = max(1, -(-queries.count() // BLOCK))
    queries = saved(queries.withColumn("block", F.pmod(F.xxhash64("vec_id", "x"), F.lit(blocks)).cast("int")), "mtree-queries")

    def plant(key, table):
        ints, ids = matrix(table["x"], dim), table["vec_id"].to_numpy()
        points = lifted(ints, top)
        blob = pickle.dumps((build(points), ints, ids), protocol=5)
        return pa.table({"pivot": table["pivot"][:1], "salt": table["salt"][:1], "tree": pa.array([blob], pa.binary())})
    trees = saved(stored.groupBy("pivot", "salt").applyInArrow(plant, "pivot int, salt int, tree binary"), "mtree-pages")

    def run(key, asked, tree):
        out: list[list] = [[], [], [], []]
        if len(asked) and len(tree):
            nodes, ints, ids = pickle.loads(tree["tree"][0].as_py())
            points = lifted(ints, top)
            for q, own, bound, x in zip(matrix(asked["x"], dim), asked["vec_id"].to_numpy(), asked["bound"].to_numpy(), asked["x"].to_pylist()):
                for s, i in search(nodes, points, ints, ids, q, own, k, bound):
                    for o, v in zip(out, (own, x, i, s)):
                        o.append(v)
        return pa.table([pa.array(o, t) for o, t in zip(out, (pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64()))], ["query_id", "x", "vec_id", "score"])

    def visit(asked: DataFrame) -> DataFrame:
        """``asked`` (vec_id, x, block, pivot, salt, bound): each query in the shards it names, by blocks."""
        keys = asked.select(F.col("pivot").alias("p"), F.col("salt").alias("s"), F.col("block").alias("b")).distinct()
        wanted = trees.join(keys, (F.col("pivot") == F.col("p")) & (F.col("salt") == F.col("s"))).select("p", "s", "b", "tree")
        return asked.groupBy("pivot", "salt", "block").cogroup(wanted.groupBy("p", "s", "b")).applyInArrow(run, "query_id long, x array<long>, vec_id long, score long")

    home = queries.withColumn("salt", F.pmod(F.xxhash64("vec_id"), split).cast("int")).withColumn("bound", F.lit(float("inf")))
    first = saved(visit(home), "mtree-home")
    worst = first.groupBy("query_id", F.col("x").alias("qx")).agg(F.count("*").alias("got"), F.min("score").alias("low"))
    asked = queries.join(worst, (F.col("vec_id") == F.col("query_id")) & (F.col("x") == F.col("qx")), "left")
    asked = asked.select("vec_id", "x", "block", "pivot", F.when(F.col("got") >= k, F.col("low")).alias("low"))

    def route(batches):
        pivots, dim, top = shared.value
        order = np.array(sorted(balls))
        radius, salts = np.array([balls[p][0] for p in order]), [balls[p][1] for p in order]
        for b in batches:
            q = matrix(b.column(1), dim).astype(np.float64)
            p = np.concatenate([q, np.zeros((len(q), 1))], 1)
            low = b.column(4).to_numpy(zero_copy_only=False).astype(np.float64)
            size = (q * q).sum(1)
            bound = np.where(np.isnan(low), np.inf, np.sqrt(np.maximum(top + size - 2 * low, 0)) + 1e-6 * np.sqrt(1 + top + size))
            d = np.sqrt(np.maximum(size[:, None] + (pivots[order] ** 2).sum(1) - 2 * p @ pivots[order].T, 0))
            hit = d - radius - 1e-6 * np.sqrt(1 + top + size)[:, None] <= bound[:, None]
            at, to = np.nonzero(hit)
            many = np.array([salts[t] for t in to], np.int64)
            at, to, salt = np.repeat(at, many), np.repeat(to, many), np.concatenate([np.arange(m) for m in many] or [np.zeros(0)])
            take = pa.array(at)
            yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), b.column(2).take(take), pa.array(order[to].astype(np.int32)), pa.array(salt.astype(np.int32)), pa.array(bound[at])],
                                             ["vec_id", "x", "block", "pivot", "salt", "bound"])
    routed = asked.mapInArrow(route, "vec_id long, x array<long>, block int, pivot int, salt int, bound double")
    routed = routed.join(home.select("vec_id", "x", "pivot", "salt"), ["vec_id", "x", "pivot", "salt"], "left_anti")
    found = first.unionByName(visit(routed))
    w = Window.partitionBy("query_id", "x").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS x FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p) WHERE rank <= 10"""
