"""Embedding near-duplicates by a robust-pruned flat graph.

Equal vectors are one node. Centroids (fitted on a bounded sample) cut the nodes into overlapping
shards: a node is in the shards of its ``OVERLAP`` nearest centroids, a large
cluster in several salted shards. In each shard every node gets a robust-pruned neighbour list:
the nearest candidate first, then only those that no kept neighbour is much nearer to. The
lists of a node's shards are united. A query starts at the medoid of each shard of its
``probes`` nearest centroids, walks greedily along the united lists and goes on expanding
every node within reach of the threshold. Hits are verified by cosine in double precision. An
audit compares the linked nodes of a sample with brute force over all nodes; while recall is below the
target, more shards are probed, up to all. If the walks still miss too much there, every shard is compared whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, connected, merged, saved

DEGREE, POOL, ALPHA, BEAM, MARGIN = 24, 96, 1.2, 24, 0.05
OVERLAP, PROBES, CLUSTER, SHARD, CENTROIDS, SAMPLE = 2, 3, 1500, 4096, 1024, 16_384
AUDIT, TARGET = 64, 0.99
AUDIT_LINKED, AUDIT_MOST, SMALL = 16, 1024, 8    # linked nodes wanted in the audit, its largest sample, links of a small group's node


def unit(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    return x / np.linalg.norm(x, axis=1)[:, None]


def pruned_lists(x: np.ndarray) -> list[np.ndarray]:
    """Neighbour lists of unit vectors: candidates are a node's POOL nearest, robust-pruned to DEGREE, with the ways back."""
    n, pool = len(x), min(POOL, len(x) - 1)
    if n < 2:
        return [np.zeros(0, np.int64)] * n
    out, back = [], [[] for _ in range(n)]
    for lo in range(0, n, 512):
        sim = x[lo:lo + 512] @ x.T
        sim[np.arange(len(sim)), np.arange(lo, lo + len(sim))] = -2
        near = np.argpartition(-sim, pool - 1, 1)[:, :pool]
        own = np.take_along_axis(sim, near, 1)
        order = np.argsort(-own, 1)
        near, dist = np.take_along_axis(near, order, 1), np.sqrt(np.maximum(2 - 2 * np.take_along_axis(own, order, 1), 0))
        alive = np.ones(near.shape, bool)
        kept = [[] for _ in near]
        for _ in range(DEGREE):         # all nodes of the block side by side
            has = alive.any(1)
            if not has.any():
                break
            i = np.nonzero(has)[0]
            first = alive[i].argmax(1)
            pick = near[i, first]
            for a, p in zip(i.tolist(), pick.tolist()):
                kept[a].append(p)
            between = np.sqrt(np.maximum(2 - 2 * np.einsum("rpd,rd->rp", x[near[i]], x[pick]), 0))
            alive[i] &= ALPHA * between > dist[i]
            alive[i, first] = False
        out += [np.array(k, np.int64) for k in kept]
    for i, k in enumerate(out):
        for j in k.tolist():
            back[j].append(i)
    return [np.unique(np.concatenate([k, np.array(b[:DEGREE], np.int64)])) for k, b in zip(out, back)]


def range_search(x: np.ndarray, lists: np.ndarray, start: int, q: np.ndarray, threshold: float) -> np.ndarray:
    """Boolean (query, node): nodes found with similarity >= threshold.

    All queries walk side by side. A step expands a query's most similar open node; a query ends when that node
    is neither among its BEAM best nor within MARGIN of the threshold. ``lists`` has a row per node, ended by -1."""
    n = len(x)
    seen = np.full((len(q), n), -2.0)
    open_ = np.full((len(q), n), -2.0)
    seen[:, start] = open_[:, start] = q @ x[start]
    live = np.arange(len(q))
    while len(live):
        at = open_[live].argmax(1)
        s = open_[live, at]
        worst = np.partition(seen[live], n - BEAM, 1)[:, n - BEAM] if n > BEAM else np.full(len(live), -2.0)
        go = (s > -2) & ((s >= worst) | (s >= threshold - MARGIN))
        live, at = live[go], at[go]
        if not len(live):
            break
        open_[live, at] = -2
        to = lists[at]
        new = (to >= 0) & (seen[live[:, None], to] == -2)
        r, c = np.nonzero(new)
        node = to[r, c]
        sim = np.einsum("ij,ij->i", q[live[r]], x[node])
        seen[live[r], node] = open_[live[r], node] = sim
    return seen >= threshold


def near_duplicates(rows: DataFrame, threshold: float = 0.9, vec_id: str = "vec_id", vector: str = "embedding", target: float = TARGET) -> DataFrame:
    """One row per vector row: vec_id, n_links, component_id, kept.

    Links join vectors with cosine >= ``threshold`` in double precision, equal ones included. n_links counts other rows; component_id
    is the smallest vec_id reachable; kept: the row's id is its component's. Vectors that are null, empty, zero or hold null or
    non-finite components, or rows with a null id, link with nothing (null id: component_id null, kept false). Vectors link only
    with those of their own length: lengths are searched apart, the most frequent ones first. Repeated rows come back each and link with
    each other. An empty table gives an empty result."""
    x = F.transform(F.col(vector), lambda v: v.cast("double"))
    bad = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    data = rows.select(F.col(vec_id).cast("long").alias("vec_id"), x.alias("x"))
    good = F.col("vec_id").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0) & ~F.coalesce(bad, F.lit(True)) & F.exists("x", lambda v: v != 0)
    # a power of two brings the largest component near 1, so that no square overflows or vanishes
    largest = F.array_max(F.transform("x", F.abs))
    scale = F.pow(F.lit(2.0), F.floor(F.log2(largest)))
    scaled = F.transform("x", lambda v: v / scale)
    data = saved(data.withColumn("ok", F.coalesce(good, F.lit(False))).select("vec_id", "ok", F.when(F.col("ok"), scaled).alias("x"))
                 .withColumn("k1", F.xxhash64("x")).withColumn("k2", F.hash("x")), "vectors")
    nodes = saved(data.where("ok").groupBy("k1", "k2").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"), F.first("x").alias("x")), "vector-nodes")
    parts = []
    for dim, in nodes.groupBy(F.size("x").alias("d")).count().orderBy(F.col("count").desc()).select("d").collect():
        parts.append(_search_all(nodes.where(F.size("x") == dim), threshold, target))
    out = data.select("vec_id", "ok", "k1", "k2")
    if not parts:
        return out.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    links, edges = parts[0]
    for more in parts[1:]:
        links, edges = links.union(more[0]), edges.union(more[1])
    groups = connected(edges, "a", "b")
    known = nodes.select("k1", "k2", "node", "copies").join(merged(links.withColumnRenamed("node", "_n")), F.col("node") == F.col("_n"), "left").join(
        merged(groups.withColumnRenamed("node", "_g")), F.col("node") == F.col("_g"), "left")
    known = saved(known.select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), (F.col("copies") - 1 + F.coalesce("hits", F.lit(0))).alias("n"), F.coalesce("component", "node").alias("c")), "vector-links")
    out = out.join(merged(known), F.col("ok") & (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2")), "left")
    out = out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("c", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _search_all(nodes: DataFrame, threshold: float, target: float) -> tuple[DataFrame, DataFrame]:
    """(node, hits) and the links' spanning forests (a, b) of nodes of one length."""
    spark = nodes.sparkSession
    n = nodes.count()
    k = max(1, min(CENTROIDS, -(-n // CLUSTER)))
    few = unit(nodes.orderBy(F.xxhash64("node")).limit(min(SAMPLE, 32 * k)).select("x").toArrow()["x"])
    r = np.random.default_rng(11)
    centroids = few[r.choice(len(few), min(k, len(few)), replace=False)]
    for _ in range(8):
        at = np.concatenate([(few[lo:lo + 1024] @ centroids.T).argmax(1) for lo in range(0, len(few), 1024)])
        sums = np.zeros_like(centroids)
        np.add.at(sums, at, few)
        size = np.linalg.norm(sums, axis=1)
        centroids[size > 0] = sums[size > 0] / size[size > 0, None]
    shared = spark.sparkContext.broadcast(centroids)

    def nearest(first, last):
        """Nodes with their centroids from the ``first``-nearest on, up to ``last``."""
        def find(batches):
            c = shared.value
            for b in batches:
                near = np.argsort(-(unit(b.column(1)) @ c.T), 1, kind="stable")[:, first:last].astype(np.int32)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(list(near), pa.list_(pa.int32()))], ["node", "x", "near"])
        return nodes.select("node", "x").mapInArrow(find, "node long, x array<double>, near array<int>")
    overlap = min(OVERLAP, len(centroids))
    held = saved(nearest(0, overlap).select("node", "x", F.posexplode("near").alias("nth", "cluster")), "vector-near")
    # a row per centroid comes to the driver, CENTROIDS at most
    many = {c.cluster: max(1, -(-c.n // SHARD)) for c in held.groupBy("cluster").agg(F.count("*").alias("n")).collect()}
    split = F.element_at(F.create_map(*[F.lit(int(v)) for c, m in many.items() for v in (c, m)]), F.col("cluster"))
    held = saved(held.withColumn("salt", F.pmod(F.xxhash64("node"), split).cast("int")), "vector-shards")

    def lists(key, table):
        ids = table["node"].to_numpy()
        got = pruned_lists(unit(table["x"]))
        return pa.table({"node": ids, "to": pa.array([ids[g] for g in got], pa.list_(pa.int64()))})
    graph = held.groupBy("cluster", "salt").applyInArrow(lists, "node long, to array<long>").groupBy(F.col("node").alias("g")).agg(F.array_distinct(F.flatten(F.collect_list("to"))).alias("to"))
    stored = saved(held.join(merged(graph), F.col("node") == F.col("g")).select("cluster", "salt", "node", "x", "to", (F.col("nth") == 0).alias("home"))
                   .withColumnsRenamed({"cluster": "c", "salt": "s", "node": "id", "x": "y"}), "vector-graph")

    def search(asked, table, whole):
        """Rows (node, to) of the hits and (a, b) of their spanning forest; ``whole``: compare with all that are at home."""
        found: list[np.ndarray] = [np.zeros(0, np.int64)]
        of: list[np.ndarray] = [np.zeros(0, np.int64)]
        links: list[list] = [[], []]
        if len(asked) and len(table):
            ids, home = table["id"].to_numpy(), table["home"].to_numpy(zero_copy_only=False)
            x = unit(table["y"])
            order = np.argsort(ids)
            flat = table["to"].combine_chunks()
            to, sizes = flat.flatten().to_numpy(), np.diff(flat.offsets.to_numpy())
            place = np.minimum(np.searchsorted(ids, to, sorter=order), len(ids) - 1)
            place = np.where(ids[order[place]] == to, order[place], -1)       # a neighbour in another shard: not here
            rows_ = np.repeat(np.arange(len(ids)), sizes)
            adj = np.full((len(ids), max(int(sizes.max(initial=0)), 1)), -1, np.int64)
            adj[rows_, np.arange(len(to)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = place
            medoid = int((x @ x.mean(0)).argmax())
            q, qid = unit(asked["x"]), asked["node"].to_numpy()
            names = np.unique(np.concatenate([ids, qid]))
            lab = np.arange(len(names))
            mine, theirs = np.searchsorted(names, qid), np.searchsorted(names, ids)
            for lo in range(0, len(q), 256):
                part = q[lo:lo + 256]
                hit = (part @ x.T >= threshold) & home[None, :] if whole else range_search(x, adj, medoid, part, threshold)
                hit &= ids[None, :] != qid[lo:lo + 256, None]
                a, b = np.nonzero(hit)
                of.append(qid[lo + a])
                found.append(ids[b])
                if len(a):
                    lab = components(len(names), mine[lo + a], theirs[b], lab)
            up = np.nonzero(lab != np.arange(len(names)))[0]
            links = [names[up].tolist(), names[lab[up]].tolist()]
        none, gap = pa.nulls(sum(map(len, of)), pa.int64()), pa.nulls(len(links[0]), pa.int64())
        columns = [[np.concatenate(of), gap], [np.concatenate(found), gap], [none, links[0]], [none, links[1]]]
        return pa.table([pa.chunked_array([pa.array(c, pa.int64()) for c in two], pa.int64()) for two in columns], ["node", "to", "a", "b"])

    def walked(key, asked, table):
        return search(asked, table, False)

    def compared(key, asked, table):
        return search(asked, table, True)

    truth = _audit(nodes, n, threshold)
    salts = F.explode(F.sequence(F.lit(0), split - 1)).alias("salt")

    def probed(first, last, how):
        asked = nearest(first, last).select("node", "x", F.explode("near").alias("cluster")).where(F.col("cluster").isin(list(many))).select("node", "x", "cluster", salts)
        return saved(asked.groupBy("cluster", "salt").cogroup(stored.groupBy("c", "s")).applyInArrow(how, "node long, to long, a long, b long"), "vector-hits")

    got, done, probes = None, 0, min(PROBES, len(centroids))
    if not truth:      # nothing to measure the walks by
        got = probed(0, len(centroids), compared)
    while truth:
        more = probed(done, probes, walked)
        got = more if got is None else got.union(more)
        done, probes = probes, min(2 * probes, len(centroids))
        if _recall(got, truth) >= target:
            break
        if done == len(centroids):
            got = probed(0, done, compared)
            break
    # a link found in several shards, or from one side only, is one link of both
    once = got.where("node is not null").select(F.least("node", "to").alias("p"), F.greatest("node", "to").alias("q")).distinct()
    both = once.select(F.explode(F.array(F.struct(F.col("p").alias("node"), F.col("q").alias("to")), F.struct(F.col("q").alias("node"), F.col("p").alias("to")))).alias("e")).select("e.*")
    hits = both.join(merged(nodes.select(F.col("node").alias("to"), "copies")), "to").groupBy("node").agg(F.sum("copies").alias("hits"))
    return saved(hits, "vector-counts"), got.where("a is not null").select("a", "b")


def _audit(nodes: DataFrame, n: int, threshold: float) -> dict[int, int]:
    """The true number of linked nodes of a sample's nodes that have any. The sample grows from AUDIT until it has
    AUDIT_LINKED of them, to AUDIT_MOST. Without any, walks can't be measured, and all shards are compared whole."""
    size = AUDIT
    while True:
        sample = nodes.orderBy(F.hash("node"), "node").limit(size).select("node", "x").toArrow()
        x, ids = nodes.sparkSession.sparkContext.broadcast(unit(sample["x"])), sample["node"].to_numpy()

        def brute(batches, x=x, ids=ids):
            total = np.zeros(len(ids), np.int64)
            for b in batches:
                total += ((x.value @ unit(b.column(1)).T >= threshold) & (ids[:, None] != b.column(0).to_numpy()[None, :])).sum(1)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total)], ["node", "hits"])
        got = nodes.select("node", "x").mapInArrow(brute, "node long, hits long").groupBy("node").agg(F.sum("hits").alias("hits")).where("hits > 0").collect()
        if len(got) >= AUDIT_LINKED or size >= min(n, AUDIT_MOST):
            return {r.node: r.hits for r in got}
        size *= 4


def _recall(got: DataFrame, truth: dict[int, int]) -> float:
    """The lower of the mean shares found of all audited nodes and of those in small groups."""
    found = {r.node: r.n for r in got.where(F.col("node").isin(list(truth))).groupBy("node").agg(F.count_distinct("to").alias("n")).collect()}
    share = {i: found.get(i, 0) / t for i, t in truth.items()}
    small = [v for i, v in share.items() if truth[i] <= SMALL]
    return min(sum(v) / len(v) for v in (list(share.values()), small) if v)
