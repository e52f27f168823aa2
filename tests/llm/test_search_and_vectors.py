import numpy as np

from reviewguard.llm import mtree, vectors
from reviewguard.llm.common import components
from reviewguard.llm.queries import ORACLE, QUERIES

from .conftest import SF

SCHEMA = "vec_id long, embedding array<float>, rank int, x string"
NAN, INF = float("nan"), float("inf")


def brute_top(rows, k=10):
    ok = [(i, [int(np.floor(1024 * float(np.float32(v)))) for v in e]) for i, e in rows if i is not None and e is not None and all(v is not None and np.isfinite(v) for v in e)]
    out = []
    for q, a in ok:
        if q % 100 == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in ok if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def edge_vectors():
    r = np.random.default_rng(3)
    rows = [(i, r.normal(size=4).astype(np.float32).tolist()) for i in range(1, 120)]
    rows += [(200, rows[4][1])] + [(300 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(30)]      # equal vectors, ties
    return rows + [(500, None), (600, [1.0, None, 2.0, 3.0]), (700, [NAN, 1.0, 1.0, 1.0]), (701, [INF, 0.0, 0.0, 0.0]), (800, [0.0] * 4), (None, [1.0] * 4), (900, [1e5, -1e5, 0.5, 3.0])]


def test_top_k_edge_rows(spark):
    rows = edge_vectors()
    df = spark.createDataFrame([(i, e, 0, "") for i, e in rows], SCHEMA)
    got = mtree.top_k(df).select("query_id", "rank", "vec_id", "score")
    assert sorted(map(tuple, got.collect())) == brute_top(rows)
    assert mtree.top_k(df.limit(0)).count() == 0
    assert sorted(map(tuple, mtree.top_k(df.where("vec_id in (200, 300, 301)")).select("query_id", "rank", "vec_id", "score").collect())) == brute_top([x for x in rows if x[0] in (200, 300, 301)])


def test_tree_search_is_exact():
    r = np.random.default_rng(5)
    x = r.integers(-900, 900, (3000, 6))
    top = float((x * x).sum(1).max())
    points, ids = mtree.lifted(x, top), np.arange(3000)
    nodes = mtree.build(points, page=32)
    for q in range(0, 3000, 271):
        got = mtree.search(nodes, points, x, ids, x[q], q, 10, np.inf)
        assert sorted((-s, i) for s, i in got) == sorted((-int(x[i] @ x[q]), i) for i in ids if i != q)[:10]


def test_top_k_query_is_registered_with_sql(spark):
    assert "op1_exact_top_k" in ORACLE and QUERIES["op1_exact_top_k"](spark, SF).count() == 50


def brute_links(rows, t=0.9):
    ok = [i for i, (d, e) in enumerate(rows) if d is not None and e and all(v is not None and np.isfinite(v) for v in e) and any(e)]
    x = np.array([rows[i][1] for i in ok], float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    hit = x @ x.T >= t - 1e-12
    np.fill_diagonal(hit, False)
    lab = components(len(ok), *np.nonzero(hit))
    out = {i: (d, 0, d, d is not None) for i, (d, _) in enumerate(rows)}
    for a, i in enumerate(ok):
        least = min(rows[ok[b]][0] for b in np.nonzero(lab == lab[a])[0])
        out[i] = (rows[i][0], int(hit[a].sum()), least, rows[i][0] == least)
    return sorted(out.values(), key=str)


def test_links_of_many_clusters(spark, monkeypatch):
    """More centroids than 12, a target of all links: probes grow until every link is found, however many shards that takes."""
    r = np.random.default_rng(4)
    monkeypatch.setattr(vectors, "CLUSTER", 30)
    base = r.normal(size=(300, 6))
    base /= np.linalg.norm(base, axis=1)[:, None]
    rows = [(i, (base[i % 300] + 0.1 * r.normal(size=6)).astype(np.float32).tolist()) for i in range(1200)]
    df = spark.createDataFrame([(i, e, 0, "") for i, e in rows], SCHEMA)
    got = vectors.near_duplicates(df, threshold=0.8, target=1.0).select("vec_id", "n_links", "component_id", "kept")
    truth = brute_links(rows, 0.8)
    got = sorted(map(tuple, got.collect()), key=str)
    assert sum(g[1] for g in got) >= 0.999 * sum(t[1] for t in truth) and all(g[1] <= t[1] for g, t in zip(got, truth))


def test_walks_that_miss_give_way_to_whole_shards(spark, monkeypatch):
    r = np.random.default_rng(6)
    monkeypatch.setattr(vectors, "CLUSTER", 20)
    monkeypatch.setattr(vectors, "range_search", lambda x, lists, start, q, threshold: np.zeros((len(q), len(x)), bool))
    rows = [(i, r.normal(size=3).astype(np.float32).tolist()) for i in range(400)]
    df = spark.createDataFrame([(i, e, 0, "") for i, e in rows], SCHEMA)
    assert sorted(map(tuple, vectors.near_duplicates(df).select("vec_id", "n_links", "component_id", "kept").collect()), key=str) == brute_links(rows)


def test_few_links_that_an_audit_misses(spark, monkeypatch):
    """12 pairs just above the threshold among 3,000 vectors in many clusters: no sampled node has a link, yet every link is found, from both sides."""
    r = np.random.default_rng(2)
    monkeypatch.setattr(vectors, "CLUSTER", 150)
    monkeypatch.setattr(vectors, "AUDIT", 8)
    monkeypatch.setattr(vectors, "AUDIT_MOST", 8)
    x = r.normal(size=(3000, 48))
    x /= np.linalg.norm(x, axis=1)[:, None]
    for i in range(12):
        side = r.normal(size=48)
        side -= side @ x[i] * x[i]
        x[1000 + i] = 0.905 * x[i] + np.sqrt(1 - 0.905 ** 2) * side / np.linalg.norm(side)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = {g[0]: tuple(g) for g in vectors.near_duplicates(spark.createDataFrame([(i, e, 0, "") for i, e in rows], SCHEMA)).select("vec_id", "n_links", "component_id", "kept").collect()}
    want = {i: (i, 1, i % 1000, i < 1000) if i % 1000 < 12 and i < 1012 and (i < 12 or i >= 1000) else (i, 0, i, True) for i in range(3000)}
    assert got == want


def test_links_count_from_both_sides(spark, monkeypatch):
    """Walks that find a link from its larger id only: both ends count it."""
    r = np.random.default_rng(5)
    base = r.normal(size=(20, 8))
    rows = [(i, (base[i % 20] + 0.02 * r.normal(size=8)).tolist()) for i in range(80)]
    real = vectors.range_search

    def one_sided(x, lists, start, q, threshold):
        hit = real(x, lists, start, q, threshold)
        same = [int(np.argmax(x @ v)) for v in q]
        return hit & (np.arange(len(x))[None, :] <= np.array(same)[:, None])
    monkeypatch.setattr(vectors, "range_search", one_sided)
    got = vectors.near_duplicates(spark.createDataFrame([(i, e, 0, "") for i, e in rows], SCHEMA), target=0.0).select("vec_id", "n_links", "component_id", "kept")
    assert sorted(map(tuple, got.collect()), key=str) == brute_links(rows)


def test_near_duplicate_edge_rows(spark):
    r = np.random.default_rng(9)
    base = r.normal(size=(12, 8))
    rows = [(100 - i, (base[i % 12] + 0.05 * r.normal(size=8)).astype(np.float32).tolist()) for i in range(60)]
    rows += [(300 + i, rows[0][1]) for i in range(20)] + [(500, None), (501, [0.0] * 8), (502, [NAN] * 8), (503, [INF] + [0.0] * 7), (504, [None] + [1.0] * 7), (505, []), (None, [1.0] * 8), (300, rows[0][1])]
    df = spark.createDataFrame([(i, e, 0, "") for i, e in rows], SCHEMA)
    got = vectors.near_duplicates(df).select("vec_id", "n_links", "component_id", "kept")
    assert sorted(map(tuple, got.collect()), key=str) == brute_links(rows)
    assert vectors.near_duplicates(df.limit(0)).count() == 0
