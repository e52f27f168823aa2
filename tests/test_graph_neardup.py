import itertools
import random

from pyspark.sql import functions as F

from reviewguard.functions.text import clean_for_shingles
from reviewguard.operators import graph as G
from reviewguard.operators import neardup as N
from reviewguard.operators import overlap as O


def brute_pairs(edges):
    by_user = {}
    for u, p in edges:
        by_user.setdefault(u, set()).add(p)
    m6, m7 = {}, {}
    for a, b in itertools.combinations(sorted(by_user), 2):
        c = len(by_user[a] & by_user[b])
        if c:
            for x in (a, b):
                m6[x] = m6.get(x, 0) + 1
                m7[x] = max(m7.get(x, 0), c)
    return m6, m7


def skewed_edges(rng, users):
    """Products 0 and 1 are hot, a third of the users have nothing else; the rest is sparse, with some large baskets."""
    edges = set()
    for u in range(users):
        n = rng.choice([1, 2, 3, 5, 8, 20])
        for _ in range(n):
            p = rng.choice([0, 0, 1, 1, *range(2, 12), *range(12, 12 + users)])
            edges.add((f"u{u}", f"p{p}"))
    return edges | {(f"h{u}", p) for u in range(users // 2) for p in ("p0", "p1")} | {("lonely", "only"), ("twin1", "t"), ("twin2", "t")}


def test_pair_features_equal_brute_force(spark):
    for seed, users in ((5, 60), (6, 25), (7, 120)):
        edges = skewed_edges(random.Random(seed), users)
        df = spark.createDataFrame(sorted(edges), "user_id string, product_id string")
        m6, m7 = brute_pairs(edges)
        got = {r.user_id: (r.num_other_users_shared_products, r.max_common_products_with_any_user) for r in G.pair_features(df).collect()}
        assert got == {u: (m6[u], m7[u]) for u in m6}
    assert G.pair_features(df.limit(0)).count() == 0
    pairs = {(r.user1, r.user2): r.common_products for r in G.user_pairs(df, chunk=3).collect()}
    by_user = {}
    for u, p in edges:
        by_user.setdefault(u, set()).add(p)
    exp = {(a, b): len(by_user[a] & by_user[b]) for a, b in itertools.combinations(sorted(by_user), 2)
           if by_user[a] & by_user[b]}
    assert pairs == exp


def test_overlap_search_looks_at_few_pairs(spark):
    """On a skewed table of 1,500 users the search verifies a small share of the pairs that share a product, from true lower bounds."""
    edges = skewed_edges(random.Random(8), 1000)
    df = spark.createDataFrame(sorted(edges), "user_id string, product_id string")
    members, sets = O.product_sets(df)
    at = O.placed(sets)
    low = O.lower_bounds(at)
    _, m7 = brute_pairs(edges)
    assert members.count() == len({u for u, _ in edges}) and sets.select("rep").distinct().count() < members.count() / 1.4
    assert all(r.low <= m7[r.rep] for r in low.collect() if r.rep in m7)
    met = O.candidates(at, low).count()
    users = G.user_pairs(df).count()
    print(f"candidates: {met} of {2 * users} ordered pairs of users that share a product")
    assert met < 2 * users / 10


def test_pair_features_plan_has_no_self_join_of_users(spark):
    df = spark.createDataFrame(sorted(skewed_edges(random.Random(9), 30)), "user_id string, product_id string")
    members, sets = O.product_sets(df)
    plan = O.shared_users(df, members, sets)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("bitmap_construct_agg") and plan.count("bitmap_or_agg") and "user_id_b" not in plan


def test_mllib_pairs_are_exact_pairs(spark):
    from conftest import SF
    from reviewguard.sources.tables import reviews_doc
    prep = N.prepare(reviews_doc(spark, SF))
    key = ["review_id_left", "review_id_right", "jaccard_distance"]
    exact = {tuple(r) for r in N.pairs_exact(None, prepared=prep).select(*key).collect()}
    got = {tuple(r) for r in N.pairs_mllib(None, prepared=prep).select(*key).collect()}
    assert exact and got <= exact and len(got) >= 0.9 * len(exact)


def _shingles(text):
    import re
    t = re.sub(r"[^a-z0-9\s]", "", text.lower()).strip(" ")
    toks = re.split(r"\s+", t)
    if len(toks) < 3:
        return None
    return {" ".join(toks[i:i + 3]) for i in range(len(toks) - 2)}


def test_exact_neardup_equals_brute_force(spark):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(30)]
    base = [" ".join(rng.choice(words) for _ in range(rng.randint(3, 40))) for _ in range(40)]
    texts = []
    for i, b in enumerate(base):
        texts.append(b)
        toks = b.split()
        if len(toks) > 4:  # near copy: one word changed
            toks[rng.randrange(len(toks))] = "zz"
            texts.append(" ".join(toks))
    texts += ["Boiler plate, text; here!", "boiler plate text here", "a b", "...", "x y z"]
    rows = [(f"r{i:03d}", f"u{i % 7}", f"p{i % 3}", 1.0, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "review_id string, user_id string, product_id string, rating double, "
                                     "review_text string")
    for p in (N.V2, N.V1, N.NearDupParams(max_distance=0.6)):
        sets = {r[0]: _shingles(r[4]) for r in rows}
        exp = set()
        for a, b in itertools.combinations(sorted(sets), 2):
            sa, sb = sets[a], sets[b]
            if sa and sb:
                j = len(sa & sb) / len(sa | sb)
                if 1.0 - j < p.max_distance:
                    exp.add((a, b))
        got = {(r.review_id_left, r.review_id_right) for r in N.pairs_exact(df, p).collect()}
        assert got == exp
        got = {(r.review_id_left, r.review_id_right) for r in N.pairs_exact(df, p, chunk=2).collect()}
        assert got == exp
        lsh = {(r.review_id_left, r.review_id_right) for r in N.pairs_minhash(df, p).collect()}
        assert lsh <= exp
        if p.max_distance <= 0.3:
            assert len(lsh) >= 0.95 * len(exp)
    assert spark.range(1).select(clean_for_shingles(__import__("pyspark.sql.functions", fromlist=["lit"])
                                                    .lit(" Héllo, World! "))).first()[0] == "hllo world"
