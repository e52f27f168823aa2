import random

import pytest

from reviewguard.operators import graph as G
from reviewguard.operators import overlap as O
from test_graph_neardup import brute_pairs, skewed_edges


def equal_edges(rng, users, products, most):
    """Few, equally frequent products: no bound rules a pair out."""
    return {(f"u{u}", f"p{p}") for u in range(users) for p in rng.sample(range(products), rng.randint(1, most))}


@pytest.mark.parametrize("edges", [equal_edges(random.Random(1), 150, 20, 12), equal_edges(random.Random(2), 200, 400, 6), skewed_edges(random.Random(3), 80)])
@pytest.mark.parametrize("block", [10**6, 150])
def test_tiles_equal_brute_force(spark, edges, block):
    df = spark.createDataFrame(sorted(edges), "user_id string, product_id string")
    members, sets = O.product_sets(df)
    m6, m7 = brute_pairs(edges)
    rows = members.join(O.tiled_overlap(sets, block=block), "rep", "left").collect()
    assert {r.user_id: (r.others or 0) + r.users - 1 for r in rows if r.others or r.users > 1} == m6
    assert {r.user_id: r.most for r in rows if r.users == 1 and r.others} == {u: m7[u] for u in m6 if u in {r.user_id for r in rows if r.users == 1}}


def test_pair_features_shuffle_no_pairs_and_no_bitmaps(spark):
    df = spark.createDataFrame(sorted(equal_edges(random.Random(4), 100, 12, 8)), "user_id string, product_id string")
    plan = G.pair_features(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "bitmap" not in plan and "FlatMapGroupsInArrow" in plan
