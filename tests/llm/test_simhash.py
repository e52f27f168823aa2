import random
import re

import numpy as np
import xxhash

from reviewguard.llm import simhash
from reviewguard.llm.common import components, connected
from reviewguard.llm.queries import QUERIES

from .conftest import SF


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hs = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute(rows):
    """{row index: smallest id reachable} by comparing all fingerprints."""
    fps = [slow_fingerprint(t) for _, t in rows]
    lab = list(range(len(rows)))
    def root(i):
        while lab[i] != i:
            i = lab[i]
        return i
    f = np.array(fps, np.uint64)
    for i in range(len(rows)):
        for j in np.nonzero(np.bitwise_count(f ^ f[i]) <= 4)[0]:
            lab[root(int(j))] = root(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = root(i)
        least[r] = min(d, least.get(r, d))
    return sorted((d, f"{fps[i]:016x}", least[root(i)]) for i, (d, _) in enumerate(rows))


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op5_simhash_near_dedup"](spark, SF).collect()
    assert sorted(map(tuple, got)) == brute([tuple(r) for r in docs])


def test_edge_rows(spark):
    long = " ".join(random.Random(1).choices("abcdefgh", k=30_000))
    rows = [(5, None), (3, ""), (9, " \t\n"), (4, "one two"), (7, "ONE two"), (7, "ONE two"), (2, long), (1, long + " tail"), (8, "ÄÖ é z Q w")]
    df = spark.createDataFrame([(d, t, 1, "x", 2) for d, t in rows], "doc_id long, text string, node long, key string, fp int")
    got = simhash.simhash_groups(df).select("doc_id", "fp", "component_id").collect()
    assert sorted((r.doc_id, f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in got) == brute(rows)
    with_null = df.union(spark.createDataFrame([(None, "one two", 0, "", 0)], df.schema))
    assert [r.component_id for r in simhash.simhash_groups(with_null).where("doc_id is null").collect()] == [None]
    kept = simhash.keep_one(with_null)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == [1, 3, 4, 8]
    assert simhash.simhash_groups(df.limit(0)).count() == 0 and simhash.keep_one(df.limit(0)).count() == 0


def test_tiles_find_every_link():
    r = np.random.default_rng(0)
    base = r.integers(0, 2**63, 40, dtype=np.uint64)
    f = np.unique(np.concatenate([b ^ (np.uint64(1) << r.integers(0, 64, 90, dtype=np.uint64)) for b in base]))
    lab = simhash.tile_links(f, np.zeros(len(f), np.int64), 4, tile=16)
    a, b = np.nonzero(np.bitwise_count(f[:, None] ^ f) <= 4)
    want = components(len(f), a, b)
    assert len(np.unique(lab)) == len(np.unique(want)) and (want[lab] == want).all()


def test_connected_parts(spark):
    r = random.Random(3)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, x) for x in range(501, 900)] + [(r.randrange(1000, 1400), r.randrange(1000, 1400)) for _ in range(250)]
    got = dict(map(tuple, connected(spark.createDataFrame(links, "p long, q long"), "p", "q").collect()))
    lab = components(1500, *map(np.array, zip(*links)))
    touched = {x for p, q in links if p != q for x in (p, q)}
    assert got == {x: int(lab[x]) for x in touched}
