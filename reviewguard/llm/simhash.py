"""SimHash near-duplicates: fingerprints of word shingles, compared exactly in tiles.

Distinct fingerprints meet in tiles. Two fingerprints within ``radius`` bits
agree on at least ``blocks - radius`` of ``blocks`` bit blocks, so rows are dealt
out by the values of every such choice of blocks (no link can be missed), sorted by
key and population count, and cut into tiles. Tile pairs are compared whole with
numpy exclusive-or and bit counts; a tile pair whose population counts differ
beyond the radius is skipped. Each task sends on a spanning forest of its links,
never all pairs.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, connected, packed, saved, small_batches, unpacked

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
TILE = 512


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """64-bit SimHash of the A-Z-lower-cased text's word shingles (repeats count).

    A bit is 1 if it is set in over half of the shingles' XXH64 (seed 42). Fewer
    words than ``shingle``: one shingle of all of them. No word or null: 0."""
    words = WORDS.findall((text or "").encode("utf-8", "replace").lower())
    if not words:
        return 0
    k = min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:len(words) - k + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s:e], 42) for s, e in zip(starts, ends[k - 1:].tolist())], np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 14):
        part = hashes[i:i + (1 << 14)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(">u8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", shingle: int = 4, into: str = "fp") -> DataFrame:
    """Add the fingerprint as a signed long."""
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(x, shingle) for x in texts], np.uint64).view(np.int64))
    return docs.withColumn(into, of(F.col(text).cast("string")))


def tile_links(fp: np.ndarray, key: np.ndarray, radius: int, tile: int = TILE) -> np.ndarray:
    """Labels (index of a linked row) of fingerprints that share a key and differ in ``radius`` bits at most.

    Rows are sorted by key and population count and compared tile by tile."""
    ones = np.bitwise_count(fp)
    order = np.lexsort((ones, key))
    f, k, c = fp[order], key[order], ones[order].astype(np.int64)
    n, lab, held, waiting = len(f), np.arange(len(f)), [], 0
    for i in range(0, n, tile):
        last = min(i + tile, n) - 1
        for j in range(i, n, tile):
            if j > i and (k[j] != k[last] or c[j] - c[last] > radius):
                break
            x = np.bitwise_count(f[i:last + 1, None] ^ f[None, j:j + tile]) <= radius
            a, b = np.nonzero(np.triu(x, 1) if i == j else x)
            if len(a):
                held.append((a + i, b + j))
                waiting += len(a)
            if waiting > 1 << 20:
                lab, held, waiting = components(n, *map(np.concatenate, zip(*held)), lab), [], 0
    if held:
        lab = components(n, *map(np.concatenate, zip(*held)), lab)
    out = np.empty(n, np.int64)
    out[order] = order[lab]
    return out


def fingerprint_groups(fps: DataFrame, fp: str = "fp", node: str = "node", radius: int = 4, blocks: int = 6) -> DataFrame:
    """(node, component) of distinct fingerprints linked within ``radius`` bits; unlinked nodes don't come back.

    ``fps`` holds each fingerprint once, with a long node id."""
    if radius >= blocks:
        raise ValueError("more blocks than differing bits are needed")
    cuts = [round(64 * i / blocks) for i in range(blocks + 1)]
    parts = [((1 << cuts[i + 1]) - 1) ^ ((1 << cuts[i]) - 1) for i in range(blocks)]
    masks = [sum(m) for m in combinations(parts, blocks - radius)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = F.array(*[F.xxhash64(F.lit(i), F.col(fp).bitwiseAND(F.lit(m))) for i, m in enumerate(signed)])
    dealt = fps.select(F.col(fp).alias("fp"), F.col(node).cast("long").alias("node"), F.explode(keys).alias("key")).repartition("key")

    def forest(batches):
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        t = pa.Table.from_batches(got)
        f, ids = t["fp"].to_numpy().view(np.uint64), t["node"].to_numpy()
        lab = tile_links(f, t["key"].to_numpy(), radius)
        a, b = ids, ids[lab]
        pairs = np.unique(np.stack([a, b], 1)[a != b], axis=0)
        for i in range(0, len(pairs), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(pairs[i:i + 10_000, 0]), pa.array(pairs[i:i + 10_000, 1])], ["a", "b"])

    return connected(dealt.mapInArrow(forest, "a long, b long"), "a", "b")


def simhash_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, radius: int = 4) -> DataFrame:
    """One row per document row: doc_id, text_hash, fp (signed long), component_id.

    Documents with equal fingerprints, or a chain of fingerprints ``radius`` bits apart
    at most, form a group; component_id is its smallest doc_id. Equal fingerprints are compared
    once. Null and blank texts have fingerprint 0 and link like any other. A
    row with a null doc_id takes no part and has a null component_id. Repeated rows come
    back each. Extra columns are ignored; an empty table gives an empty result."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = saved(with_fingerprint(docs, "text", shingle).select("doc_id", F.xxhash64("text").alias("text_hash"), "fp"), "simhash")
    least = saved(rows.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node")), "simhash-fp")
    # one doc_id may stand for several fingerprints (repeated ids): it then joins them
    groups = fingerprint_groups(least, "fp", "node", radius)
    known = saved(least.join(groups, "node", "left").select(F.col("fp").alias("_fp"), F.coalesce("component", "node").alias("component_id")), "simhash-group")
    return rows.join(known, rows.fp.eqNullSafe(F.col("_fp")) & F.col("doc_id").isNotNull(), "left").drop("_fp")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, radius: int = 4) -> DataFrame:
    """The documents without near-duplicates: of each group the row with the smallest (doc_id, text hash) stays, once.

    Columns are kept as they are, under any name; of rows equal in id and text but not in all columns the one with the smallest
    hash over all columns stays. Rows with a null doc_id all stay. Null and empty texts are near-duplicates of each
    other. An empty table gives an empty result."""
    rows = simhash_groups(docs, doc_id, text, shingle, radius)
    kept = (rows.where("doc_id is not null").groupBy("component_id").agg(F.min(F.struct("doc_id", "text_hash")).alias("k"))
            .select(F.col("k.doc_id").alias("id"), F.col("k.text_hash").alias("hash")))
    marked = packed(docs, id=F.col(doc_id).cast("long"), hash=F.xxhash64(F.col(text).cast("string")))
    with_id = marked.where("id is not null").join(kept, ["id", "hash"], "left_semi")
    once = with_id.groupBy("id", "hash").agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row")
    return unpacked(once.union(marked.where("id is null").select("row")), docs.columns)
