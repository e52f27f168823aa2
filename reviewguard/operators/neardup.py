"""Near-duplicate review texts under a Jaccard distance (D7-D10, E7, F7-F8,
G3, K10-K14).

Texts are cleaned, tokenised and turned into sets of distinct word
3-grams by Catalyst expressions. Three ways to the pairs:

* ``pairs_exact`` -- exact, by prefix filtering: shingles are put in one order,
  common ones last; for similarity > s two sets must share one of the first
  |x| - ceil(s|x|) + 1 shingles of each, so only those prefixes are written,
  shuffled (once, by shingle) and joined. What counts as common is measured on
  ``SAMPLE`` texts: any order loses no pair, a good one saves work. The shared
  prefix shingles of two sets are counted; with those behind the prefixes they
  must be enough for the similarity, or the pair is no candidate. Candidates are
  verified on the real shingle sets, which are made again from the texts of
  candidates only, so neither texts nor whole sets of the table are written.
  Shingle sets are compared as sets of 64-bit hashes (a collision, about n^2 / 2^65 for
  two texts of n shingles, could only raise a similarity); prefixes hold 59 bits of them.
* ``pairs_minhash`` -- banded MinHash on xxhash64 of the shingles, verified
  exactly (a subset of the exact pairs).
* ``pairs_mllib`` -- MLlib HashingTF + MinHashLSH on hashed features, as the
  reference configures it: the pairs that its approxSimilarityJoin would keep, without
  joining rows on single hashes, which brings nearly all pairs together.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_for_shingles, ngrams, tokens
from ..session import checkpoint, scratch_path
from .pairs import DEFAULT_CHUNK, salted_self_pairs


@dataclass(frozen=True)
class NearDupParams:
    max_distance: float = 0.3      # strict: distance < max_distance
    low_cut: float | None = None   # v1 keeps rating <= 2 only
    ngram: int = 3
    min_tokens: int = 3
    num_features: int = 10000      # MLlib variant only
    num_tables: int = 3            # MLlib variant only


# The two consumer versions.
V2 = NearDupParams()
V1 = NearDupParams(max_distance=0.4, low_cut=2.0)

ID = "review_id"
SIDE_COLS = ["user_id", "product_id"]

#: Texts on which the order of shingles is measured, slots of its table (4 bits each), bits of a filter of rows.
SAMPLE, SLOTS, ROW_BITS = 16_384, 1 << 22, 1 << 23


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is computed once a row: filters on a generated column aren't pushed below it with a copy of the expression."""
    return df.select(*df.columns, F.explode_outer(F.array(value)).alias(name))


def hashes_of(tok: str, n: int) -> Column:
    """The shingle set of a row's tokens as distinct 64-bit hashes."""
    return F.array_distinct(F.transform(ngrams(tok, n), lambda x: F.xxhash64(x)))


def prepare(df: DataFrame, p: NearDupParams = V2, materialize: bool = True, text: bool = True) -> DataFrame:
    """Rows usable for near-duplicates: non-blank text, cleaned non-empty,
    at least ``min_tokens`` tokens; adds clean_review_text, shingles
    (distinct, text order), n_shingles and sh_hash (64-bit hashes of the
    shingles, for the candidate joins).

    With ``materialize`` the result is checkpointed: cleaning and shingling
    are the expensive part and every later step (index, verification,
    output) reads this table instead of recomputing them. Without ``text``
    the cleaned text is left out."""
    d = df.filter(F.col("review_text").isNotNull() & (F.trim(F.col("review_text")) != ""))
    if p.low_cut is not None:
        d = d.filter(F.col("rating") <= p.low_cut)
    d = _once(d, "clean_review_text", clean_for_shingles("review_text")).filter(F.col("clean_review_text") != "")
    # at least min_tokens tokens, and at least one n-gram (>= ngram tokens);
    # both are cheap filters on the token count
    d = _once(d, "tokens", tokens("clean_review_text")).filter(F.size("tokens") >= max(p.min_tokens, p.ngram))
    # the shingle set is kept as distinct 64-bit hashes: set operations on
    # long arrays use hash sets (linear), on string arrays nested loops
    # (quadratic in a 20,000-word text)
    d = d.withColumn("sh_hash", hashes_of("tokens", p.ngram))
    d = d.withColumn("n_shingles", F.size("sh_hash"))
    d = d.select(ID, *[c for c in SIDE_COLS if c in d.columns], *(["clean_review_text"] if text else []), "n_shingles", "sh_hash")
    return checkpoint(d) if materialize else d


def funnel(df: DataFrame, p: NearDupParams = V2) -> DataFrame:
    """Row counts of every stage in one aggregate (one job, not seven)."""
    t = F.col("review_text")
    has_text = t.isNotNull() & (F.trim(t) != "")
    if p.low_cut is not None:
        has_text = has_text & (F.col("rating") <= p.low_cut)
    # texts are cleaned, split and shingled once each, not once per count
    rows = df.select(F.coalesce(has_text, F.lit(False)).alias("has_text"), F.when(has_text, t).alias("text"))
    rows = _once(_once(rows, "clean", clean_for_shingles("text")), "tokens", tokens("clean"))
    rows = _once(rows, "grams", F.size(ngrams("tokens", p.ngram)))
    usable, ntok = F.col("has_text") & (F.col("clean") != ""), F.size("tokens")
    return rows.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if("has_text").alias("rows_with_text"),
        F.count_if(usable).alias("rows_cleaned"),
        F.count_if(usable & (ntok >= p.min_tokens)).alias("rows_tokenized"),
        F.count_if(usable & (ntok >= p.min_tokens) & (F.col("grams") > 0)).alias("rows_shingled"),
    )


def _pair_output(pairs: DataFrame, side: DataFrame, with_text: bool) -> DataFrame:
    side = side.select(ID, *SIDE_COLS, *(["clean_review_text"] if with_text else []))
    l = side.select(*[F.col(c).alias(f"{c}_left") for c in side.columns])
    r = side.select(*[F.col(c).alias(f"{c}_right") for c in side.columns])
    j = pairs.join(l, pairs.a == F.col(f"{ID}_left")).join(r, pairs.b == F.col(f"{ID}_right"))
    cols = [f"{ID}_left", f"{ID}_right", "user_id_left", "product_id_left"]
    if with_text:
        cols.append(F.col("clean_review_text_left").alias("review_text_left"))
    cols += ["user_id_right", "product_id_right"]
    if with_text:
        cols.append(F.col("clean_review_text_right").alias("review_text_right"))
    return j.select(*cols, "jaccard_distance", (1 - F.col("jaccard_distance")).alias("similarity_score"))


def verified(cand: DataFrame, prep: DataFrame, p: NearDupParams) -> DataFrame:
    s = prep.select(ID, F.col("sh_hash").alias("shingles"), "n_shingles")
    sa = s.select(F.col(ID).alias("a"), F.col("shingles").alias("sa"), F.col("n_shingles").alias("na"))
    sb = s.select(F.col(ID).alias("b"), F.col("shingles").alias("sb"), F.col("n_shingles").alias("nb"))
    v = cand.join(sa, "a").join(sb, "b")
    c = F.size(F.array_intersect("sa", "sb"))
    v = v.withColumn("_c", c).withColumn(
        "jaccard_distance", 1.0 - F.col("_c") / (F.col("na") + F.col("nb") - F.col("_c")))
    return v.filter(F.col("jaccard_distance") < p.max_distance).select("a", "b", "jaccard_distance")


def keyed(prep: DataFrame) -> DataFrame:
    return prep.withColumn("set_id", F.xxhash64(F.sort_array("sh_hash")))


def _sets(prep: DataFrame) -> DataFrame:
    """Each distinct shingle set once: set_id, sh_hash, n_shingles."""
    return keyed(prep).groupBy("set_id").agg(F.first("sh_hash").alias("sh_hash"), F.first("n_shingles").alias("n_shingles"))


# --------------------------------------------------------------------------
# Packed tables that enter a plan as a scalar
# --------------------------------------------------------------------------

def _packed(words: DataFrame, n: int) -> DataFrame:
    """One row ``words``: array<bigint> of ``n`` words out of (word, bits), 0 where there is none."""
    every = words.sparkSession.range(n).join(words, F.col("id") == F.col("word"), "left").select("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    return checkpoint(every.agg(F.transform(F.array_sort(F.collect_list(F.struct("id", "bits"))), lambda s: s["bits"]).alias("words")))


def bits_of(values: DataFrame, name: str, bits: int = ROW_BITS) -> DataFrame:
    """The filter of a column's hashes as one row: it may pass others, and leaves out none."""
    at = values.select(F.xxhash64(name).bitwiseAND(F.lit(bits - 1)).alias("at"))
    return _packed(at.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(at & 63 AS INT))")).alias("bits")), bits // 64)


def has_bit(filter_row: DataFrame, name: str, bits: int = ROW_BITS) -> Column:
    at = F.xxhash64(name).bitwiseAND(F.lit(bits - 1))
    word = F.get(filter_row.select("words").scalar(), F.shiftright(at, 6).cast("int"))
    return F.call_function("getbit", word, at.bitwiseAND(F.lit(63)).cast("int")) == 1


def common_levels(sets: DataFrame) -> DataFrame:
    """One row ``words``: 4 bits a slot of shingles, floor(log2) of the most sets that hold one of the slot's shingles (15 at most)."""
    n = sets.select(F.explode("sh_hash").alias("sh")).groupBy("sh").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    slot = n.groupBy(F.col("sh").bitwiseAND(F.lit(SLOTS - 1)).alias("slot")).agg(F.least(F.lit(15), F.floor(F.log2(F.max("n")))).cast("long").alias("level"))
    return _packed(slot.groupBy(F.shiftright("slot", 4).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(level, CAST((slot & 15) * 4 AS INT))")).alias("bits")), SLOTS // 16)


def with_keys(rows: DataFrame, levels: DataFrame, s: float) -> DataFrame:
    """Adds ``keys``, the first |x| - ceil(s|x|) + 1 shingles of a row's set as sorted numbers: level (4 bits) before 59 bits of the hash."""
    def key(h):
        slot = h.bitwiseAND(F.lit(SLOTS - 1))
        word = F.get("_words", F.shiftright(slot, 4).cast("int"))
        level = F.call_function("shiftrightunsigned", word, (slot.bitwiseAND(F.lit(15)) * 4).cast("int")).bitwiseAND(F.lit(15))
        return F.shiftleft(F.coalesce(level, F.lit(0).cast("long")), 59).bitwiseOR(F.shiftrightunsigned(h, 5))
    # of the set itself: a plain column and the table's scalar then stay in one projection, and no row holds a copy of the table
    n = F.size("sh_hash")
    size = (n - F.ceil(F.lit(s) * n) + 1).cast("int")
    return rows.withColumn("_words", levels.select("words").scalar()).withColumn(
        "keys", F.slice(F.sort_array(F.transform("sh_hash", key)), F.lit(1), size)).drop("_words")


def enough(n: str, m: str, shared: str, s: float) -> Column:
    """Whether sets of ``n`` and ``m`` shingles can be similar if their prefixes share ``shared``.

    The prefix that ends first in the order holds all common shingles but those behind it, ceil(s|x|) - 1 of its set at most."""
    behind = F.greatest(F.ceil(F.lit(s) * F.col(n)), F.ceil(F.lit(s) * F.col(m))) - 1
    return F.col(shared) + behind >= F.lit(s / (1 + s)) * (F.col(n) + F.col(m)) - 1e-6


# --------------------------------------------------------------------------
# Pairs
# --------------------------------------------------------------------------

def least(p: NearDupParams) -> float:
    """The similarity that must be exceeded; margin for rounding."""
    return 1.0 - p.max_distance - 1e-9


def _source(df: DataFrame | None, p: NearDupParams, prepared: DataFrame | None) -> Callable[..., DataFrame]:
    """Prepared rows for which ``keep`` (of the review id) holds, made again for each use: rows left out aren't cleaned."""
    def rows(keep: Column | None = None, text: bool = False) -> DataFrame:
        if prepared is not None:
            return prepared if keep is None else prepared.filter(keep)
        return prepare(df if keep is None else df.filter(keep), p, materialize=False, text=text)
    return rows


def _levels(df: DataFrame, source: Callable[..., DataFrame]) -> tuple[DataFrame, float]:
    """The order of shingles, measured on about SAMPLE rows, and how many rows stand behind one of them."""
    share = min(1.0, SAMPLE / max(1, df.count()))
    return common_levels(_sets(source(sampled(share)))), 1 / share


def sampled(share: float) -> Column:
    return F.pmod(F.xxhash64(ID, F.lit(7)), F.lit(1 << 30)) <= int(share * (1 << 30))


def _index(rows: DataFrame) -> DataFrame:
    """Written once: review id, user, product, set_id, n_shingles and ``keys`` of each row."""
    out = keyed(rows).select(ID, *[c for c in SIDE_COLS if c in rows.columns], "set_id", "n_shingles", "keys")
    path = scratch_path(rows.sparkSession, f"neardup-{uuid.uuid4().hex}")
    out.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(out.schema).parquet(path)


def met(index: DataFrame, others: DataFrame, which: Column, p: NearDupParams, chunk: int, behind: float) -> DataFrame:
    """(a, b) of the index's and the other sets whose prefixes share enough, where ``which`` (of a and b) holds.

    Keys that may have more than ``chunk`` rows are split over tasks; ``behind``: rows for each one that the order was measured on."""
    s = least(p)
    level = F.shiftright("key", 59)
    parts = F.ceil(F.pow(F.lit(2.0), level + 1) * F.lit(behind) / F.lit(chunk)).cast("int")
    hot = (level > 0) & (parts > 1)
    fits = F.least("n", "m") >= F.lit(s) * F.greatest("n", "m")

    def entries(x):
        e = x.select(F.explode("keys").alias("key"), "set_id", F.col("n_shingles").alias("n"))
        # copies of one set are one row before they are joined, behind one shuffle (both sides read it if they are one index)
        return e.filter(~hot).repartition("key").distinct(), e.filter(hot).distinct().withColumn("parts", parts)

    def joined(left, right, on):
        right = right.select(*on, F.col("set_id").alias("b"), F.col("n").alias("m"))
        return left.withColumnRenamed("set_id", "a").join(right, on).filter(which & fits).select("a", "b", "n", "m")
    (rare, common), (rare2, common2) = entries(index), entries(others)
    both = joined(rare, rare2, ["key"]).unionByName(joined(
        common.withColumn("part", F.pmod(F.xxhash64("set_id"), F.col("parts")).cast("int")),
        common2.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))), ["key", "part"]))
    return both.groupBy("a", "b", "n", "m").agg(F.count(F.lit(1)).alias("shared")).filter(enough("n", "m", "shared", s)).select("a", "b")


def _near_sets(cand: DataFrame, rows: DataFrame, source: Callable[..., DataFrame], p: NearDupParams) -> DataFrame:
    """(x, y, jaccard_distance) of the candidates (sets a < b) that are near. ``rows``: set_id and review id of each row.

    The texts of one row of each asked set are cleaned again."""
    cand = checkpoint(cand)
    asked = checkpoint(cand.select(F.col("a").alias("set_id")).union(cand.select("b")).distinct())
    one = rows.join(asked, "set_id", "left_semi").groupBy("set_id").agg(F.min(ID).alias(ID))
    sets = keyed(source(has_bit(bits_of(one, ID), ID))).join(asked, "set_id", "left_semi").groupBy("set_id").agg(
        F.first("sh_hash").alias("sh_hash"), F.first("n_shingles").alias("n_shingles"))
    return checkpoint(verified(cand, sets.withColumnRenamed("set_id", ID), p).select(F.col("a").alias("x"), F.col("b").alias("y"), "jaccard_distance"))


def _member_pairs(near: DataFrame, rows: DataFrame, chunk: int) -> DataFrame:
    """(a, b, jaccard_distance) of rows: near sets as pairs of their rows, and rows of one set."""
    equal = salted_self_pairs(rows, "set_id", ID, chunk=chunk).select("a", "b", F.lit(0.0).alias("jaccard_distance"))
    met = near.join(rows.select(F.col("set_id").alias("x"), F.col(ID).alias("u")), "x").join(
        rows.select(F.col("set_id").alias("y"), F.col(ID).alias("v")), "y").filter("u != v")
    return equal.unionByName(met.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b"), "jaccard_distance"))


def _output(pairs: DataFrame, index: DataFrame, source: Callable[..., DataFrame], with_text: bool) -> DataFrame:
    if not with_text:
        return _pair_output(pairs, index, False)
    pairs = checkpoint(pairs)
    return _pair_output(pairs, _asked_rows(pairs, source), True)


def _asked_rows(pairs: DataFrame, source: Callable[..., DataFrame]) -> DataFrame:
    """Prepared rows, with their text, of the ids in ``pairs``."""
    asked = checkpoint(pairs.select(F.col("a").alias(ID)).union(pairs.select("b")).distinct())
    return source(has_bit(bits_of(asked, ID), ID), text=True).join(asked, ID, "left_semi")


def _exact_members(df: DataFrame, source: Callable[..., DataFrame], p: NearDupParams, chunk: int) -> tuple[DataFrame, DataFrame]:
    """The exact pairs (a, b, jaccard_distance) of rows, and the rows' index."""
    levels, behind = _levels(df, source)
    index = _index(with_keys(source(), levels, least(p)))
    rows = index.select("set_id", ID)
    return _member_pairs(_near_sets(met(index, index, F.col("a") < F.col("b"), p, chunk, behind), rows, source, p), rows, chunk), index


def pairs_exact(df: DataFrame, p: NearDupParams = V2, with_text: bool = False,
                prepared: DataFrame | None = None, chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """All pairs (left id < right id) with Jaccard distance < max_distance
    on the real shingle sets, exactly (prefix filtering + verification)."""
    source = _source(df, p, prepared)
    pairs, index = _exact_members(prepared if df is None else df, source, p, chunk)
    return _output(pairs, index, source, with_text)


def pairs_minhash(df: DataFrame, p: NearDupParams = V2, tables: int = 20, rows_per_band: int = 4,
                  seed: int = 17, with_text: bool = False, prepared: DataFrame | None = None,
                  chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """Banded MinHash candidates (``tables`` bands of ``rows_per_band``
    hashes), verified exactly; a subset of :func:`pairs_exact`.

    Two texts of similarity s meet in a band with probability 1 - (1 - s^rows)^tables: as it is 99.6 % at
    s = 0.7 (and 99.99 % at 0.8), 15 % at 0.3, where one-hash bands would bring nearly all."""
    source = _source(df, p, prepared)
    def hash_fn(k):
        return lambda sh: F.xxhash64(sh, F.lit(seed + k))

    # the signature is made once a row
    made = _once(source(), "sig", F.array(*[F.array_min(F.transform("sh_hash", hash_fn(i))) for i in range(tables * rows_per_band)]))
    # one bucket key per (band, value); a collision only adds candidates
    index = _index(made.withColumn("keys", F.transform(F.sequence(F.lit(0), F.lit(tables - 1)),
                                                       lambda b: F.xxhash64(b, F.xxhash64(F.slice("sig", b * rows_per_band + 1, rows_per_band))))))
    bk = checkpoint(index.select("set_id", F.explode("keys").alias("_bk")).distinct())
    cand = salted_self_pairs(bk, "_bk", "set_id", chunk=chunk).select("a", "b").distinct()
    rows = index.select("set_id", ID)
    return _output(_member_pairs(_near_sets(cand, rows, source, p), rows, chunk), index, source, with_text)


def pairs_mllib(df: DataFrame, p: NearDupParams = V2, seed: int = 42, with_text: bool = False,
                prepared: DataFrame | None = None, chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """HashingTF (binary) + MinHashLSH: the pairs that approxSimilarityJoin keeps (a hash of one table in common,
    hashed distance < max_distance) and that are near on the real shingle sets, too: shingles that share a hashed
    slot make no pair. A subset of :func:`pairs_exact`.

    A pair must pass all three tests. The join on one hash brings two sets of similarity s together with 1 - (1 - s)^tables, so
    nearly all pairs; the real sets are searched first, and the model's hashes and distances are taken of the pairs found."""
    from pyspark.ml.feature import HashingTF, MinHashLSH, NGram
    from pyspark.ml.functions import vector_to_array

    source = _source(df, p, prepared)
    pairs, _ = _exact_members(prepared if df is None else df, source, p, chunk)
    pairs = checkpoint(pairs.select("a", "b").distinct())
    rows = checkpoint(_asked_rows(pairs, source))
    ng = NGram(n=p.ngram, inputCol="tokens", outputCol="ngrams_all").transform(
        rows.withColumn("tokens", tokens("clean_review_text")))
    feat = HashingTF(inputCol="ngrams_all", outputCol="features", numFeatures=p.num_features,
                     binary=True).transform(ng).select(ID, *SIDE_COLS, "features")
    model = MinHashLSH(inputCol="features", outputCol="hashes", numHashTables=p.num_tables,
                       seed=seed).fit(feat)
    slots = F.filter(F.transform(vector_to_array("features"), lambda v, i: F.when(v != 0, i)), lambda i: i.isNotNull())
    # rows that are equal in all columns meet once, as in approxSimilarityJoin
    made = model.transform(feat).select(ID, *SIDE_COLS, slots.alias("slots"), F.array(*[
        vector_to_array(F.col("hashes")[i])[0] for i in range(p.num_tables)]).alias("hashes"))
    made = checkpoint(made.distinct())
    both = pairs.join(made.select(F.col(ID).alias("a"), F.col("slots").alias("x"), F.col("hashes").alias("g")), "a").join(
        made.select(F.col(ID).alias("b"), F.col("slots").alias("y"), F.col("hashes").alias("h")), "b")
    same = F.size(F.array_intersect("x", "y"))
    hashed = 1.0 - same / (F.size("x") + F.size("y") - same)
    collide = F.exists(F.zip_with("g", "h", lambda u, v: u == v), lambda e: e)
    cand = both.filter(collide & (hashed < p.max_distance)).select("a", "b")
    return _pair_output(verified(cand, rows, p), rows, with_text)


def top(pairs: DataFrame, n: int = 20) -> DataFrame:
    """Most similar pairs first, full tie-break on the ids."""
    return pairs.orderBy(F.col("similarity_score").desc(), F.col(f"{ID}_left"), F.col(f"{ID}_right")).limit(n)
