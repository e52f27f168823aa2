"""Mixing sources to target weights: Efraimidis-Spirakis sampling, DataFrame operations only.

Each source has a token budget. Whole epochs of a source come first; what is left of
its budget is a weighted sample without replacement: every document draws the
exponential key -ln(u) / weight, the keys are sorted within the source, and sizes
are prefix-summed up to the rest. Keys are dealt into buckets by value, so a prefix
sum is a sum over buckets (pre-aggregated) plus a running sum inside one bucket, and a
source with a third of all rows spreads over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, packed, saved, unpacked

SOURCE_WEIGHTS = (5, 2, 1)      # by the sources' order, repeating
SHARE, MOST = 1.5, 2            # of all sizes; times a source's size
BUCKETS = 1024
SEED = "mix-1"


def words(text: Column) -> Column:
    """Number of words of a text; null: 0."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def draw(doc_id: Column, seed: str = SEED) -> Column:
    """Uniform in (0, 1], the same for the same id: 52 bits of an MD5."""
    hexed = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 13)
    return (F.conv(hexed, 16, 10).cast("double") + 1) / F.lit(float(2**52))


def targets(sizes: DataFrame, weights=SOURCE_WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, target): a source's share of ``share`` times all sizes, by weight.

    ``sizes`` has (source, size), a row per source or several. Sources in code point
    order, null last, get ``weights`` in turn. No target exceeds ``most`` times its source; the excess
    is reshared by weight until none does, which is the water level where capped sources
    and the weighted rest add up. ``share`` above ``most`` leaves every source at its cap."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everywhere = Window.partitionBy(F.lit(0))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    per = per.withColumn("w", F.element_at(cycle, (F.pmod(F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights))) + 1).cast("int")))
    per = per.withColumn("cap", F.lit(float(most)) * F.col("source_size")).withColumn("budget", F.lit(share) * F.sum("source_size").over(everywhere))
    by_level = Window.partitionBy(F.lit(0)).orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    capped = F.coalesce(F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_w = F.sum("w").over(by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    per = per.withColumn("nth", F.row_number().over(by_level)).withColumn("level", (F.col("budget") - capped) / open_w)
    first = F.min(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct("nth", "level"))).over(everywhere)
    per = per.withColumn("at", first)
    return per.select("source", "source_size", F.when(F.col("at.nth") <= F.col("nth"), F.col("at.level") * F.col("w")).otherwise(F.col("cap")).alias("target"))


def mix(docs: DataFrame, weights: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        seed: str = SEED, buckets: int = BUCKETS, **shares) -> DataFrame:
    """One row per document row: doc_id, text_hash, size, source, source_size, target, copies, taken (= copies * size).

    ``weights`` has (doc_id, weight), a positive quality weight; none, null, NaN or not above 0 counts as 1, and the
    largest of several holds. copies is the number of whole
    epochs of the source (target div source_size), plus 1 for the documents of the fractional
    part: by ascending key while their sizes fit in the rest, then the one document left whose size
    comes nearest to what is still open (if it brings the source nearer).
    Null text: size 0. A null source is a source. Equal keys are ordered by doc_id, size and
    text hash; reruns agree. Repeated rows are documents of their own. An empty table gives an empty result."""
    # sizes come before the weights are joined, so that no text is shuffled
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text).cast("string")).alias("text_hash"), words(F.col(text)).alias("size"), F.col(source).cast("string").alias("source"))
    w = F.lit(1.0)
    if weights is not None:
        given = F.col("weight").cast("double")
        rows = rows.join(weights.where((given > 0) & ~F.isnan(given)).groupBy(F.col("doc_id").alias("_d")).agg(F.max(given).alias("_w")), F.col("doc_id") == F.col("_d"), "left")
        w = F.coalesce("_w", w)
    rows = rows.select("doc_id", "text_hash", "size", "source", (-F.log(draw(F.col("doc_id"), seed)) / w).alias("key"))
    rows = rows.withColumn("bucket", F.least(F.floor((1 - F.exp(-F.col("key"))) * buckets), F.lit(buckets - 1)).cast("int")).withColumn("rid", F.monotonically_increasing_id())
    rows = saved(rows, "mix")
    per_bucket = rows.groupBy("source", "bucket").agg(F.sum("size").alias("size"))
    want = targets(per_bucket, **shares).withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    want = want.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")).withColumnRenamed("source", "_source")
    before = F.coalesce(F.sum("size").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    plan = per_bucket.withColumn("before", before).join(want, F.col("source").eqNullSafe(F.col("_source"))).select(
        F.col("source").alias("_source"), F.col("bucket").alias("_bucket"), "before", "source_size", "target", "epochs", "rest")
    inside = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size", "text_hash", "rid").rowsBetween(Window.unboundedPreceding, 0)
    # the join's key starts with the bucket, so a hot source is spread over all of them
    dealt = rows.join(plan, (F.col("bucket") == F.col("_bucket")) & F.col("source").eqNullSafe(F.col("_source")))
    dealt = saved(dealt.withColumn("extra", (F.col("before") + F.sum("size").over(inside) <= F.col("rest")).cast("long")), "mix")
    left = dealt.groupBy("source").agg((F.max("rest") - F.sum(F.col("extra") * F.col("size"))).alias("gap")).withColumnRenamed("source", "_s")
    spare = dealt.where("extra = 0").join(left, F.col("source").eqNullSafe(F.col("_s"))).where(F.abs(F.col("size") - F.col("gap")) < F.col("gap"))
    last = spare.groupBy("source").agg(F.min(F.struct(F.abs(F.col("size") - F.col("gap")), "key", "doc_id", "size", "text_hash", "rid")).alias("k")).select(F.col("k.rid").alias("_rid"))
    out = dealt.join(last, F.col("rid") == F.col("_rid"), "left")
    copies = F.col("epochs") + F.col("extra") + F.col("_rid").isNotNull().cast("long")
    return out.select("doc_id", "text_hash", "size", "source", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, weights: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mix itself: ``docs`` with every row repeated as often as the mix takes it; columns are kept, under any name.

    Of rows equal in id, text and source but not in all columns the one with the smallest hash over all columns stands for
    all. An empty table gives an empty result. Sources' budgets are in words, so documents without a word come ``epochs`` times."""
    got = mix(docs, weights, doc_id, text, source, **options).groupBy("doc_id", "text_hash", "source").agg(F.sum("copies").alias("n")).where("n > 0")
    marked = packed(docs, id=F.col(doc_id), hash=F.xxhash64(F.col(text).cast("string")), of=F.col(source).cast("string"))
    # the copies of equal rows are counted together
    marked = marked.groupBy("id", "hash", "of").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    both = marked.join(got, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("text_hash")) & F.col("of").eqNullSafe(F.col("source")))
    return unpacked(both.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))), docs.columns)


ORACLE = f"""
WITH doc AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         -ln((CAST('0x' || substr(md5('{SEED}:' || CAST(doc_id AS VARCHAR)), 1, 13) AS BIGINT) + 1) / CAST(4503599627370496 AS DOUBLE))
           / coalesce(CASE quality WHEN 1 THEN 2.0::DOUBLE WHEN 0 THEN 0.5::DOUBLE END, 1.0::DOUBLE) AS k
  FROM documents LEFT JOIN (SELECT doc_id AS d, max(quality) AS quality FROM labels GROUP BY doc_id) ON doc_id = d),
per AS (SELECT source, CAST(sum(size) AS DOUBLE) AS s, CAST(CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS w FROM doc GROUP BY source),
lev AS (SELECT *, row_number() OVER o AS nth,
          (1.5 * sum(s) OVER () - coalesce(sum(2 * s) OVER (ORDER BY 2 * s / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY 2 * s / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
        FROM per WINDOW o AS (ORDER BY 2 * s / w, source NULLS LAST)),
hit AS (SELECT nth AS at_nth, level AS at_level FROM lev WHERE level * w <= 2 * s ORDER BY nth LIMIT 1),
want AS (SELECT source AS src, s, CASE WHEN nth >= at_nth THEN at_level * w ELSE 2 * s END AS target FROM lev, hit),
part AS (SELECT *, CASE WHEN s > 0 THEN floor(target / s) ELSE 0 END AS epochs FROM want),
run AS (SELECT doc.*, s, target, epochs, target - epochs * s AS rest,
          sum(size) OVER (PARTITION BY source ORDER BY k, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
        FROM doc JOIN part ON source IS NOT DISTINCT FROM src),
cut AS (SELECT *, upto <= rest AS extra, rest - sum(CASE WHEN upto <= rest THEN size ELSE 0 END) OVER (PARTITION BY source) AS gap FROM run),
pick AS (SELECT *, NOT extra AND abs(size - gap) < gap AND
           row_number() OVER (PARTITION BY source ORDER BY extra OR abs(size - gap) >= gap, abs(size - gap), k, doc_id) = 1 AS last FROM cut)
SELECT doc_id, size, CAST(s AS BIGINT) AS source_size, target, CAST((epochs + CAST(extra AS INT) + CAST(last AS INT)) * size AS BIGINT) AS taken FROM pick"""
