import zlib

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from reviewguard.llm import quality, toxicity
from reviewguard.llm.queries import QUERIES

from .conftest import SF

BIG = "/root/testdata/sf0.1"


def held_out(spark, name, column):
    got = QUERIES[name](spark, BIG).toPandas()
    assert (got.held_out == [zlib.crc32(str(d).encode()) % 5 == 0 for d in got.doc_id]).all()
    m = got.merge(spark.read.parquet(f"{BIG}/labels.parquet").toPandas().dropna(subset=[column]), on="doc_id")
    return len(got), m[m.held_out]


def test_toxicity_held_out(spark):
    n, m = held_out(spark, "op7_toxicity", "toxic")
    rank, bad = m.score.rank(), m.toxic == 1
    auc = (rank[bad].sum() - bad.sum() * (bad.sum() + 1) / 2) / (bad.sum() * (~bad).sum())
    assert n == 10_000 and auc > 0.95 and m[~bad].predicted.mean() < 0.02 and m[bad].predicted.mean() > 0.6
    assert ((m.score >= 0.5) == (m.predicted == 1)).all()


def test_quality_held_out(spark):
    n, m = held_out(spark, "op10_quality_classifier", "quality")
    assert n == 10_000 and m[m.quality == 1].selected.mean() > 0.98 and m[m.quality == 0].selected.mean() < 0.1


def test_classifier_edge_rows(spark):
    rows = [(i, "you idiot scum" if i % 3 == 0 else "nice calm words here") for i in range(60)] + [(90, None), (91, ""), (92, " \n"), (None, "scum"), (5, "nice calm words here"), (93, "calm " * 60_000)]
    df = spark.createDataFrame([(*x, "k", 1.0) for x in rows], "doc_id long, text string, toxic string, score double")
    labels = spark.createDataFrame([(i, int(i % 3 == 0), i % 4) for i in range(60)] + [(7, None, None), (None, 1, 1), (8, 0, 2)], "doc_id long, toxic int, quality int")
    for known in (labels, labels.limit(0), labels.where("toxic = 0 and quality = 1")):
        got = toxicity.toxicity_scores(df, known).collect()
        assert len(got) == len(rows) and all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.5) for x in got)
        graded = quality.quality_scores(df, known).collect()
        assert len(graded) == len(rows) and all(0 <= x.tail_probability <= 1 for x in graded)
    assert toxicity.toxicity_scores(df.limit(0), labels).count() == 0 and quality.quality_scores(df.limit(0), labels).count() == 0


def test_ngram_table_keeps_every_ngram():
    r = np.random.default_rng(1)
    grams = r.permutation(np.unique(r.integers(0, 1 << 48, 5_000_000, dtype=np.uint64)))       # more than 2^22
    held, unseen = grams[:-1000], grams[-1000:]
    ratio = r.normal(size=len(held)).astype(np.float32)
    table = toxicity.packed_table(held, ratio)
    got, known = toxicity.look_up(table, held)
    assert known.all() and (got == ratio).all()
    got, known = toxicity.look_up(table, unseen)
    assert not known.any() and not got.any()
    none = toxicity.look_up(toxicity.packed_table(held[:0], ratio[:0]), held[:5])
    assert not none[0].any() and not none[1].any()


def test_no_small_ratio_is_left_out(spark):
    ratios = spark.range(70_000).select(F.col("id").alias("g"), F.when(F.col("id") % 2 == 0, 0.001).otherwise(-3.0).alias("r"), F.lit(1).cast("long").alias("n"))
    got, known = toxicity.look_up(toxicity.ratio_table(ratios), np.arange(70_000, dtype=np.uint64))
    assert known.all() and (got == np.where(np.arange(70_000) % 2 == 0, np.float32(0.001), np.float32(-3))).all()


def test_ordinal_fit_orders_grades():
    r = np.random.default_rng(0)
    grade = r.integers(0, 4, 400)
    x = [(np.array([10 + g, 50]), np.array([1.0, 1.0])) for g in grade]
    w, cuts = quality.fit(x, grade, 4)
    f = [w[10 + g] + w[50] for g in range(4)]
    assert (np.diff(cuts) > 0).all() and f == sorted(f) and f[0] < cuts[0] and f[3] > cuts[2]


def test_pipeline_stages(spark):
    from reviewguard.llm import simhash, suffixes
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    clean = corpus_pipeline.drop_toxic(spark, docs, SF)
    one = corpus_pipeline.drop_near_duplicates(spark, clean, SF)
    ids = {r.doc_id for r in one.select("doc_id").collect()}
    groups = simhash.simhash_groups(clean).collect()
    assert ids == {r.component_id for r in groups}
    for df in (clean, one):
        assert df.schema.names == docs.schema.names
    some = one.orderBy("doc_id").limit(120)
    cut = {r.doc_id: r.text for r in corpus_pipeline.cut_repeated_passages(spark, some, SF).collect()}
    texts = [(r.doc_id, r.text) for r in some.select("doc_id", "text").collect()]
    for (d, n, gone, _, _), (_, t) in zip(suffixes.brute_force(texts), texts):
        assert (cut[d] == t) == (gone == 0) and len(cut[d].encode()) <= n - gone
    out = corpus_pipeline.run(spark, SF)
    assert out.where("not round_trip").count() == 0 and {r.doc_id for r in out.select("doc_id").collect()} <= ids
