"""The opN queries: each applies its operator with production parameters to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewguard.sources.tables import read_table

from . import chat, crosstok, mixing, mtree, pieces, quality, simhash, suffixes, toxicity, vectors, warc, whitening

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(fn=None, sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f
    return register(fn) if fn else register


def quality_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, weight): 2 for labelled quality 1, 0.5 for 0."""
    rated = read_table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("q"))
    return rated.select("doc_id", F.when(F.col("q") == 1, 2.0).when(F.col("q") == 0, 0.5).alias("weight"))


@query(sql=chat.ORACLE)
def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.range(2).select(F.lit(-1).cast("long"), "id", F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit(chat.HARD))
    return chat.digests(chat.format_chats(turns.union(hard)))


@query
def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = simhash.simhash_groups(read_table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query(sql=mixing.ORACLE)
def op8_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return mixing.mix(docs, quality_weights(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.toxicity_scores(docs, read_table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


@query
def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = suffixes.remove_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select("doc_id", *[F.col(f"_{c}").alias(c) for c in ("n_bytes", "n_removed", "n_spans")], F.sha2("_kept", 256).alias("kept_sha256"))


@query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.token_counts(read_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_tokens")


@query
def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_texts(read_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


@query
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.quality_scores(docs, read_table(spark, sf_dir, "labels")).select("doc_id", "held_out", "expected_grade", "tail_probability", "selected")


@query(sql=mtree.ORACLE)
def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_k(read_table(spark, sf_dir, "embeddings"))


@query
def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(read_table(spark, sf_dir, "embeddings"))


@query
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


@query(sql=warc.ORACLE)
def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read_table(spark, sf_dir, "pages"))


@query
def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosstok.align(read_table(spark, sf_dir, "documents"))
