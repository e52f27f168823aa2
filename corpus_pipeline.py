"""Cleaning a corpus: toxic documents go, near-duplicates go, repeated passages go, sources are mixed, texts are encoded.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and reread as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reviewguard.llm import mixing, pieces, simhash, suffixes, toxicity
from reviewguard.llm.common import saved
from reviewguard.llm.queries import quality_weights
from reviewguard.sources.tables import read_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't predicted toxic; null and empty texts and null ids are scored like any other, repeated rows stay or go together."""
    return toxicity.reject_toxic(docs, read_table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group, once; null and blank texts are one group, rows with a null id all stay."""
    return simhash.keep_one(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that a document with a smaller id has; a null text stays null, a null id is the largest."""
    return suffixes.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's budget takes them; a null source is one, texts without a word come once per whole epoch."""
    return mixing.mixed_documents(docs, quality_weights(spark, sf_dir))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids, n_tokens, round_trip, decoded_sha256 per row; null and empty texts have no ids."""
    return pieces.encode_texts(docs.select("doc_id", "lang", "source", "text")).drop("text")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeated_passages),
    ("mixing_sources", mix_sources),
    ("sentencepiece", encode),
]

#: A model, tiles, suffix arrays and a transducer aren't SQL; tests/llm has brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
