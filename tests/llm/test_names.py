"""Extra columns under every name that the operators use inside: no crash, no loss, the same results."""

import pytest
from pyspark.sql import functions as F

from reviewguard.llm import mixing, pieces, quality, simhash, suffixes, toxicity

NAMES = ["_text", "_id", "_n", "_bytes", "_cut", "_th", "_row_id", "_x", "_d", "_l", "_s", "_copy", "row", "id", "hash", "of", "kept", "n", "x", "cut", "lo", "hi", "did", "rid", "key", "size", "fp",
         "text_hash", "component_id", "copies", "a.b", "toxic", "quality", "weight", "salt", "value"]
LINE = "a passage of more than fifty bytes that two of the documents share word for word "


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"{LINE if i % 3 == 0 else ''}text number {i} " + "word " * (i % 7), "s" + str(i % 2)) for i in range(40)] + [(50, None, "s0"), (51, "", None), (52, "same", "s1"), (52, "same", "s1")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)


def labels(spark):
    return spark.createDataFrame([(i, i % 2, i % 2) for i in range(40)], "doc_id long, toxic int, quality int")


OPERATORS = {
    "token_counts": lambda d, s: pieces.token_counts(d),
    "encode_texts": lambda d, s: pieces.encode_texts(d),
    "quality_scores": lambda d, s: quality.quality_scores(d, labels(s)),
    "toxicity_scores": lambda d, s: toxicity.toxicity_scores(d, labels(s)),
    "reject_toxic": lambda d, s: toxicity.reject_toxic(d, labels(s)),
    "keep_one": lambda d, s: simhash.keep_one(d),
    "remove_repeats": lambda d, s: suffixes.remove_repeats(d),
    "without_repeats": lambda d, s: suffixes.without_repeats(d),
    "mixed_documents": lambda d, s: mixing.mixed_documents(d),
    "mix": lambda d, s: mixing.mix(d),
    "simhash_groups": lambda d, s: simhash.simhash_groups(d),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_extra_columns_under_any_name(spark, docs, name):
    def rows(df, names):
        return sorted(map(repr, df.select(*[F.col(f"`{c}`") for c in names]).collect()))
    plain = OPERATORS[name](docs, spark)
    extra = docs.withColumns({n: F.concat(F.lit(n + "-"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) for n in NAMES})
    got = OPERATORS[name](extra, spark)
    assert rows(got, plain.columns) == rows(plain, plain.columns)
    kept = [n for n in NAMES if n in got.columns and n not in plain.columns]
    if name not in ("mix", "simhash_groups"):
        assert kept == [n for n in NAMES if n not in plain.columns]
        assert all(r[n] == f"{n}-{r['doc_id']}" for r in got.collect() for n in kept)
