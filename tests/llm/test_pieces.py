import gc
import hashlib
import random
import weakref

import pytest
import sentencepiece as spm
from sentencepiece import sentencepiece_model_pb2 as pb

from reviewguard.llm import pieces
from reviewguard.llm.queries import QUERIES

from .conftest import SF_SMALL

HARD = ["", " ", "   ", "a", "  a", "a  b\n\tc ☃  x　 ﬁ q <s> </s> <0x41> ", "\x00a�  ", "日本語テキスト と 混在 😀😀", "aaaaaaaaaaaaaaaaaaaaaa", "!" * 50 + "?" * 37, " " * 40 + "x" + " " * 19,
        "Ñandú über naïve façade", "supercalifragilisticexpialidocious" * 5, "▁x▁ y", "\n\n\n\n\t\t\t\t", "1234567890" * 7]


def proto():
    m = pb.ModelProto()
    m.ParseFromString(open(pieces.MODEL, "rb").read())
    return m


def unigram():
    """The same vocabulary with scores that make it a unigram model."""
    m, r = proto(), random.Random(5)
    m.trainer_spec.model_type = 1
    for p in m.pieces:
        if p.type == 1:
            p.score = -r.randrange(1, 60) / 4      # many ties
    return m


@pytest.mark.parametrize("make", [proto, unigram])
def test_same_ids_and_counts_as_the_library(make):
    m = make()
    lib, t = spm.SentencePieceProcessor(model_proto=m.SerializeToString()), pieces.Transducer(pieces.describe(m))
    r = random.Random(1)
    some = [lib.id_to_piece(i).replace("▁", " ") for i in r.sample(range(300, 32000), 3000)]
    texts = HARD + ["".join(r.choices(some, k=r.randrange(1, 30))) for _ in range(300)] + ["".join(r.choices("abcdetnos  éñ", k=60)) for _ in range(200)]
    for x in texts:
        ids = t.encode(x)
        if make is proto or len(x) < 80:      # unigram sums are per word here
            assert ids == lib.encode(x), x
        assert t.count(x) == len(ids), x
        assert t.decode(ids) == lib.decode(ids), x


def test_queries(spark):
    lib = spm.SentencePieceProcessor(model_file=pieces.MODEL)
    docs = dict(map(tuple, spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()))
    got = {r.doc_id: r for r in QUERIES["op4_sentencepiece"](spark, SF_SMALL).collect()}
    assert set(got) == set(docs)
    for d, x in docs.items():
        assert list(got[d].ids) == lib.encode(x) and got[d].n_tokens == len(got[d].ids) and got[d].round_trip and got[d].decoded_sha256 == hashlib.sha256(x.encode()).hexdigest()
    assert {r.doc_id: r.n_tokens for r in QUERIES["op2_token_counts"](spark, SF_SMALL).collect()} == {d: len(lib.encode(x)) for d, x in docs.items()}


def test_edge_rows(spark):
    lib = spm.SentencePieceProcessor(model_file=pieces.MODEL)
    rows = [(i, x, "k") for i, x in enumerate(HARD + [None, HARD[5], "word " * 40_000])] + [(None, "a b", "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = pieces.encode_texts(df)
    assert got.columns == ["doc_id", "text", "ids", "n_tokens", "round_trip", "decoded_sha256"]
    back = pieces.decode_ids(got.drop("text")).collect()
    assert sorted((str(r.doc_id), r.ids, r.text) for r in back) == sorted((str(d), lib.encode(x or ""), lib.decode(lib.encode(x or ""))) for d, x, _ in rows)
    assert sorted((str(r.doc_id), r.n_tokens) for r in pieces.token_counts(df).collect()) == sorted((str(d), len(lib.encode(x or ""))) for d, x, _ in rows)
    assert pieces.encode_texts(df.limit(0)).count() == 0 and pieces.token_counts(df.limit(0)).count() == 0


def test_pairs_that_stay_apart_equal_replayed_merges():
    """Undoing last merges tells the same as merging both pieces' characters anew: on the given model, and on small ones full of ties."""
    r = random.Random(4)
    t = pieces.Transducer(pieces.read_model())
    made = [p for p in t.model["merges"]] + [p for p in t.score if len(p) == 1]
    short = [p for p in made if len(p) < 4]
    for _ in range(6000):
        a, b = r.choice(short if r.random() < .7 else made), r.choice(short if r.random() < .7 else made)
        assert t.may_follow(a, b) == (pieces.merge(a + b, t.score) == [a, b]), (a, b)
    assert len(t.replayed) < 50
    checked = 0
    for _ in range(400):
        score = {c: 0.0 for c in "abc"}
        for _ in range(r.randrange(3, 25)):
            x, y = r.choice(list(score)), r.choice(list(score))
            if len(x + y) < 7:
                score.setdefault(x + y, -float(r.randrange(1, 6)) + min(score[x], score[y]) * r.choice([1, 1, 0]))
        model = pb.ModelProto()
        model.CopyFrom(proto())
        del model.pieces[3:]
        for p, s in score.items():
            model.pieces.add(piece=p, score=s, type=1)
        t = pieces.Transducer(pieces.describe(model))
        made = [*t.model["merges"], *"abc"]
        checked += not t.replayed
        for a in made:
            for b in made:
                assert t.may_follow(a, b) == (pieces.merge(a + b, t.score) == [a, b]), (a, b, score)
    assert 50 < checked < 400


def test_a_transducer_goes_with_its_task():
    t = pieces.Transducer(pieces.read_model())
    assert t.decode(t.encode("some words here")) == "some words here" and t.count("some words here") == len(t.encode("some words here"))
    gone = weakref.ref(t)
    gc.disable()
    try:
        del t
        assert gone() is None
    finally:
        gc.enable()
