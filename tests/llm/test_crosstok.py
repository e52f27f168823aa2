import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from reviewguard.llm import crosstok as X
from reviewguard.llm.queries import QUERIES

from .conftest import SF_SMALL
from .test_pieces import HARD


def brute(texts):
    """Per text (n_a, n_b, n_groups, n_links, n_best, count_sum, digest) with the tokenizers' own libraries, text by text."""
    a_lib, b_lib = Tokenizer.from_file(X.BYTE_BPE), sentencepiece.SentencePieceProcessor(model_file=X.PIECE_BPE)
    a_lib.encode_special_tokens = True
    letters = X.byte_letters()

    def b_bytes(i):
        p = b_lib.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b_lib.is_byte(i) else p.replace("▁", " ").encode()
    docs = []
    for x in texts:
        a = a_lib.encode(" " + x, add_special_tokens=False).ids if x else []
        b = b_lib.encode(x) if x else []
        ab, bb = [bytes(letters[c] for c in a_lib.id_to_token(i)) for i in a], [b_bytes(i) for i in b]
        if not x or b"".join(ab) != (" " + x).encode() or b"".join(bb) != (" " + x).encode():
            docs.append(None)
            continue
        a_end, b_end = np.cumsum([len(t) for t in ab]).tolist(), np.cumsum([len(t) for t in bb]).tolist()
        cuts = sorted(set(a_end) & set(b_end))
        links = list(zip(map(dict(zip(a_end, a)).get, cuts), map(dict(zip(b_end, b)).get, cuts)))
        groups, i, j = [], 0, 0
        for c in cuts:
            ga, gb = [], []
            while i < len(a) and a_end[i] <= c:
                ga.append(str(a[i]))
                i += 1
            while j < len(b) and b_end[j] <= c:
                gb.append(str(b[j]))
                j += 1
            groups.append(",".join(ga) + "|" + ",".join(gb))
        docs.append((len(a), len(b), len(cuts), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    count = Counter(p for d in docs if d for p in d[3])
    most = Counter()
    for (_, b), c in count.items():
        most[b] = max(most[b], c)
    return [(0, 0, 0, 0, 0, 0, "") if d is None else (*d[:3], len(d[3]), sum(count[p] == most[p[1]] for p in d[3]), sum(count[p] for p in d[3]), d[4]) for d in docs]


def rows(df):
    return {r.doc_id: tuple(r[c] for c in X.ALIGNED) for r in df.collect()}


def test_query(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = dict(zip([d.doc_id for d in docs], brute([d.text for d in docs])))
    assert rows(QUERIES["op12_cross_tokenizer_alignment"](spark, SF_SMALL)) == want


def texts():
    r = random.Random(7)
    lib = sentencepiece.SentencePieceProcessor(model_file=X.PIECE_BPE)
    some = [lib.id_to_piece(i).replace("▁", " ") for i in r.sample(range(259, 32000), 2000)]
    hard = HARD + ["  a", "a  ", " a  b ", "\n x", "x \n y", "\x1cx \x1fy", "a  b  c", "it's 's we'll  've", "<|endoftext|> x <|endoftext|>", "</s> <unk> <0x41>", "é x", "😀 😀😀", "a ▁b", "12 3456  789"]
    return hard + ["".join(r.choices(some, k=r.randrange(1, 40))) for _ in range(150)] + ["".join(r.choices("ab1 .'\n\t é日\x1c", k=r.randrange(1, 60))) for _ in range(300)]


SCHEMA = "doc_id long, text string, n_a string, part int, keys string"


def test_edge_rows(spark):
    xs = [*texts(), None, "", "long words " * 30_000, "x" * 5000]
    xs += xs[:20]
    df = spark.createDataFrame([(i, x, "q", 1, "k") for i, x in enumerate(xs)], SCHEMA).repartition(5)
    got = rows(X.align(df))
    for i, want in enumerate(brute([x or "" for x in xs])):
        assert got[i] == want, xs[i][:50]
    assert X.align(df.limit(0)).collect() == []
    twice = X.align(spark.createDataFrame([(None, "one two", "", 0, ""), (None, "one two", "", 0, "")], SCHEMA)).collect()
    assert len(twice) == 2 and twice[0] == twice[1] and twice[0].count_sum == 2 * twice[0].n_links


def test_texts_longer_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(X, "BLOCK", 50)
    xs = ["some words here " * 20, "one ▁bad " + "word " * 30, "word " * 30 + "▁", "y" * 500, "tail " * 11]
    got = list(X.blocks(xs))
    assert sum(len(b) for b in got) > 12 and [" ".join(" ".join(w) for b in got for r, w, _ in b if r == i) for i in range(5)] == xs
    models = X.read_models()
    aligner = X.Aligner(models, True)
    for x, want in zip(xs, brute(xs)):
        names, good, n = [], True, 0
        for block in X.blocks([x]):
            for codes in aligner.numbers(block):
                good &= bool(aligner.good[codes].all())
                names += [aligner.names[c] for c in codes]
                n += int(aligner.facts[2, codes].sum())
        assert not good and want[6] == "" or (n, hashlib.sha256(";".join(names).encode()).hexdigest()) == (want[3], want[6])


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 200_000])
def test_perfect_hash(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 60, n))
    h = X.PerfectHash(keys)
    got = h.find(keys)
    assert sorted(got.tolist()) == list(range(len(keys))) and (h.keys[got] == keys).all() if n else len(got) == 0
    assert (h.find(keys + 1)[~np.isin(keys + 1, keys)] == -1).all()
    with pytest.raises(ValueError):
        X.PerfectHash(np.array([5, 5, 6]))


def test_pair_bound():
    a, b = [b"x", b"ab", b"b", b"cab"], [b"b", b"ab", b"zab", b"q"]
    assert X.pair_bound(a, b) == sum(p.endswith(q) or q.endswith(p) for p in a for q in b)
    m = X.read_models()
    assert X.pair_bound(m["a_bytes"], m["b_bytes"]) < 1_000_000
