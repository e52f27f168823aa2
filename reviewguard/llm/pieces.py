"""SentencePiece models as weighted finite-state transducers: encoding, decoding and counting.

The transducer is compiled from a model file: the normaliser (blank -> U+2581, optional
dummy prefix and blank squeezing), one arc per piece and byte-fallback arcs for characters that no
piece has. An Aho-Corasick automaton over the pieces composes it with an input: it lists
every arc that ends at each position. The shortest path in the tropical semiring is
found from left to right:

* unigram model: an arc costs minus its score (32-bit sums, as the library has them); of
  equal paths the one whose last piece starts earliest wins, as there;
* BPE model: an arc costs 0 after a piece that it may follow and infinity otherwise, where "may
  follow" means that merging the two pieces' characters by rank gives just these two pieces; the last merges of
  both pieces, undone one by one, tell that.
  A segmentation is the model's own exactly if all neighbours may follow each other, so one
  path of cost 0 is left. Scores alone can't give it: BPE isn't a sum of piece scores.

No piece has a U+2581 behind another character, so paths are found per word and kept in
a bounded table.
"""

from __future__ import annotations

import hashlib
import re
from itertools import chain
from weakref import WeakMethod

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import packed, small_batches, unpacked

BLANK = "▁"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
KNOWN_WORDS = 150_000     # words whose paths a task keeps, besides as many older ones


MOST_PAIRS = 1 << 21      # neighbours whose check a task keeps


def read_model(path: str = MODEL) -> dict:
    """What the transducer needs of a model file (bounded by the vocabulary)."""
    from sentencepiece import sentencepiece_model_pb2 as pb
    m = pb.ModelProto()
    with open(path, "rb") as f:
        m.ParseFromString(f.read())
    return describe(m)


def describe(m) -> dict:
    if m.trainer_spec.model_type not in (1, 2):
        raise ValueError("only unigram and BPE models are compiled")
    if m.normalizer_spec.precompiled_charsmap:
        raise ValueError("only the identity character map is compiled")
    scores = {p.piece: p.score for p in m.pieces if p.type in (1, 4)}
    return {"bpe": m.trainer_spec.model_type == 2, "merges": last_merges(scores) if m.trainer_spec.model_type == 2 else None, "bytes": m.trainer_spec.byte_fallback, "prefix": m.normalizer_spec.add_dummy_prefix,
            "squeeze": m.normalizer_spec.remove_extra_whitespaces, "pieces": [(p.piece, p.score, p.type) for p in m.pieces]}


def merge(text: str, score: dict, last: dict | None = None) -> list[str]:
    """Merge neighbours, best score first, leftmost of equals. ``last`` gets each merged part's two halves."""
    parts = list(text)
    while len(parts) > 1:
        best, at = None, 0
        for i in range(len(parts) - 1):
            s = score.get(parts[i] + parts[i + 1])
            if s is not None and (best is None or s > best):
                best, at = s, i
        if best is None:
            break
        if last is not None:
            last[parts[at] + parts[at + 1]] = parts[at], parts[at + 1]
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


def last_merges(score: dict) -> dict[str, tuple[str, str]]:
    """The two halves of every piece that its own characters merge to; a piece that they don't merge to is never made."""
    out = {}
    for p in score:
        last: dict = {}
        if len(p) > 1 and len(merge(p, score, last)) == 1:
            out[p] = last[p]
    return out


class Known(dict):
    """Words to what a transducer's method makes of them, computed when first asked for; ``turn`` keeps the table within bounds.

    It holds the method weakly: a task's transducer and tables go with the task, they don't stay in the worker beside the next ones."""

    def __init__(self, of):
        super().__init__()
        self.of, self.old = WeakMethod(of), {}

    def __missing__(self, word: str):
        got = self.old.get(word)
        got = self[word] = self.of()(word) if got is None else got
        return got

    def turn(self) -> None:
        """What is known gets old once there are KNOWN_WORDS; older ones that weren't asked for since go."""
        if len(self) > KNOWN_WORDS:
            self.old = dict(self)
            self.clear()


class Transducer:
    def __init__(self, model: dict):
        self.model, self.known, self.counts = model, Known(self.ids_of), Known(self.count_word)
        types = {kind: [i for i, p in enumerate(model["pieces"]) if p[2] == kind] for kind in range(1, 7)}
        self.unk = types[2][0] if types[2] else 0
        self.byte = {int(model["pieces"][i][0][1:-1], 16): i for i in types[6]}
        self.out = [p.replace(BLANK, " ").encode() if kind in (1, 4) else bytes([int(p[1:-1], 16)]) if kind == 6 else b" \xe2\x81\x87 " if kind == 2 else b"" for p, _, kind in model["pieces"]]
        normal = [(model["pieces"][i][0], i, np.float32(model["pieces"][i][1])) for kind in (1, 4) for i in types[kind]]
        self.score = {p: s for p, _, s in normal}
        self.follows: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        if model["bpe"]:
            # merges come in the order of falling scores
            self.rank = {p: n for n, p in enumerate(sorted(self.score, key=lambda p: -self.score[p]))}
            for n, (p, s) in enumerate(sorted(self.score.items(), key=lambda x: -x[1])):
                if n and s == level:
                    self.rank[p] = self.rank[before]
                level, before = s, p
            # trained pieces rank behind their halves; with one that doesn't (runs of blanks) merges are replayed
            self.replayed: set[str] = set()
            for p, two in sorted(model["merges"].items(), key=lambda x: len(x[0])):
                if any(h in self.replayed or len(h) > 1 and self.rank[p] <= self.rank[h] for h in two):
                    self.replayed.add(p)
        for p, i, s in normal:
            if not model["bpe"] or len(p) == 1 or p in model["merges"]:
                self.automaton.add_word(p, (len(p), i) if model["bpe"] else (len(p), p, i, s))
        self.automaton.make_automaton()
        self.low = np.float32(min([s for _, _, s in normal], default=np.float32(0)) - np.float32(10))
        cut = not any(re.search(f"[^{BLANK}]{BLANK}", p) for p in self.score)
        self.words = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+" if cut else "(?s).+").findall

    def may_follow(self, a: str, b: str) -> bool:
        return merge(a + b, self.score) == [a, b] if a in self.replayed or b in self.replayed else self.stay_apart(a, b)

    def follow(self, key: int) -> bool:
        """May the piece in the lower half of ``key`` follow the upper half: a piece, or a character behind all pieces."""
        if len(self.follows) > MOST_PAIRS:
            self.follows.clear()
        a, b = key >> 32, key & 0xFFFFFFFF
        many = len(self.model["pieces"])
        got = self.follows[key] = self.may_follow(self.model["pieces"][a][0] if a < many else chr(a - many), self.model["pieces"][b][0])
        return got

    def stay_apart(self, a: str, b: str) -> bool:
        """Whether no merge across the border comes before those that make ``a`` and ``b``.

        The pieces' last merges are undone, the latest first. What stands at the border between two undoings lasts
        until the earlier one's merge; a merge across it of lower rank would have come before. Of equal ranks the
        left merge comes first: that of ``a`` before one across, one across before that of ``b``. Holds where both pieces and all their parts rank behind their halves."""
        rank, halves, never = self.rank, self.model["merges"], len(self.score)
        by, strict = never, True         # a merge across must rank below ``by`` (or, not strict, as ``by``) to come first
        while True:
            across = rank.get(a + b)
            if across is not None and (across < by or across == by and not strict):
                return False
            a_halves, b_halves = halves.get(a), halves.get(b)
            a_rank, b_rank = rank[a] if a_halves else -1, rank[b] if b_halves else -1
            if a_rank < 0 and b_rank < 0:
                return True
            # of equal ranks the left one is merged first, so the right one is undone first
            if a_rank > b_rank:
                by, strict, a = a_rank, True, a_halves[1]
            else:
                by, strict, b = b_rank, False, b_halves[0]

    def ids_bpe(self, word: str) -> list[int]:
        """Ids of one word's one path of finite cost; a character without an arc has the number of all pieces plus its code."""
        last: list = [None] * (len(word) + 1)
        begin, follows, many = [0] * (len(word) + 1), self.follows, len(self.model["pieces"])
        for end, (size, i) in self.automaton.iter(word):
            pos = end + 1
            if last[pos] is not None:
                continue
            start = pos - size
            if start:
                if last[start] is None:
                    self.unknown(word, last, begin, start)
                key = last[start] << 32 | i
                ok = follows.get(key)
                if not (self.follow(key) if ok is None else ok):
                    continue
            last[pos], begin[pos] = i, start
        pos, ids, plain = len(word), [], True
        if pos and last[pos] is None:
            self.unknown(word, last, begin, pos)
        while pos:
            i = last[pos]
            if i >= many:
                plain = False
            ids.append(i)
            pos = begin[pos]
        ids.reverse()
        return ids if plain else list(self.spelled(ids, many))

    def unknown(self, word: str, last: list, begin: list, pos: int) -> None:
        """Characters without an arc, from ``pos`` back."""
        while pos and last[pos] is None:
            last[pos], begin[pos] = len(self.model["pieces"]) + ord(word[pos - 1]), pos - 1
            pos -= 1

    def spelled(self, ids: list[int], many: int):
        """Unknown characters as their bytes, or a run of them as one unknown piece."""
        run = False
        for i in ids:
            if i < many:
                yield i
            elif self.model["bytes"]:
                yield from (self.byte[b] for b in chr(i - many).encode("utf-8", "replace"))
            elif not run:
                yield self.unk
            run = i >= many

    def arcs_unigram(self, word: str) -> list[tuple[int, str, int]]:
        """Per end position the (piece id or -1, text, start) of the last arc of the path of the largest score to there."""
        arcs: list[list] = [[] for _ in range(len(word) + 1)]
        for end, arc in self.automaton.iter(word):
            arcs[end + 1].append(arc)
        back: list = [None] * (len(word) + 1)
        cost = [np.float32(0)] * (len(word) + 1)
        for pos in range(1, len(word) + 1):
            found = None
            for size, piece, i, s in arcs[pos]:
                start = pos - size
                c = cost[start] + s
                if found is None or c > cost[pos]:
                    found, cost[pos] = (i, piece, start), c
            if word[pos - 1] not in self.score and (found is None or cost[pos - 1] + self.low > cost[pos]):
                found, cost[pos] = (-1, word[pos - 1], pos - 1), cost[pos - 1] + self.low
            back[pos] = found
        return back

    def path(self, word: str) -> list[tuple[int, str]]:
        """The shortest path's (piece id or -1, text) of one word."""
        back = self.arcs_unigram(word)
        out, pos = [], len(word)
        while pos:
            i, piece, pos = back[pos]
            out.append((i, piece))
        return out[::-1]

    def ids_of(self, word: str) -> list[int]:
        """Ids of one word."""
        if self.model["bpe"]:
            return self.ids_bpe(word)
        ids: list[int] = []
        for i, piece in self.path(word):
            if i >= 0:
                ids.append(i)
            elif self.model["bytes"]:
                ids += [self.byte[b] for b in piece.encode("utf-8", "replace")]
            elif not ids or ids[-1] != self.unk:
                ids.append(self.unk)
        return ids

    def normalise(self, text: str) -> str:
        if self.model["squeeze"]:
            text = re.sub(" +", " ", text).strip(" ")
        if text and self.model["prefix"]:
            text = " " + text
        return text.replace(" ", BLANK)

    def encode(self, text: str) -> list[int]:
        """Ids of a text."""
        self.known.turn()
        return list(chain.from_iterable(map(self.known.__getitem__, self.words(self.normalise(text)))))

    def decode(self, ids) -> str:
        """The text of ids; the dummy prefix's blank goes, broken bytes become U+FFFD."""
        raw = b"".join(map(self.out.__getitem__, ids))
        if (self.model["prefix"] or self.model["squeeze"]) and raw[:1] == b" ":
            raw = raw[1:]
        return raw.decode("utf-8", "replace")

    def count(self, text: str) -> int:
        """Number of pieces, from the counts that the paths carry."""
        self.counts.turn()
        return sum(map(self.counts.__getitem__, self.words(self.normalise(text))))

    def count_word(self, word: str) -> int:
        """Viterbi that carries (score, pieces) per position and keeps no way back but the last piece."""
        if self.model["bpe"]:
            return self.count_bpe(word)
        arcs: list[list] = [[] for _ in range(len(word) + 1)]
        for end, arc in self.automaton.iter(word):
            arcs[end + 1].append(arc)
        many = self.model["bytes"]
        score, pieces, last = [np.float32(0)] * (len(word) + 1), [0] * (len(word) + 1), [""] * (len(word) + 1)
        for pos in range(1, len(word) + 1):
            done = False
            for size, piece, _, s in arcs[pos]:
                start = pos - size
                if not done or score[start] + s > score[pos]:
                    score[pos], pieces[pos], last[pos], done = score[start] + s, pieces[start] + 1, piece, True
            c = word[pos - 1]
            if c not in self.score and (not done or score[pos - 1] + self.low > score[pos]):
                new = len(c.encode("utf-8", "replace")) if many else int(last[pos - 1] != "\0")
                score[pos], pieces[pos], last[pos] = score[pos - 1] + self.low, pieces[pos - 1] + new, c if many else "\0"
        return pieces[-1]

    def count_bpe(self, word: str) -> int:
        """The same where one path has a finite cost: the count and the last piece per position."""
        many = len(self.model["pieces"])
        pieces, last, follows = [0] * (len(word) + 1), [-1] * (len(word) + 1), self.follows
        for end, (size, i) in self.automaton.iter(word):
            pos = end + 1
            if pieces[pos]:
                continue
            start = pos - size
            if start:
                if not pieces[start]:
                    self.count_unknown(word, pieces, last, start)
                key = last[start] << 32 | i
                ok = follows.get(key)
                if not (self.follow(key) if ok is None else ok):
                    continue
            pieces[pos], last[pos] = pieces[start] + 1, i
        if word and last[-1] < 0:
            self.count_unknown(word, pieces, last, len(word))
        return pieces[-1]

    def count_unknown(self, word: str, pieces: list, last: list, pos: int) -> None:
        """Counts up to ``pos`` over characters without an arc: their bytes, or one unknown piece for a run of them."""
        at, many = pos, len(self.model["pieces"])
        while at and last[at] < 0:
            at -= 1
        run = at > 0 and last[at] >= many
        for i in range(at + 1, pos + 1):
            new = len(word[i - 1].encode("utf-8", "replace")) if self.model["bytes"] else int(not run)
            pieces[i], last[i], run = pieces[i - 1] + new, many + ord(word[i - 1]), True


def encode_texts(docs: DataFrame, model: dict | None = None, text: str = "text") -> DataFrame:
    """``docs`` with ids array<int>, n_tokens long, round_trip boolean and decoded_sha256 string.

    Whole texts are encoded as the model's own library does, then decoded again: round_trip says whether that gives the
    text, decoded_sha256 is the digest of what it gives. Null and empty texts have no ids and decode to the empty text (a null
    one counts as that). A text that holds U+2581 itself doesn't round-trip (the model reads it as a blank). Repeated rows
    come back each; other columns are kept, under any name (those of the new names are replaced); an empty table gives an empty result."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model or read_model())
    rows = packed(docs, text=F.col(text).cast("string"))

    def run(batches):
        t = Transducer(shared.value)
        for b in batches:
            for lo in range(0, b.num_rows, 128):
                part = b.slice(lo, 128)
                texts = [x or "" for x in part.column(1).to_pylist()]
                got = [t.encode(x) for x in texts]
                back = [t.decode(g) for g in got]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([np.array(g, np.int32) for g in got], pa.list_(pa.int32())), pa.array([len(g) for g in got], pa.int64()), pa.array([x == y for x, y in zip(texts, back)]),
                                                  pa.array([hashlib.sha256(y.encode("utf-8", "replace")).hexdigest() for y in back])], ["row", *NEW])
    extra = [T.StructField(n, kind) for n, kind in zip(NEW, (T.ArrayType(T.IntegerType()), T.LongType(), T.BooleanType(), T.StringType()))]
    return unpacked(rows.mapInArrow(run, T.StructType([rows.schema["row"], *extra])), docs.columns, **{n: F.col(n) for n in NEW})


NEW = ("ids", "n_tokens", "round_trip", "decoded_sha256")


def decode_ids(rows: DataFrame, model: dict | None = None, ids: str = "ids", into: str = "text") -> DataFrame:
    """``rows`` with the text of the id arrays; null ids give a null text."""
    shared = rows.sparkSession.sparkContext.broadcast(model or read_model())

    @F.pandas_udf("string")
    def run(column):
        t = Transducer(shared.value)
        return column.map(lambda x: None if x is None else t.decode(x))
    return rows.withColumn(into, run(F.col(ids)))


def token_counts(docs: DataFrame, model: dict | None = None, text: str = "text") -> DataFrame:
    """``docs`` with n_tokens long: the number of pieces of the whole text, without making ids.

    A null or empty text has none. Repeated rows come back each; other columns are kept, under any name (one
    named n_tokens is replaced); an empty table gives an empty result."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model or read_model())
    rows = packed(docs, text=F.col(text).cast("string"))

    def run(batches):
        t = Transducer(shared.value)
        for b in batches:
            for lo in range(0, b.num_rows, 128):
                part = b.slice(lo, 128)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([t.count(x or "") for x in part.column(1).to_pylist()], pa.int64())], ["row", "n_tokens"])
    got = rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField("n_tokens", T.LongType())]))
    return unpacked(got, docs.columns, n_tokens=F.col("n_tokens"))
