"""Cross-tokenizer alignment: groups and links of two tokenizers' tokens, link counts by minimal perfect hashing.

First pass: tasks align their documents and write distinct id pairs with counts. The pairs get a minimal
perfect hash; counts become dense vectors indexed by it, summed in a tree. Second pass: documents are
aligned again, and each link looks its count up (the stored key says whether it is that pair's place).

An A token and a B token whose byte ranges end together hold equal bytes up to there, so the bytes of one are a suffix
of the other's. The pairs for which this holds are known from the vocabularies: their number (``pair_bound``) limits
everything that the driver and the broadcast hold, whatever the size of the corpus."""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved
from .treesum import SLICES, slices, tree_sum

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_BPE = "/opt/tokenizers/piece_bpe_32k.model"

#: Fixed value: how the byte-level tokenizer cuts a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BLANK = "▁"

#: Characters of texts that are aligned at once; words that a task remembers; words that are tokenized in one call.
BLOCK, KNOWN, CALL = 2 << 20, 600_000, 1000


def byte_letters() -> dict[str, int]:
    """Letter -> byte of the byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_byte_bpe(data: str) -> list[bytes]:
    """Token bytes by id of a byte-level BPE tokenizer file, special tokens left out.

    Merge order must be id order (ValueError otherwise): then ids are ranks."""
    doc = json.loads(data)
    model, letters = doc["model"], byte_letters()
    if doc["pre_tokenizer"]["type"] != "ByteLevel" or doc["pre_tokenizer"].get("add_prefix_space") or doc["normalizer"] or not doc["pre_tokenizer"].get("use_regex", True):
        raise ValueError("not a plain byte-level tokenizer")
    special = {t["content"] for t in doc["added_tokens"]}
    order = sorted((i, t) for t, i in model["vocab"].items() if t not in special)
    merged = [t for _, t in order if len(t) > 1]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    if merged != ["".join(p) for p in pairs] or [i for i, _ in order] != list(range(len(order))):
        raise ValueError("ids don't follow the merge order")
    return [bytes(letters[c] for c in t) for _, t in order]


def read_piece_bpe(data: bytes) -> list[bytes]:
    """Token bytes by id of a SentencePiece model. ValueError where a piece crosses a word's beginning or the normaliser changes texts."""
    from sentencepiece import sentencepiece_model_pb2 as pb
    m = pb.ModelProto()
    m.ParseFromString(data)
    if m.normalizer_spec.precompiled_charsmap or m.normalizer_spec.remove_extra_whitespaces or not m.normalizer_spec.add_dummy_prefix:
        raise ValueError("the normaliser changes texts")
    if any(BLANK in p.piece.lstrip(BLANK) for p in m.pieces if p.type == 1):
        raise ValueError("a piece crosses a word's beginning")
    return [bytes([int(p.piece[3:5], 16)]) if p.type == 6 else p.piece.replace(BLANK, " ").encode() for p in m.pieces]


def pair_bound(a: list[bytes], b: list[bytes]) -> int:
    """Number of (A, B) id pairs of which one's bytes are a suffix of the other's."""
    def having(of, among):
        count: dict = {}
        for t in among:
            count[t] = count.get(t, 0) + 1
        return sum(count.get(t[i:], 0) for t in of for i in range(len(t)))
    same: dict = {}
    for t in b:
        same[t] = same.get(t, 0) + 1
    return having(a, b) + having(b, a) - sum(same.get(t, 0) for t in a)


# ---- minimal perfect hash ----
def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """Well-mixed 64 bits of integer keys (multiply, shift, xor; twice)."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2 ** 64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Distinct integer keys to 0..n-1, no gap: a cascade of bit tables.

    A key that has a bit of its table to itself takes it, the others go on to the next table; a key's number is the
    count of set bits before its own. ``keys`` holds the key of each number, so a foreign key is told apart."""

    def __init__(self, keys: np.ndarray, room: float = 1.5):
        left, self.tables, n = np.asarray(keys, np.int64), [], 0
        self.keys = np.empty(len(left), np.int64)
        while len(left):
            size = int(len(left) * room) + 1
            at = (mixed(left, len(self.tables)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            before = np.cumsum(alone) - alone + n
            got = alone[at]
            self.tables.append((alone, before))
            self.keys[before[at[got]]] = left[got]
            n += int(got.sum())
            if len(self.tables) > 200:
                raise ValueError("keys repeat")
            left = left[~got]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of keys, -1 for foreign ones."""
        out, todo = np.full(len(keys), -1), np.arange(len(keys))
        for level, (alone, before) in enumerate(self.tables):
            at = (mixed(keys[todo], level) % np.uint64(len(alone))).astype(np.int64)
            got = alone[at]
            out[todo[got]] = before[at[got]]
            todo = todo[~got]
            if not len(todo):
                break
        bad = out >= 0
        bad[bad] = self.keys[out[bad]] != keys[bad]
        out[bad] = -1
        return out


# ---- alignment of words ----
#: A blank between two characters that are no blanks begins a token in both tokenizers, whatever stands around it.
CUT = re.compile(r"(?<=\S) (?=\S)")
#: A blank that has another beside it, or an end of the text.
BESIDE = re.compile(r" (?:\s|$|(?<=\s )|(?<=^ ))")


def words_of(text: str) -> list[str]:
    """The parts of a text between the blanks of CUT."""
    return CUT.split(text) if BESIDE.search(text) else text.split(" ")


def blocks(texts):
    """Words of texts, in blocks of about BLOCK characters: lists of (row, words, last); a long text goes over several blocks."""
    out, held = [], 0
    for row, text in enumerate(texts):
        at = 0
        while True:
            end = len(text)
            if end - at > BLOCK and (m := CUT.search(text, at + BLOCK)):
                end = m.start()
            out.append((row, words_of(text[at:end]), end == len(text)))
            held += end - at
            if held >= BLOCK:
                yield out
                out, held = [], 0
            if end == len(text):
                break
            at = end + 1
    if out:
        yield out


class Numbers(dict):
    """Words to numbers; an unknown word gets the next one and is listed in ``new``."""

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        self.new.append(word)
        return n


class Aligner:
    """Aligns words once and remembers them: tokens, groups and links of A and B by word number.

    A text's words are its parts between the blanks of CUT, each with a blank before it. There both
    tokenizers begin a token, so the text's tokens are its words' tokens."""

    def __init__(self, model: dict, spell: bool):
        import sentencepiece
        import tiktoken
        self.a_bytes, self.b_bytes = model["a_bytes"], model["b_bytes"]
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks={t: i for i, t in enumerate(self.a_bytes)}, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model["b_model"])
        self.a_size, self.b_size = (np.array([len(t) for t in x]) for x in (self.a_bytes, self.b_bytes))
        self.spell = spell
        if spell:
            def table(n, marks):
                return np.array([f"{i}{m}" for m in marks for i in range(n)], object)
            self.a_name, self.b_name = table(len(self.a_bytes), ",|"), table(len(self.b_bytes), (",", ";", ""))
        self.forget()

    def forget(self) -> None:
        self.known, self.new = Numbers(), []
        self.known.new = self.new
        self.facts = np.zeros((4, 1024), np.int64)      # n_a, n_b, number of links, first link
        self.good = np.zeros(1024, bool)
        self.names: list[str] = []
        self.links, self.used = np.zeros(4096, np.int64), 0

    def numbers(self, block) -> list[np.ndarray]:
        """Word numbers of a block's texts. Forgets first where too much is known; then numbers from before mean nothing."""
        if len(self.known) > KNOWN:
            self.forget()
        at = self.known.__getitem__
        out = [np.fromiter(map(at, words), np.int64, len(words)) for _, words, _ in block]
        for i in range(0, len(self.new), CALL):
            self.learn(self.new[i:i + CALL])
        self.new.clear()
        return out

    def learn(self, words: list[str]) -> None:
        """Facts of new words, in the order of their numbers."""
        if all(w and " " not in w and w.strip() is w for w in words) and self.align(words):
            return
        for w in words:
            if not self.align([w]):
                self.keep(np.zeros((3, 1), np.int64), np.zeros(0, np.int64), [""], False)

    def keep(self, facts, links, names, good) -> None:
        n, m = len(self.names), len(names)
        while n + m > len(self.good):
            self.facts, self.good = np.hstack([self.facts, np.zeros_like(self.facts)]), np.hstack([self.good, np.zeros_like(self.good)])
        while self.used + len(links) > len(self.links):
            self.links = np.hstack([self.links, np.zeros_like(self.links)])
        self.facts[:3, n:n + m] = facts
        self.facts[3, n:n + m] = self.used + np.cumsum(facts[2]) - facts[2]
        self.good[n:n + m] = good
        self.links[self.used:self.used + len(links)] = links
        self.used += len(links)
        self.names += names

    def align(self, words: list[str]) -> bool:
        """Remember words, tokenized in one call; False where the tokens' bytes differ from the words'.

        Several words at once must hold no space and neither begin nor end with another blank."""
        text = " ".join(words)
        raw = b" " + text.encode()
        a, b = self.a.encode_ordinary(" " + text), self.b.encode(text)
        if b"".join(map(self.a_bytes.__getitem__, a)) != raw or b"".join(map(self.b_bytes.__getitem__, b)) != raw:
            return False
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        ends = np.flatnonzero(np.frombuffer(raw + b" ", np.uint8) == 32)[1:] if len(words) > 1 else np.array([len(raw)])
        both, ia, ib = np.intersect1d(a_end, b_end, assume_unique=True, return_indices=True)
        if not np.isin(ends, both, assume_unique=True).all():
            return False
        n = len(words)
        of = [np.bincount(np.searchsorted(ends, x), minlength=n) for x in (a_end, b_end, both)]
        names = self.spelled(a, b, ia, ib, of) if self.spell else [""] * n
        self.keep(np.array(of), (a[ia] << 32) | b[ib], names, True)
        return True

    def spelled(self, a, b, ia, ib, of) -> list[str]:
        """Each word's groups: its A ids, a bar, its B ids; semicolons between groups, none after the last."""
        n_a, n_b = len(self.a_bytes), len(self.b_bytes)
        a_mark, b_mark = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        a_mark[ia], b_mark[ib] = 1, 1
        b_mark[np.cumsum(of[1]) - 1] = 2
        # a group's A tokens come before its B tokens: each token moves behind the other side's tokens of the groups before
        out = np.empty(len(a) + len(b), object)
        a_group, b_group = np.searchsorted(ia, np.arange(len(a))), np.searchsorted(ib, np.arange(len(b)))
        b_before, a_upto = np.concatenate([[0], ib + 1]), ia + 1
        out[np.arange(len(a)) + b_before[a_group]] = self.a_name[a + n_a * a_mark]
        out[np.arange(len(b)) + a_upto[b_group]] = self.b_name[b + n_b * b_mark]
        cut = np.concatenate([[0], np.cumsum(of[0] + of[1])])
        out = out.tolist()
        return ["".join(out[i:j]) for i, j in zip(cut[:-1].tolist(), cut[1:].tolist())]

    def links_of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions in ``links``, index into ``words``) of all links of the words."""
        count, first = self.facts[2, words], self.facts[3, words]
        which = np.repeat(np.arange(len(words)), count)
        return first[which] + np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count), which


def texts_of(column: pa.Array) -> list:
    """Texts of a binary column; None for null, empty and broken UTF-8."""
    out = []
    for x in column.to_pylist():
        try:
            out.append(x.decode() if x else None)
        except UnicodeDecodeError:
            out.append(None)
    return out


class Counts:
    """Distinct keys with their counts, merged when many have gathered."""

    def __init__(self):
        self.keys, self.counts, self.parts, self.held = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((keys, counts))
        self.held += len(keys)
        if self.held > 1 << 21:
            self.merge()

    def merge(self) -> None:
        keys = np.concatenate([self.keys, *(k for k, _ in self.parts)])
        counts = np.concatenate([self.counts, *(c for _, c in self.parts)])
        self.keys, at = np.unique(keys, return_inverse=True)
        self.counts = np.zeros(len(self.keys), np.int64)
        np.add.at(self.counts, at, counts)
        self.parts, self.held = [], 0


# ---- passes ----
def read_models(byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE) -> dict:
    """What tasks need of the two tokenizer files."""
    with open(byte_bpe, encoding="utf-8") as f:
        a = read_byte_bpe(f.read())
    with open(piece_bpe, "rb") as f:
        data = f.read()
    return {"a_bytes": a, "b_bytes": read_piece_bpe(data), "b_model": data}


def pair_counts(docs: DataFrame, models: dict, text: str = "text") -> tuple[PerfectHash, np.ndarray]:
    """First pass: the minimal perfect hash of all linked id pairs (A id << 32 | B id) and their corpus-wide counts."""
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches):
        aligner, total = Aligner(shared.value, False), Counts()
        for batch in batches:
            waiting: list = []        # parts of a text that goes on: counted once its last part proves good
            for block in blocks(x or "" for x in texts_of(batch.column(0))):
                numbers = aligner.numbers(block)
                times = np.zeros(len(aligner.names), np.int64)
                for (_, _, last), codes in zip(block, numbers):
                    good = aligner.good[codes].all() and None not in waiting
                    if last and not waiting:
                        if good:
                            np.add.at(times, codes, 1)
                        continue
                    at, _ = aligner.links_of(codes)
                    waiting.append(np.unique(aligner.links[at], return_counts=True) if good else None)
                    if last:
                        if None not in waiting:
                            for keys, counts in waiting:
                                total.add(keys, counts)
                        waiting = []
                used = np.flatnonzero(times)
                at, which = aligner.links_of(used)
                total.add(aligner.links[at], times[used][which])
        total.merge()
        if len(total.keys):
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total.keys], pa.list_(pa.int64())), pa.array([total.counts], pa.list_(pa.int64()))], ["part", "keys", "counts"])

    sparse = saved(docs.select(F.col(text).cast("string").cast("binary").alias("text")).mapInArrow(run, "part int, keys array<long>, counts array<long>"), "pairs")
    distinct = saved(sparse.select(F.explode("keys").alias("key")).distinct(), "distinct")
    if distinct.count() > pair_bound(models["a_bytes"], models["b_bytes"]):
        raise ValueError("links of tokens that don't end alike")
    hashed = PerfectHash(np.sort(distinct.toPandas()["key"].to_numpy(np.int64)))
    table = docs.sparkSession.sparkContext.broadcast(hashed)

    def dense(batches):
        found = table.value
        for b in batches:
            total, part = np.zeros(len(found.keys), np.int64), None
            for p, keys, counts in zip(*(b.column(i) for i in range(3))):
                total[found.find(keys.values.to_numpy())] += counts.values.to_numpy()
                part = p.as_py()
            if part is not None:
                yield slices(part, total)

    return hashed, tree_sum(sparse.mapInArrow(dense, SLICES), np.int64)


def best_links(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Whether a pair's count is the highest of its B id's pairs."""
    b = keys & 0xFFFFFFFF
    most = np.zeros(int(b.max(initial=0)) + 1, np.int64)
    np.maximum.at(most, b, counts)
    return counts == most[b]


ALIGNED = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def align(docs: DataFrame, models: dict | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Texts that are null, empty, no valid UTF-8, or that the tokens of A or B don't spell byte by byte (U+2581 in a
    text) have zeros and an empty groups_sha256, and count nowhere. Rows that repeat count and come back each; a null
    id stays; an empty table gives an empty result; other columns aren't returned and may have any name. A document
    of any length is aligned in blocks, its digest updated block by block."""
    models = models or read_models()
    hashed, counts = pair_counts(docs, models, text)
    shared = docs.sparkSession.sparkContext.broadcast((models, hashed, counts, best_links(hashed.keys, counts)))

    def run(batches):
        models, hashed, counts, best = shared.value
        aligner = Aligner(models, True)
        for batch in batches:
            texts = texts_of(batch.column(1))
            facts, digests, bad = np.zeros((6, len(texts)), np.int64), [""] * len(texts), np.array([x is None for x in texts])
            digest = None
            for block in blocks(x or "" for x in texts):
                numbers = aligner.numbers(block)
                # sums over the links of each word that this block uses
                used = np.unique(np.concatenate(numbers))
                at, which = aligner.links_of(used)
                found = hashed.find(aligner.links[at])
                per = np.zeros((6, len(aligner.names)), np.int64)
                per[:2, used] = aligner.facts[:2, used]
                per[2, used] = per[3, used] = aligner.facts[2, used]
                np.add.at(per[4], used[which], best[found] & (found >= 0))
                np.add.at(per[5], used[which], np.where(found >= 0, counts[found], 0))
                for (row, _, last), codes in zip(block, numbers):
                    if not bad[row]:
                        bad[row] = not aligner.good[codes].all()
                    if not bad[row]:
                        facts[:, row] += per[:, codes].sum(1)
                        digest, more = (digest, b";") if digest else (hashlib.sha256(), b"")
                        digest.update(more + ";".join(map(aligner.names.__getitem__, codes.tolist())).encode())
                    if last:
                        if not bad[row]:
                            digests[row] = digest.hexdigest()
                        digest = None
            facts[:, bad] = 0
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(f) for f in facts), pa.array(digests)], ["doc_id", *ALIGNED])
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, " + ", ".join(f"{c} long" for c in ALIGNED[:-1]) + ", groups_sha256 string")
