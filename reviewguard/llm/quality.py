"""Quality by ordinal cumulative-link regression on graded ratings.

P(grade <= k) = sigmoid(threshold_k - f(text)): one score f with weights over hashed words
and word shapes, shared by all grades, and ordered thresholds. It gives the expected grade and the
tail probability of the best grade, by which documents are selected.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import packed, small_batches, unpacked
from .toxicity import fold

SLOTS = 1 << 17            # hashed features
FIT_ROWS = 6_000           # bound of the labelled rows that are fitted
KNOWN_WORDS = 1 << 17      # words whose features a task keeps
_WORDS = re.compile(r"[^\x20\x09-\x0D]+").findall
_SHAPES = [(re.compile("[A-ZÀ-ÖØ-Þ]+"), "A"), (re.compile("[a-zà-öø-ÿ]+"), "a"), (re.compile("[0-9]+"), "0")]
_REPEAT, _FEW = 0, 1       # features of their own: a word like the one before; few different words


def _features(word: str) -> tuple[int, int]:
    shape = word
    for pattern, sign in _SHAPES:
        shape = pattern.sub(sign, shape)
    return 2 + zlib.crc32(word.lower().encode("utf-8", "replace")) % (SLOTS - 2), 2 + zlib.crc32(b"\1" + shape.encode("utf-8", "replace")) % (SLOTS - 2)


def text_features(text: str | None, known: dict) -> tuple[np.ndarray, np.ndarray]:
    """(slots, values) of a whole text: shares of its words, shapes and repeats; no word: none."""
    words = _WORDS(text or "")
    if not words:
        return np.zeros(0, np.int64), np.zeros(0)
    pairs = []
    for w in words:
        got = known.get(w)
        if got is None:
            if len(known) >= KNOWN_WORDS:
                known.clear()
            got = known[w] = _features(w)
        pairs.append(got)
    both = np.array(pairs, np.int64)
    slots, counts = np.unique(both, return_counts=True)
    repeats = float((both[1:, 0] == both[:-1, 0]).mean()) if len(both) > 1 else 0.0
    few = 1 - len(np.unique(both[:, 0])) / len(both)
    return np.concatenate(([_REPEAT, _FEW], slots)), np.concatenate(([repeats, few], counts / len(words)))


def fit(x: list[tuple[np.ndarray, np.ndarray]], grade: np.ndarray, grades: int, steps: int = 150, pull: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by Adam on the cumulative-link likelihood; grade counts from 0."""
    row = np.repeat(np.arange(len(x)), [len(s) for s, _ in x])
    slot, value = np.concatenate([s for s, _ in x]), np.concatenate([v for _, v in x])
    w, gaps = np.zeros(SLOTS), np.zeros(max(grades - 1, 1))
    share = np.clip(np.cumsum(np.bincount(grade, minlength=grades))[:-1] / len(grade), 0.01, 0.99)
    first = np.log(share / (1 - share))
    gaps[0], gaps[1:] = first[0], np.log(np.maximum(np.diff(first), 0.05))      # thresholds: gaps[0] + sums of exp(gaps)
    state = [np.zeros(SLOTS), np.zeros(SLOTS), np.zeros_like(gaps), np.zeros_like(gaps)]
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for t in range(1, steps + 1):
        cut = gaps[0] + np.concatenate(([0], np.cumsum(np.exp(gaps[1:]))))
        f = np.bincount(row, w[slot] * value, len(x))
        up = np.where(grade < grades - 1, sig(cut[np.minimum(grade, grades - 2)] - f), 1.0)
        down = np.where(grade > 0, sig(cut[np.maximum(grade - 1, 0)] - f), 0.0)
        p = np.maximum(up - down, 1e-9)
        du, dd = up * (1 - up) / p, down * (1 - down) / p
        gf = (du - dd) / len(x)                               # of the negative log likelihood by f
        gcut = np.bincount(np.minimum(grade, grades - 2), -du * (grade < grades - 1), grades - 1) + np.bincount(np.maximum(grade - 1, 0), dd * (grade > 0), grades - 1)
        ggap = np.cumsum(gcut[::-1])[::-1] / len(x)
        ggap[1:] *= np.exp(gaps[1:])
        gw = np.bincount(slot, gf[row] * value, SLOTS) + pull * w / len(x)
        for v, g, m, s, rate in ((w, gw, *state[:2], 0.3), (gaps, ggap, *state[2:], 0.05)):
            m *= 0.9
            m += 0.1 * g
            s *= 0.99
            s += 0.01 * g * g
            v -= rate * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-8)
    return w, gaps[0] + np.concatenate(([0], np.cumsum(np.exp(gaps[1:]))))


def quality_scores(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", threshold: float = 0.5) -> DataFrame:
    """``docs`` with held_out boolean, expected_grade double, tail_probability double and selected boolean.

    Fitted on at most FIT_ROWS labelled documents of folds 1 to 4 (by hash of the id); fold 0 (crc32 of the id mod 5,
    and null ids) is held out. tail_probability is that of the best grade; selected: it reaches ``threshold``.
    All words of a text count. A null or empty text has f = 0. Null labels don't count, of several the largest holds.
    With fewer than two grades every text gets the one grade (0 without labels). Repeated rows come back
    each, other columns are kept, under any name (those of the new names are replaced), an empty table gives an empty result."""
    spark = docs.sparkSession
    small_batches(spark)
    known = labels.select(F.col(doc_id).alias("_l"), F.col(label).cast("int").alias("_y")).where("_y is not null and _l is not null").groupBy("_l").agg(F.max("_y").alias("_y"))
    sample = known.where(fold(F.col("_l")) > 0).orderBy(F.xxhash64("_l"), "_l").limit(FIT_ROWS)
    rows = docs.select(F.col(doc_id).alias("_d"), F.col(text).cast("string").alias("t")).join(F.broadcast(sample), F.col("_d") == F.col("_l")).select("t", "_y")

    def features(batches):
        seen: dict = {}
        for b in batches:
            got = [text_features(t, seen) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([s.astype(np.int32).tobytes() for s, _ in got], pa.binary()), pa.array([v.astype(np.float32).tobytes() for _, v in got], pa.binary()), b.column(1)], ["s", "v", "y"])
    got = rows.mapInArrow(features, "s binary, v binary, y int").limit(2 * FIT_ROWS).toArrow()
    y = got["y"].to_numpy()
    levels = np.unique(y)
    if len(levels) > 1:
        x = [(np.frombuffer(s.as_buffer(), np.int32).astype(np.int64), np.frombuffer(v.as_buffer(), np.float32).astype(np.float64)) for s, v in zip(got["s"], got["v"])]
        w, cuts = fit(x, np.searchsorted(levels, y), len(levels))
    else:
        w, cuts = np.zeros(SLOTS), np.zeros(0)
        levels = levels if len(levels) else np.zeros(1, int)
    model = spark.sparkContext.broadcast((w.astype(np.float32), cuts, levels.astype(float)))
    whole = packed(docs, id=F.col(doc_id), text=F.col(text).cast("string"))

    def score(batches):
        seen: dict = {}
        w, cuts, levels = model.value
        for b in batches:
            f = np.zeros(b.num_rows)
            for i, t in enumerate(b.column(2).to_pylist()):
                s, v = text_features(t, seen)
                f[i] = float(w[s] @ v)
            below = 1 / (1 + np.exp(-np.clip(cuts[None, :] - f[:, None], -30, 30)))
            at = np.diff(np.concatenate([np.zeros((len(f), 1)), below, np.ones((len(f), 1))], 1), axis=1)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(at @ levels), pa.array(at[:, -1])], ["row", "id", "grade", "tail"])
    out = whole.mapInArrow(score, T.StructType([whole.schema["row"], whole.schema["id"], T.StructField("grade", T.DoubleType()), T.StructField("tail", T.DoubleType())]))
    return unpacked(out, docs.columns, expected_grade=F.col("grade"), tail_probability=F.col("tail"), held_out=fold(F.col("id")) == 0, selected=F.col("tail") >= threshold)
