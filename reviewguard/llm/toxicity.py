"""Toxicity by class-conditional Kneser-Ney models over bytes.

Two models of order ``ORDER``, one of the toxic and one of the ordinary training texts,
predict every byte from the bytes before it. Each discounts its own counts and gives
the freed mass to one shared model (absolute-discount Kneser-Ney over both classes: pooled
counts at the top, continuation counts below, down to uniform), so an expression that is
rare in a class is judged by what both classes know. A text's feature is the
length-normalised difference of its two log-likelihoods; a logistic curve fitted
on training rows of another fold turns it into a score.

Counting, continuation counts and probabilities are Spark aggregates and joins over
all training texts. What goes to the tasks is a table of every counted n-gram (``ratio_table``), 12 to 20
bytes each; it grows with the distinct n-grams of the labelled texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import packed, saved, small_batches, text_chunks, unpacked

ORDER = 6                 # bytes of an n-gram; at most 7 fit a long beside the class
DISCOUNT = 0.75
STRENGTH = 30.0           # pseudo-counts of the shared model in each class
CALIBRATION_ROWS = 5_000  # bound of the labelled rows that fit the logistic curve
LABEL_BITS = 24           # size of the filter of labelled ids, as a power of 2
FOLDS = 5                 # fold 0 is held out, the last one calibrates, the others are counted
_MIX = np.uint64(0x9E3779B97F4A7C15)
EVIDENCE = 2.5            # nats by which a word's log ratio is shrunk: what chance gives to ordinary words


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 5; a null id is in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS, F.lit(0))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[9:14] = 32


def byte_grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The packed n-gram that ends at each byte. A-Z are lower-cased, control blanks are spaces; what
    stands before the word of the byte reads as blank, so rare expressions are predicted from their own beginning."""
    k, n = ORDER - 1, len(offsets) - 1
    padded = np.full(len(data) + k * n, 32, np.uint8)
    at = np.arange(len(data)) + np.repeat(k * np.arange(1, n + 1), np.diff(offsets))
    padded[at] = _LOWER[data]
    gram, inside = padded.astype(np.uint64), np.ones(len(padded), bool)
    for j in range(1, ORDER):
        before = np.full(len(padded), 32, np.uint8)
        before[j:] = padded[:-j]
        gram |= np.where(inside, before, np.uint8(32)).astype(np.uint64) << np.uint64(8 * j)
        inside &= before != 32
    return gram[at]


def _places(gram: np.ndarray, bits: int) -> np.ndarray:
    x = gram * _MIX
    x ^= x >> np.uint64(29)
    x *= _MIX
    return (x >> np.uint64(64 - bits)).astype(np.int64)


def packed_table(gram: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Arrays (first, grams, ratios): all n-grams in the order of their place, and where each place begins.

    There are at least as many places as n-grams, so a place holds one on average; those that share one stand side by side."""
    bits = max(1, len(gram).bit_length())
    place = _places(gram, bits)
    order = np.argsort(place, kind="stable")
    first = np.zeros((1 << bits) + 1, np.uint32 if len(gram) < 1 << 32 else np.int64)
    np.cumsum(np.bincount(place, minlength=1 << bits), out=first[1:])
    return first, gram[order], r[order].astype(np.float32)


def look_up(table: tuple[np.ndarray, np.ndarray, np.ndarray], gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each n-gram's log ratio, and whether it is in the table (else 0)."""
    first, held, ratios = table
    place = _places(gram, (len(first) - 1).bit_length() - 1)
    at, end = first[place].astype(np.int64), first[place + 1].astype(np.int64)
    out, known = np.zeros(len(gram), np.float32), np.zeros(len(gram), bool)
    left = np.nonzero(at < end)[0]
    while len(left):
        same = held[at[left]] == gram[left]
        hit = left[same]
        out[hit], known[hit] = ratios[at[hit]], True
        left = left[~same]
        at[left] += 1
        left = left[at[left] < end[left]]
    return out, known


def gram_counts(labelled: DataFrame) -> DataFrame:
    """(g, t, o): how often each n-gram stands in toxic and in ordinary texts of ``labelled`` (text, toxic)."""
    def count(batches):
        held, size = [], 0

        def merged():
            g, at = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
            return [(g, *(np.bincount(at, np.concatenate([h[i] for h in held]), len(g)).astype(np.int64) for i in (1, 2)))]
        for b in batches:
            toxic = b.column(1).to_numpy(zero_copy_only=False) == 1
            for lo, hi, data, offs in text_chunks(b.column(0), 1 << 20):
                g = byte_grams(data, offs)
                bad = np.repeat(toxic[lo:hi], np.diff(offs))
                u, at = np.unique(g, return_inverse=True)
                t = np.bincount(at, bad, len(u)).astype(np.int64)
                held.append((u, t, np.bincount(at, minlength=len(u)) - t))
                size += len(u)
            if size > 1_500_000:
                held = merged()
                size = len(held[0][0])
        if held:
            g, t, o = merged()[0]
            for i in range(0, len(g), 50_000):
                s = slice(i, i + 50_000)
                yield pa.RecordBatch.from_arrays([pa.array(g[s].view(np.int64)), pa.array(t[s]), pa.array(o[s])], ["g", "t", "o"])
    return labelled.select(F.col("text").cast("string"), F.col("toxic").cast("int")).mapInArrow(count, "g long, t long, o long").groupBy("g").agg(F.sum("t").alias("t"), F.sum("o").alias("o"))


def log_ratios(grams: DataFrame) -> DataFrame:
    """(g, r): log of toxic over ordinary probability of the n-gram's last byte after its first."""
    d = F.lit(DISCOUNT)

    def suffix(k):
        return F.col("g").bitwiseAND(F.lit((1 << 8 * k) - 1)).alias("s")

    def with_context(table, *sums):
        """What a context's followers add up to, beside each of its n-grams."""
        ctx = table.groupBy(F.shiftrightunsigned("g", 8).alias("h")).agg(*sums)
        return table.withColumn("h", F.shiftrightunsigned("g", 8)).join(ctx, "h")

    levels = {ORDER: grams.select("g", (F.col("t") + F.col("o")).alias("c"))}
    for k in range(ORDER - 1, 0, -1):
        levels[k] = saved(levels[k + 1].groupBy(suffix(k).alias("g")).agg(F.count("*").alias("c")), f"kn-{k}")
    shared = None
    for k in range(1, ORDER + 1):
        seen = with_context(levels[k], F.sum("c").alias("total"), F.count("*").alias("kinds"))
        if shared is None:
            seen = seen.withColumn("low", F.lit(1 / 256))
        else:
            seen = seen.withColumn("s", suffix(k - 1)).join(shared.select(F.col("g").alias("s"), F.col("p").alias("low")), "s")
        shared = seen.select("g", (F.greatest(F.col("c") - d, F.lit(0.0)) / F.col("total") + d * F.col("kinds") / F.col("total") * F.col("low")).alias("p"))

    sums = [f(c).alias(n) for c in ("t", "o") for f, n in ((F.sum, f"{c}_all"), (lambda c: F.sum((F.col(c) > 0).cast("long")), f"{c}_kinds"))]
    seen = with_context(grams, *sums).join(shared, "g")

    def own(c):
        return (F.greatest(F.col(c) - d, F.lit(0.0)) + (d * F.col(f"{c}_kinds") + STRENGTH) * F.col("p")) / (F.col(f"{c}_all") + STRENGTH)
    return seen.select("g", (F.log(own("t")) - F.log(own("o"))).alias("r"))


def ratio_table(ratios: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The packed table of every row of ``ratios`` (g, r); 12 bytes an n-gram come to the driver."""
    got = ratios.select("g", F.col("r").cast("float").alias("r")).toArrow()
    return packed_table(got["g"].to_numpy().view(np.uint64), got["r"].to_numpy())


def word_means(r: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean over each text's words of the word's summed log ratio, drawn EVIDENCE nearer to 0; no word: 0."""
    blank = _LOWER[data] == 32
    first = np.zeros(len(data) + 1, bool)
    first[offsets[:-1]] = True
    first = first[:-1]
    starts = ~blank & (np.concatenate(([True], blank[:-1])) | first)
    cuts = np.nonzero(starts | first)[0]
    total = np.add.reduceat(r, cuts)
    total = np.where(starts[cuts], np.sign(total) * np.maximum(np.abs(total) - EVIDENCE, 0), 0)
    doc = np.searchsorted(offsets, cuts, "right") - 1
    n = len(offsets) - 1
    return np.bincount(doc, total, n) / np.maximum(np.bincount(doc, starts[cuts], n), 1)


def mean_ratio(docs: DataFrame, model, text: str, into: str) -> DataFrame:
    """Add the length-normalised log ratio of the whole text (see ``word_means``)."""
    place = docs.columns.index(text)

    def score(batches):
        table = model.value
        for b in batches:
            out = np.zeros(b.num_rows)
            for lo, hi, data, offs in text_chunks(b.column(place), 1 << 20):
                if len(data):
                    r, _ = look_up(table, byte_grams(data, offs))
                    out[lo:hi] = word_means(r.astype(np.float64), data, offs)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out)], [*b.schema.names, into])
    return docs.mapInArrow(score, T.StructType([*docs.schema.fields, T.StructField(into, T.DoubleType())]))


def maybe_labelled(docs: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of ``docs`` (_d, text) whose id may be in ``known`` (_l), so that a join shuffles few other texts.

    A bit filter of 2**LABEL_BITS bits, of which at most 2**LABEL_BITS / 8 bytes come to the driver."""
    slot = F.xxhash64("_l").bitwiseAND(F.lit((1 << LABEL_BITS) - 1)) + 1
    flags = np.zeros(1 << LABEL_BITS - 3, np.uint8)
    for r in known.groupBy(F.bitmap_bucket_number(slot).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")).toLocalIterator():
        flags[(r.b - 1) * len(r.bits):r.b * len(r.bits)] = np.frombuffer(r.bits, np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(flags)

    def keep(batches):
        for b in batches:
            s = b.column(2).to_numpy(zero_copy_only=False) & ((1 << LABEL_BITS) - 1)
            yield b.filter(pa.array(shared.value[s >> 3] >> (s & 7).astype(np.uint8) & 1 > 0))
    return docs.withColumn("_h", F.xxhash64("_d")).mapInArrow(keep, T.StructType([*docs.schema.fields, T.StructField("_h", T.LongType())])).drop("_h")


def fit_logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept by Newton steps, with a weak pull towards a threshold of 0.05 and a slope of 100."""
    w, start = np.array([1.0, -5.0]), np.array([1.0, -5.0])
    a = np.stack([100 * x, np.ones_like(x)], 1)
    pull = 0.05

    def loss(v):
        z = a @ v
        return np.sum(np.logaddexp(0, z) - y * z) + pull * np.sum((v - start) ** 2) / 2
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (p - y) + pull * (w - start)
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + pull * np.eye(2), grad)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    # evidence never speaks for a clean text, and a text without any is clean
    w = np.array([max(w[0], 0.05), min(w[1], -0.1)])
    return float(100 * w[0]), float(w[1])


def toxicity_scores(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """``docs`` with held_out boolean, score double in 0..1 and predicted int.

    Training rows are labelled documents of folds 1 to 4 (crc32 of the id mod 5): folds 1 to 3 are
    counted, all of them; at most CALIBRATION_ROWS of fold 4 fit the curve. Held-out labels are never read, nor
    any column but the text. Null and empty texts score as a text of ratio 0. A null doc_id is
    held out. Of several labels of an id the largest holds, null labels don't count. Without labelled rows
    every text gets the start curve. Repeated rows come back each; the other columns are kept
    (a column named held_out, score or predicted is replaced)."""
    spark = docs.sparkSession
    small_batches(spark)
    known = labels.select(F.col(doc_id).alias("_l"), F.col(label).cast("int").alias("toxic")).where("toxic is not null and _l is not null")
    known = known.where(fold(F.col("_l")) > 0).groupBy("_l").agg(F.max("toxic").alias("toxic"))
    base = docs.select(F.col(doc_id).alias("_d"), F.col(text).cast("string").alias("text"))
    train = base.where((fold(F.col("_d")) > 0) & (fold(F.col("_d")) < FOLDS - 1)).withColumn("_d", F.col("_d").cast("string"))
    known = known.withColumn("_l", F.col("_l").cast("string"))
    base = base.withColumn("_d", F.col("_d").cast("string"))
    wanted = known.where(fold(F.col("_l")) < FOLDS - 1)
    counted = maybe_labelled(train, wanted).join(wanted, F.col("_d") == F.col("_l"))
    grams = saved(gram_counts(counted.select("text", "toxic")), "kn-counts")
    model = spark.sparkContext.broadcast(ratio_table(log_ratios(grams)))
    sample = known.where(fold(F.col("_l")) == FOLDS - 1).orderBy(F.xxhash64("_l"), "_l").limit(CALIBRATION_ROWS)
    fit = base.where(fold(F.col("_d")) == FOLDS - 1).join(F.broadcast(sample), F.col("_d") == F.col("_l")).select("text", "toxic")
    got = mean_ratio(fit, model, "text", "x").select("x", "toxic").limit(2 * CALIBRATION_ROWS).toPandas()
    slope, shift = fit_logistic(got.x.to_numpy(float), (got.toxic == 1).to_numpy(float)) if len(got) else (100.0, -5.0)
    out = mean_ratio(packed(docs, id=F.col(doc_id), text=F.col(text).cast("string")), model, "text", "x")
    out = out.withColumn("score", 1 / (1 + F.exp(-(F.lit(slope) * F.col("x") + F.lit(shift)))))
    return unpacked(out, docs.columns, held_out=fold(F.col("id")) == 0, score=F.col("score"), predicted=(F.col("score") >= 0.5).cast("int"))


def reject_toxic(docs: DataFrame, labels: DataFrame, **columns) -> DataFrame:
    """The documents that aren't predicted toxic, columns as they are."""
    scored = toxicity_scores(packed(docs, doc_id=F.col(columns.pop("doc_id", "doc_id")), text=F.col(columns.pop("text", "text"))), labels, **columns)
    return unpacked(scored.where("predicted = 0"), docs.columns)
