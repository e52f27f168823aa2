"""Embedding whitening: components of the covariance by QDWH spectral divide-and-conquer.

Spark makes exact integer sums and the covariance in two passes; the driver
splits that matrix (its size is the square of the dimension, whatever the
number of rows) by polar decompositions; tasks project their rows on the
broadcast components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved
from .treesum import SLICES, slices, tree_sum

SCALE, OFFSET = 1024.0, 100_000
#: Entries from here on don't fit the integers and count as non-finite.
LARGEST = 2.0 ** 52
EPS = np.finfo(float).eps

OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


# ---- spectral divide-and-conquer ----
def polar(a: np.ndarray) -> np.ndarray:
    """Orthogonal factor of a symmetric matrix by QDWH: dynamically weighted Halley steps, each one QR of [sqrt(c)X; I].

    For a symmetric matrix this is its sign: +1 on eigenvectors above 0, -1 below."""
    d = len(a)
    x = a / max(np.sqrt(np.linalg.norm(a, 1) * np.linalg.norm(a, np.inf)), np.finfo(float).tiny)
    low, eye = EPS, np.eye(d)
    for _ in range(12):
        r = np.cbrt(4 * (1 - low ** 2) / low ** 4)
        h = np.sqrt(1 + r) + 0.5 * np.sqrt(8 - 4 * r + 8 * (2 - low ** 2) / (low ** 2 * np.sqrt(1 + r)))
        b = (h - 1) ** 2 / 4
        c = h + b - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, eye]))
        new = (b / c) * x + (h - b / c) / np.sqrt(c) * (q[:d] @ q[d:].T)
        new = (new + new.T) / 2
        low = min(1.0, low * (h + b * low ** 2) / (1 + c * low ** 2))
        moved, x = np.linalg.norm(new - x), new
        if low > 1 - 10 * EPS and moved < np.cbrt(EPS):
            break
    return x


def split(a: np.ndarray, scale: float):
    """(basis above, basis below) of two invariant subspaces, or None where the matrix is a multiple of the identity to double precision."""
    d = len(a)
    if np.linalg.norm(a - np.trace(a) / d * np.eye(d)) <= d * EPS * scale:
        return None
    draw, diagonal, best = np.random.default_rng(d), np.sort(np.diag(a)), None
    shifts = [np.median(diagonal), np.trace(a) / d]
    for turn in range(24):
        if turn >= len(shifts):                      # quotients of random directions lie between the extreme eigenvalues
            v = draw.standard_normal(d)
            shifts.append(v @ a @ v / (v @ v))
        p = (polar(a - shifts[turn] * np.eye(d)) + np.eye(d)) / 2
        k = round(np.trace(p))
        if not 0 < k < d:
            continue
        q, _ = np.linalg.qr(p @ draw.standard_normal((d, k)))
        q, _ = np.linalg.qr(p @ q, mode="complete")
        left = np.linalg.norm(q[:, k:].T @ a @ q[:, :k])
        if best is None or left < best[0]:
            best = left, q[:, :k], q[:, k:]
        if left <= 8 * d * EPS * scale:
            break
    return best and best[1:]


def top_components(v: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest ``count`` eigenvalues, falling, and their unit eigenvectors as columns.

    Projectors (U + I) / 2 of shifted matrices split the space again and again;
    only halves that hold wanted components are split further."""
    scale = max(np.linalg.norm(v), np.finfo(float).tiny)
    values, columns = [], []

    def go(basis: np.ndarray, want: int) -> None:
        a = basis.T @ v @ basis
        a = (a + a.T) / 2
        halves = split(a, scale) if len(a) > 1 else None
        if halves is None:
            for i in range(min(want, len(a))):
                values.append(a[i, i])
                columns.append(basis[:, i])
            return
        for half in halves:
            if want > 0:
                go(basis @ half, want)
                want -= half.shape[1]

    go(np.eye(len(v)), count)
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order], np.array(columns).T[:, order]


# ---- rows ----
def _integers(batch: pa.RecordBatch, size: int | None = None):
    """Yields (row numbers, x as int64 matrix) per vector length of a batch (ids, vectors); rows without a whole finite vector are left out."""
    column = batch.column(1)
    flat, offs = column.values, np.asarray(column.offsets).astype(np.int64)
    whole = np.asarray(flat.is_valid())
    with np.errstate(all="ignore"):
        c = np.asarray(flat.fill_null(0)).astype(np.float64) * SCALE
        whole &= np.abs(c) < LARGEST
        x = np.where(whole, np.floor(c), 0).astype(np.int64) + OFFSET
    length = np.diff(offs)
    bad = np.concatenate([[0], np.cumsum(~whole)])
    good = np.asarray(column.is_valid()) & (length > 0) & (bad[offs[1:]] == bad[offs[:-1]])
    for k in np.unique(length[good]):
        if size is None or k == size:
            rows = np.flatnonzero(good & (length == k))
            yield rows, x[offs[rows][:, None] + np.arange(k)]


def _sums(batches):
    total: dict = {}
    for b in batches:
        for rows, x in _integers(b):
            k = x.shape[1]
            n, s = total.get(k, (0, np.zeros(k, object)))
            total[k] = n + len(rows), s + np.array([x[i:i + 512].sum(0) for i in range(0, len(x), 512)]).astype(object).sum(0)
    for k, (n, s) in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([k] * k, pa.int32()), pa.array(range(k), pa.int32()), pa.array([n] * k, pa.int64()), pa.array([str(v) for v in s])],
                                         ["size", "dim", "n", "s"])


class Frame:
    """What tasks need: the fit list's size, sums and integer means; later the components."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.size = n, len(sums)
        whole = [(2 * s + n) // (2 * n) for s in sums]
        self.mean, self.rest = np.array(whole, np.int64), np.array([s - n * m for s, m in zip(sums, whole)], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) - self.rest / self.n

    def deviation(self, x: np.ndarray) -> list:
        """Sum of (n*x - S)^2 per row, exact; null where it exceeds a long."""
        y = x - self.mean
        near = ((y.astype(float) * self.n - self.rest) ** 2).sum(1)
        with np.errstate(all="ignore"):
            exact = ((y * np.int64(self.n) - self.rest) ** 2).sum(1)      # modulo 2^64
        out = exact.tolist()
        for i in np.flatnonzero(near > 2.0 ** 62):
            v = sum((self.n * int(a) - int(r)) ** 2 for a, r in zip(y[i], self.rest))
            out[i] = v if v < 1 << 63 else None
        return out


def whiten(table: DataFrame, components: int = 8, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    x = floor(1024 * c) + 100000 per entry c; ``whitened`` is x - mean, projected on a unit eigenvector of x's
    covariance and divided by the root of its eigenvalue. Vectors that are null, empty, or hold null or non-finite entries
    (entries beyond 4e12 count as such) are dropped, and so are those of another length than the most
    common one (of equally common lengths the larger stays). Repeated rows count and come back each; null ids stay.
    Fewer components come back where fewer eigenvalues exceed rounding (equal vectors: none; an empty table: no
    rows). Ties between eigenvalues give any orthonormal basis, the same for all rows. Other columns are not returned
    and may have any name. ``deviation`` is null where it exceeds a long."""
    spark = table.sparkSession
    rows = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    sums = saved(rows.mapInArrow(_sums, "size int, dim int, n long, s string").groupBy("size", "dim").agg(
        F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")), "sums")
    most = sums.where("dim = 0").orderBy(F.desc("n"), F.desc("size")).first()
    if most is None:
        return spark.createDataFrame([], OUT)
    frame = Frame(most.n, [int(r.s) for r in sums.where(F.col("size") == most["size"]).orderBy("dim").collect()])
    shared = spark.sparkContext.broadcast(frame)

    def grams(batches):
        f, total = shared.value, 0
        for b in batches:
            for _, x in _integers(b, f.size):
                for i in range(0, len(x), 4096):
                    y = (x[i:i + 4096] - f.mean).astype(float)      # integers: the products' sums are exact below 2^53
                    total = total + y.T @ y
        if not isinstance(total, int):
            yield slices(TaskContext.get().partitionId(), total.ravel())

    gram = tree_sum(rows.mapInArrow(grams, SLICES), float).reshape(frame.size, frame.size)
    rest = frame.rest / frame.n
    covariance = gram / frame.n - np.outer(rest, rest)
    values, axes = top_components(covariance, components)
    real = values > frame.size * EPS * max(values[0], 0)
    if not real.any():
        return spark.createDataFrame([], OUT)
    values, axes = values[real], axes[:, real]
    frame.axes, frame.explained = axes / np.sqrt(values), values / np.trace(covariance)
    shared = spark.sparkContext.broadcast(frame)
    k = len(values)

    def products(batches):
        f, total = shared.value, 0
        for b in batches:
            for _, x in _integers(b, f.size):
                w = f.centred(x) @ f.axes
                total = total + np.concatenate([w.sum(0), (w.T @ w).ravel()])
        if not isinstance(total, int):
            yield slices(TaskContext.get().partitionId(), total)

    got = tree_sum(rows.mapInArrow(products, SLICES), float) / frame.n
    error = float(np.abs(got[k:].reshape(k, k) - np.outer(got[:k], got[:k]) - np.eye(k)).max())

    def project(batches):
        f = shared.value
        for b in batches:
            for at, x in _integers(b, f.size):
                for i in range(0, len(x), 1024):
                    part, pick = x[i:i + 1024], np.repeat(at[i:i + 1024], k)
                    m = len(part)
                    yield pa.RecordBatch.from_arrays([
                        b.column(0).take(pa.array(pick)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, f.n)),
                        pa.array(f.deviation(part), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))), pa.array((f.centred(part) @ f.axes).ravel()),
                        pa.array(np.tile(f.explained, m)), pa.array(np.full(m * k, error))],
                        ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return rows.mapInArrow(project, OUT)
