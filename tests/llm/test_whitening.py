import math

import numpy as np
import pytest
from pyspark.sql import types as T

from reviewguard.llm import whitening as W
from reviewguard.llm.queries import QUERIES

from .conftest import SF_SMALL


def brute(rows):
    """{(vec_id, component): (n, deviation, whitened, explained)} by Python integers and the library's eigenvectors."""
    rows = [(i, [math.floor(1024 * float(c)) + 100_000 for c in v]) for i, v in rows if v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v)]
    n, x = len(rows), np.array([v for _, v in rows])
    s = [sum(int(r[1][j]) for r in rows) for j in range(x.shape[1])]
    y = x - np.array(s) / n
    v = y.T @ y / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1], q[:, ::-1]
    dev = [sum((n * int(a) - b) ** 2 for a, b in zip(r[1], s)) for r in rows]
    return rows, n, dev, e, y @ q / np.sqrt(np.maximum(e, 1e-300)), e / np.trace(v)


def check(got, rows):
    rows, n, dev, e, w, share = brute(rows)
    k = max(r.component for r in got)
    assert len(got) == len(rows) * k
    by = {(r.vec_id, r.component): r for r in got}
    for c in range(1, k + 1):
        one = np.array([by[i, c].whitened for i, _ in rows])
        sign = np.sign(one @ w[:, c - 1])
        assert np.abs(one - sign * w[:, c - 1]).max() < 1e-8
        assert all(by[i, c].n == n and by[i, c].deviation == dev[j] and abs(by[i, c].explained / share[c - 1] - 1) < 1e-10 for j, (i, _) in enumerate(rows))
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-10


def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    check(QUERIES["op13_embedding_whitening"](spark, SF_SMALL).collect(), rows)


SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("vector", T.StringType()), T.StructField("n", T.IntegerType())])


def test_edge_rows(spark):
    r = np.random.default_rng(3)
    good = [(i, r.normal(size=5).tolist()) for i in range(40)]
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0, 3.0, 4.0]), (103, [math.nan] * 5), (104, [math.inf, 0.0, 0.0, 0.0, 0.0]), (105, [1.0, 2.0]), (106, [1e300] * 5)]
    got = W.whiten(spark.createDataFrame([(i, v, "x", 7) for i, v in good + bad], SCHEMA).repartition(4)).collect()
    check(got, good)
    assert {x.component for x in got} == {1, 2, 3, 4, 5}
    # repeated rows come back each, a null id stays
    twice = W.whiten(spark.createDataFrame([(i, v, "x", 7) for i, v in good + good[:3] + [(None, good[5][1])]], SCHEMA)).collect()
    assert len(twice) == 5 * 44 and sum(x.vec_id is None for x in twice) == 5 and twice[0].n == 44
    # no spread, one row, no rows
    for rows in ([(i, [1.0, 2.0], "x", 0) for i in range(5)], [(1, [3.0], "x", 0)], []):
        assert W.whiten(spark.createDataFrame(rows, SCHEMA)).collect() == []
    # two entries that move together: one component
    flat = [(i, [float(i), float(i), 3.0], "x", 0) for i in range(9)]
    assert {x.component for x in W.whiten(spark.createDataFrame(flat, SCHEMA)).collect()} == {1}


def test_deviation_beyond_a_long(spark):
    rows = [(i, [float(i) * 1e9, 1.0], "x", 0) for i in range(50)]
    got = {x.vec_id: x.deviation for x in W.whiten(spark.createDataFrame(rows, SCHEMA)).collect() if x.component == 1}
    xs = [math.floor(1024 * i * 1e9) for i in range(50)]
    exact = [(50 * x - sum(xs)) ** 2 for x in xs]
    assert all(got[i] == (v if v < 1 << 63 else None) for i, v in enumerate(exact)) and None in got.values()


@pytest.mark.parametrize("kind", ["random", "clusters", "close", "zeros", "ties"])
def test_divide_and_conquer(kind):
    r = np.random.default_rng(11)
    for d in (1, 2, 3, 17, 64):
        q, _ = np.linalg.qr(r.normal(size=(d, d)))
        e = {"random": r.exponential(size=d) * 1e4, "clusters": np.repeat([5.0, 3.0, 1e-3], d)[::3][:d] + 1e-9 * r.random(d), "close": 1 + 1e-6 * np.arange(d),
             "zeros": np.r_[np.zeros(d - d // 2), 1 + np.arange(d // 2)], "ties": np.ones(d)}[kind]
        a = (q * e) @ q.T
        a = (a + a.T) / 2
        values, axes = W.top_components(a, 8)
        want = np.linalg.eigvalsh(a)[::-1][:8]
        assert len(values) == min(8, d) and np.allclose(values, want, rtol=0, atol=1e-12 * max(abs(want).max(), 1))
        assert np.abs(axes.T @ axes - np.eye(len(values))).max() < 1e-12
        assert np.abs(a @ axes - axes * values).max() < 1e-11 * max(abs(want).max(), 1)
