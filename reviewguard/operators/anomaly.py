"""Isolation forest on Spark.

MLlib has no isolation forest, so it is built from DataFrame pieces:

* sampling: row r goes to tree t when a seeded hash of (key, t) falls under
  a threshold sized for about 2 * max_samples rows per tree (row count from
  a scalar subquery); each tree keeps its max_samples smallest hashes -- a
  sample without replacement, per tree, bounded by max_samples;
* growing: ``groupBy(tree).applyInPandas`` -- one small group per tree;
* the model is the node table, at most n_trees * (2 * max_samples - 1) rows
  whatever the data size, so it is the one thing collected and broadcast;
* scoring: a pandas UDF over the features alone, vectorised over Arrow batches;
* offset: the ``contamination`` quantile of the scores by
  ``percentile_approx`` (a fixed-size sketch; exact on small tables).

It follows the published algorithm (random feature, uniform split between
the node's min and max, height limit ceil(log2(max_samples)), path length
plus c(size) at leaves) and cannot match another implementation's random
draws bit for bit.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from ..session import checkpoint

# The 12 model features, in this order.
FEATURES = [
    "low_rating_reviews_by_user_5m", "distinct_products", "num_products_in_window", "num_windows",
    "num_suspicious_windows", "num_total_targeted_products", "num_suspicious_products_targeted",
    "max_products_in_one_window", "avg_products_per_window", "has_multiple_suspicious_windows",
    "num_other_users_shared_products", "max_common_products_with_any_user",
]
N_TREES = 100
MAX_SAMPLES = 256
SEED = 42

NODE_SCHEMA = StructType([
    StructField("tree", IntegerType()), StructField("node", IntegerType()), StructField("feature", IntegerType()),
    StructField("threshold", DoubleType()), StructField("left", IntegerType()), StructField("right", IntegerType()),
    StructField("size", LongType()), StructField("depth", IntegerType()),
])


def c_factor(n: float) -> float:
    """Average path length of an unsuccessful search in a BST of n nodes."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + 0.5772156649015329) - 2.0 * (n - 1.0) / n


def contamination(df: DataFrame, label: str = "source_spam_label", lo: float = 0.05, hi: float = 0.20) -> float:
    """Label mean clipped to [lo, hi]. One number: percentile_approx needs
    its percentage as a constant, so this is the single scalar fetched."""
    v = df.select(F.avg(F.col(label).cast("double"))).first()[0]
    return float(max(lo, min(hi, v if v is not None else lo)))


def sample_for_trees(df: DataFrame, key: list[str], features: list[str] = FEATURES, n_trees: int = N_TREES,
                     max_samples: int = MAX_SAMPLES, seed: int = SEED) -> DataFrame:
    """tree, x0..x{k-1}: at most max_samples rows per tree."""
    n = df.select(F.count(F.lit(1)).cast("double")).scalar()
    # keep-probability ~ 2 * psi / n (all rows when n is small); threshold on
    # a hash in [0, 1e6)
    thr = F.least(F.lit(1_000_000.0), F.lit(2.0 * max_samples * 1_000_000.0) / F.greatest(n, F.lit(1.0)))
    k = F.xxhash64(*[F.col(c).cast("string") for c in key])
    x = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"x{i}") for i, c in enumerate(features)]
    base = df.select(k.alias("_k"), *x).withColumn("_thr", thr)
    cand = base.select("*", F.explode(F.filter(
        F.sequence(F.lit(0), F.lit(n_trees - 1)),
        lambda t: F.pmod(F.xxhash64(F.col("_k"), t, F.lit(seed)), F.lit(1_000_000)) < F.col("_thr"))).alias("tree"))
    cand = cand.withColumn("_h", F.xxhash64(F.col("_k"), F.col("tree"), F.lit(seed + 1)))
    w = Window.partitionBy("tree").orderBy("_h", "_k")
    return (cand.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= max_samples)
            .select("tree", *[f"x{i}" for i in range(len(features))]))


def _grow(n_features: int, max_samples: int, seed: int):
    height_limit = int(math.ceil(math.log2(max(max_samples, 2))))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        rng = np.random.default_rng(seed * 1000003 + tree)
        X = pdf[[f"x{i}" for i in range(n_features)]].to_numpy(dtype=float)
        rows = []
        stack = [(0, np.arange(len(X)), 0)]
        next_id = 1
        while stack:
            node, idx, depth = stack.pop()
            sub = X[idx]
            if depth >= height_limit or len(idx) <= 1:
                rows.append((tree, node, -1, 0.0, -1, -1, len(idx), depth))
                continue
            spread = sub.max(axis=0) - sub.min(axis=0)
            usable = np.flatnonzero(spread > 0)
            if usable.size == 0:
                rows.append((tree, node, -1, 0.0, -1, -1, len(idx), depth))
                continue
            f = int(rng.choice(usable))
            lo, hi = sub[:, f].min(), sub[:, f].max()
            thr = float(rng.uniform(lo, hi))
            go_left = sub[:, f] < thr
            left, right = next_id, next_id + 1
            next_id += 2
            rows.append((tree, node, f, thr, left, right, len(idx), depth))
            stack.append((left, idx[go_left], depth + 1))
            stack.append((right, idx[~go_left], depth + 1))
        return pd.DataFrame(rows, columns=[f.name for f in NODE_SCHEMA.fields])

    return grow


def fit(df: DataFrame, key: list[str], features: list[str] = FEATURES, n_trees: int = N_TREES,
        max_samples: int = MAX_SAMPLES, seed: int = SEED) -> DataFrame:
    """Node table of the forest (a DataFrame; bounded by the parameters)."""
    s = sample_for_trees(df, key, features, n_trees, max_samples, seed)
    return s.groupBy("tree").applyInPandas(_grow(len(features), max_samples, seed), NODE_SCHEMA)


def _model_arrays(nodes: pd.DataFrame):
    trees = sorted(nodes["tree"].unique())
    out = []
    for t in trees:
        nd = nodes[nodes["tree"] == t].sort_values("node")
        m = int(nd["node"].max()) + 1
        feat = np.full(m, -1, dtype=np.int64)
        thr = np.zeros(m)
        left = np.full(m, -1, dtype=np.int64)
        right = np.full(m, -1, dtype=np.int64)
        leaf_val = np.zeros(m)
        ids = nd["node"].to_numpy()
        feat[ids] = nd["feature"].to_numpy()
        thr[ids] = nd["threshold"].to_numpy()
        left[ids] = nd["left"].to_numpy()
        right[ids] = nd["right"].to_numpy()
        leaf_val[ids] = nd["depth"].to_numpy() + np.array([c_factor(s) for s in nd["size"].to_numpy()])
        out.append((feat, thr, left, right, leaf_val))
    return out


def score(df: DataFrame, nodes: DataFrame, features: list[str] = FEATURES, max_samples: int | None = None,
          contamination_value: float | None = None, label: str = "source_spam_label",
          accuracy: int = 100_000) -> DataFrame:
    """Adds ``anomaly_score`` (decision function: negative = anomalous) and
    ``predicted_suspicious`` (1 when the score is below 0)."""
    pdf_nodes = nodes.toPandas()  # the model: at most n_trees * (2 * max_samples - 1) rows
    psi = max_samples or int(pdf_nodes[pdf_nodes["node"] == 0]["size"].max())
    bmodel = df.sparkSession.sparkContext.broadcast(_model_arrays(pdf_nodes))
    cpsi = c_factor(psi)
    @F.pandas_udf("double")
    def raw_score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        model = bmodel.value
        for b in batches:
            X = np.column_stack([c.to_numpy(dtype=float) for c in b])
            total = np.zeros(len(X))
            for feat, thr, left, right, leaf_val in model:
                node = np.zeros(len(X), dtype=np.int64)
                active = feat[node] >= 0
                while active.any():
                    f = feat[node[active]]
                    v = X[np.flatnonzero(active), f]
                    go_left = v < thr[node[active]]
                    node[active] = np.where(go_left, left[node[active]], right[node[active]])
                    active = feat[node] >= 0
                total += leaf_val[node]
            h = total / len(model)
            yield pd.Series(-np.power(2.0, -h / cpsi) if cpsi > 0 else -np.ones(len(X)))

    # only the features go through Arrow; the scores are written once: the
    # offset's quantile and the final projection both read them
    x = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features]
    raw = checkpoint(df.withColumn("_raw", raw_score(*x)))
    cont = contamination_value if contamination_value is not None else contamination(df, label)
    offset = raw.select(F.percentile_approx("_raw", cont, accuracy)).scalar()
    out = raw.withColumn("_off", offset)
    out = out.withColumn("anomaly_score", F.col("_raw") - F.col("_off")).drop("_raw", "_off")
    return out.withColumn("predicted_suspicious", (F.col("anomaly_score") < 0).cast("int"))


def top(df: DataFrame, n: int = 20, tie: list[str] | None = None) -> DataFrame:
    """Most anomalous rows first."""
    tie = tie or ["user_id", "window_start"]
    return df.orderBy(F.col("anomaly_score").asc(), *tie).limit(n)
