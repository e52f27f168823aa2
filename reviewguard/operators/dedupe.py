"""Keep one row per key by an ordering, as an aggregate.

``max_by`` over a struct of the other columns is partially aggregated in
every task before the shuffle, so a key with a huge number of copies (a
replayed batch, a duplicated review) never has its copies gathered in one
task, which a ``row_number()`` window partitioned by the key would do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_max(df: DataFrame, key: list[str], order: list[Column | str]) -> DataFrame:
    """The row with the greatest ``order`` (compared left to right) per key."""
    others = [c for c in df.columns if c not in key]
    ordering = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    g = df.groupBy(*key).agg(F.max_by(F.struct(*others), ordering).alias("_r"))
    return g.select(*key, *[F.col(f"_r.{c}").alias(c) for c in others]).select(*df.columns)
