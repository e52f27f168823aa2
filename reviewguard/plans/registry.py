"""Registry of contract queries: each Spark plan sits next to its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}
CHECK: dict[str, str] = {}   # "O" oracle-checked, "R" rows-only (+ own tests)


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is the DuckDB twin (None -> rows-only)."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        CHECK[name] = "O" if sql else "R"
        if sql:
            ORACLE[name] = sql
        return fn

    return deco


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body
