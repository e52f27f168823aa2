"""Every registered query against its SQL twin (DuckDB) on sf0.001."""

import math

import duckdb
import pandas as pd
import pytest

from conftest import SF_SMALL

import __spark_entry__ as E

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, float):
        return round(v, 6) + 0.0
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(built, con, name):
    got = built(name).toPandas()
    exp = con.sql(E.oracle_sql()[name]).df()
    assert _rows(got) == _rows(exp)


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.oracle_sql())))
def test_rows_only_queries_run(built, name):
    assert built(name).count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["window_start", "window_end", "user_id"]
    assert df.count() > 0
