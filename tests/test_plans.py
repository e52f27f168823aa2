"""Plan guards over every registered query: no cartesian product, no
nested-loop join, no row-at-a-time Python UDF."""

import pytest

import __spark_entry__ as E

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_plan_has_no_cross_join_or_row_udf(built, name):
    df = built(name)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [k for k in FORBIDDEN if k in plan]
