"""Structural guards over every registered query's physical plan: no cross
joins or nested-loop joins, and no Python evaluation (everything stays in
the JVM's generated code)."""

from __future__ import annotations

import pytest

from conftest import SF_SMALL
from strata.plans.registry import QUERIES

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
             "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_joins_or_python(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    found = [op for op in FORBIDDEN if op in plan]
    assert not found, f"{name}: {found}"
