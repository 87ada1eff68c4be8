"""Every check query against DuckDB at the smallest scale."""

from __future__ import annotations

import pytest

from compare import connect, differences

import __spark_entry__ as entry
from driver_checks.registry import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, oracle, name):
    df = entry.queries()[name](spark, SF)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert differences(df, oracle, entry.oracle_sql()[name]) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) - set(ORACLE) == set()
