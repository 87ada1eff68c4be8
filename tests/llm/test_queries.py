"""The check queries of the operators against DuckDB at the smallest scale."""

from __future__ import annotations

import pytest

from compare import connect, differences

import __spark_entry__ as entry
from watchtide.llm.oracle import ORACLE
from watchtide.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, oracle, name):
    assert differences(entry.queries()[name](spark, SF), oracle, ORACLE[name]) == ""


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) - set(ORACLE) == {"op2_quality_classifier", "op5_benchmark_decontamination", "op11_packing"}
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("name", ["op1_secret_scan", "op4_sharding", "op6_line_dedup", "op10_url_filter"])
def test_native_operators_run_no_python(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
