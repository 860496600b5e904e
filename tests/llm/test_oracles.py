"""Registered queries against their reference SQL over whole tables, and the registration itself."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from parity import connect, difference  # noqa: E402

from salescube.llm.catalog import ORACLES, QUERIES  # noqa: E402

PATH = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", list(ORACLES))
def test_equals_sql(spark, name):
    assert difference(spark, connect(PATH), PATH, QUERIES[name], ORACLES[name]) is None


def test_one_query_per_operator():
    import __spark_entry__ as contract

    assert set(contract.queries()) >= {*QUERIES, "pipeline"} and set(contract.oracle_sql()) >= set(ORACLES)
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES if q.startswith("op")) == list(range(1, 14))
    assert set(ORACLES) < set(QUERIES)


@pytest.mark.parametrize("name", ["op5_secret_scan", "op8_quality_rules"])
def test_native_queries_run_no_python(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
