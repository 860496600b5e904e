"""The plans are the ones meant for large data."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F

from salescube.catalog.elasticity_queries import QUERIES as ELASTICITY
from salescube.catalog.report_queries import QUERIES as REPORT
from salescube.catalog.rollup_queries import QUERIES as ROLLUP
from salescube.catalog.rollup_queries import build_rollup
from salescube.catalog.star import fine_star

SF_DIR = "/root/testdata/sf0.001"
QUERIES = {**ROLLUP, **ELASTICITY, **REPORT}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason=f"no test tables at {SF_DIR}")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["rollup_grouping_sets", "ped_summary", "price_points_sql", "change_formatted", "databook_table", "report_numbering", "report_pivot", "sales_report"])
def test_no_python_in_the_plan(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert not re.search(r"Python|Pandas|Arrow", text)
    assert "CartesianProduct" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("name", ["rollup_grouping_sets", "price_points_sql", "ped_summary", "databook_table"])
def test_sales_are_scanned_once(spark, name):
    assert len(re.findall(r"FileScan parquet \[l_", plan(QUERIES[name](spark, SF_DIR)))) == 1


def test_rollup_folds_before_it_joins_and_expands(spark):
    text = plan(build_rollup(fine_star(spark, SF_DIR)))
    operators = re.findall(r"(Expand|BroadcastHashJoin|SortMergeJoin|Scan parquet|FileScan parquet|HashAggregate|Exchange)", text)
    fact_branch = operators[: operators.index("FileScan parquet") + 1]
    # read bottom-up: scan, fold (two aggregates around one exchange), joins, expand, distinct stores, groups
    assert fact_branch[::-1] == [
        "FileScan parquet", "HashAggregate", "Exchange", "HashAggregate",
        "BroadcastHashJoin", "BroadcastHashJoin", "Expand",
        "HashAggregate", "Exchange", "HashAggregate", "HashAggregate", "Exchange", "HashAggregate",
    ]


@pytest.mark.parametrize("name", ["store_week_prices", "price_points_sql"])
def test_study_folds_before_it_joins_the_dimensions(spark, name):
    operators = re.findall(r"(BroadcastHashJoin|SortMergeJoin|FileScan parquet|HashAggregate|Exchange)", plan(QUERIES[name](spark, SF_DIR)))
    branch = operators[: operators.index("FileScan parquet") + 1][::-1]
    # two joins give the test tables' sales their codes; then the fold around one exchange, then products and stores
    assert branch[:8] == ["FileScan parquet", "BroadcastHashJoin", "BroadcastHashJoin", "HashAggregate", "Exchange", "HashAggregate", "BroadcastHashJoin", "BroadcastHashJoin"]


def test_numbering_has_few_exchanges(spark):
    assert len(re.findall(r"\bExchange\b", plan(QUERIES["report_numbering"](spark, SF_DIR)))) <= 8


def test_rollup_reads_only_the_columns_it_needs(spark):
    text = plan(build_rollup(fine_star(spark, SF_DIR)))
    scanned = {re.sub(r"#.*", "", c) for c in re.search(r"FileScan parquet \[(l_[^\]]*)\]", text).group(1).split(",")}
    assert scanned == {"l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate"}


def test_large_dimensions_are_not_broadcast(spark, monkeypatch):
    from salescube.functions import sizing

    star = fine_star(spark, SF_DIR)
    want = sorted(map(str, build_rollup(star).collect()))
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", 0)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = build_rollup(star)
        assert "SortMergeJoin" in plan(shuffled)
        assert sorted(map(str, shuffled.collect())) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_month_and_network_filters_reach_the_scan(spark, tmp_path):
    from salescube.schemas import RETAIL_SALES
    from salescube.sources.snapshot import read_snapshot, write_snapshot

    star = fine_star(spark, SF_DIR)
    write_snapshot(star.full_fact.withColumn("sales_rub", F.col("sales_rub").cast("double")), str(tmp_path / "f"))
    star.fact = read_snapshot(spark, str(tmp_path / "f"), RETAIL_SALES)
    from datetime import date

    text = plan(build_rollup(star, months=(date(1998, 1, 1), date(1998, 3, 1)), chains=["ASIA"]))
    assert re.search(r"PartitionFilters: \[isnotnull\(month_year[^\]]*1998-01-01", text)
    assert "EqualTo(network_name,ASIA)" in text
    assert "week_start_date" not in text
