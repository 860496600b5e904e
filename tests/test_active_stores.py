"""Stored sets of stores against counts over the sales."""

from __future__ import annotations

import random
from datetime import date

import pytest
from pyspark.sql import functions as F
from test_rollup import FACT, star  # noqa: F401

from salescube.plans import active_stores, rollup
from salescube.schemas import ROW_KEYS, SKU, TOTAL

MONTHS = [date(2023, 11, 1), date(2023, 12, 1), date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1)]


@pytest.fixture(scope="module")
def shops(spark):
    """300 stores of two networks, five months, two products."""
    rng = random.Random(3)
    stores = [(f"p{i:03}", "N" if i % 3 else "M", "retail") for i in range(300)]
    sales = [
        (m, m, net, "S", f"s{rng.randrange(1, 3)}", code, 1, 1.0)
        for m in MONTHS for code, net, _ in stores if rng.random() < 0.4 for _ in range(rng.randrange(1, 3))
    ]
    stores = spark.createDataFrame(stores, "global_pos_code string, network_name string, store_format string")
    networks = stores.select("global_pos_code", F.col("network_name").alias("network_subname_alt"))
    return spark.createDataFrame(sales, FACT), stores, networks


def test_numbers_have_no_gaps_and_stay(shops):
    stores = shops[1]
    numbers = active_stores.store_numbers(stores)
    rows = numbers.collect()
    assert sorted(r.store_no for r in rows) == list(range(300))
    by_network = [r.network_name for r in numbers.join(stores, "global_pos_code").orderBy("store_no").collect()]
    assert by_network == sorted(by_network)
    some = active_stores.store_numbers(stores.where("global_pos_code < 'p100'"))
    grown = active_stores.store_numbers(stores, some)
    old = {r.global_pos_code: r.store_no for r in some.collect()}
    all_of_them = {r.global_pos_code: r.store_no for r in grown.collect()}
    assert {k: all_of_them[k] for k in old} == old and sorted(all_of_them.values()) == list(range(300))
    assert active_stores.store_numbers(stores, grown).count() == 300


def test_counts_of_any_period_and_level(spark, star, shops):  # noqa: F811
    fact, stores, networks = shops
    skus = star[1]
    dims = (skus, stores, networks)
    words = active_stores.store_words(fact, *dims, active_stores.store_numbers(stores)).cache()
    monthly = active_stores.counts(words, F.col("report_date"))
    keys = ["network_name", "network_subname", *ROW_KEYS, "level", "akb"]
    plain = rollup.build(fact, *dims)
    assert sorted(map(str, monthly.select("period", *keys).collect())) == sorted(map(str, plain.select(F.col("report_date").alias("period"), *keys).collect()))
    by_quarter = active_stores.counts(words.where(F.col("level") == TOTAL), active_stores.quarter(F.col("report_date")), ["network_name"])
    joined = fact.select("network_name", "global_pos_code", F.trunc("month_year", "quarter").alias("period"))
    want = joined.groupBy("period", "network_name").agg(F.count_distinct("global_pos_code").alias("akb"))
    assert sorted(map(tuple, by_quarter.collect())) == sorted(map(tuple, want.collect()))
    everything = active_stores.counts(words.where(F.col("level") == SKU), F.lit("ever"), [])
    assert [r.akb for r in everything.collect()] == [fact.select("global_pos_code").distinct().count()]
    trailing = {(r.period, r.network_name): r.akb for r in active_stores.trailing(words.where(F.col("level") == TOTAL), 3, ["network_name"]).collect()}
    for i, month in enumerate(MONTHS):
        for network in ("M", "N"):
            near = fact.where(F.col("month_year").isin(MONTHS[max(0, i - 2):i + 1]) & (F.col("network_name") == network))
            assert trailing[month, network] == near.select("global_pos_code").distinct().count()
    assert len(trailing) == 2 * len(MONTHS)


def test_sets_are_united_before_the_shuffle(star, shops):  # noqa: F811
    words = active_stores.store_words(shops[0], star[1], *shops[1:], active_stores.store_numbers(shops[1]))
    plan = active_stores.counts(words.where("level = 0"), F.trunc("report_date", "year"), ["network_name"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_bit_or" in plan and "Python" not in plan and "SortAggregate" not in plan


def test_one_slice_is_replaced(spark, star, shops, tmp_path):  # noqa: F811
    fact, stores, networks = shops
    dims = (star[1], stores, networks)
    numbers = active_stores.store_numbers(stores).cache()
    path = str(tmp_path / "sets")
    active_stores.store(active_stores.store_words(fact, *dims, numbers), path)
    fewer = fact.where(~((F.col("month_year") == MONTHS[4]) & (F.col("global_pos_code") > "p150")))
    march = {(MONTHS[4], "N"), (MONTHS[4], "M")}
    active_stores.store(active_stores.store_words(fewer, *dims, numbers, months=(MONTHS[4], MONTHS[4])), path, march)
    stored = active_stores.counts(active_stores.table(spark, path).read(), F.col("report_date"))
    plain = active_stores.counts(active_stores.store_words(fewer, *dims, numbers), F.col("report_date"))
    assert sorted(map(str, stored.collect())) == sorted(map(str, plain.collect()))


def test_sets_travel_without_texts_and_are_not_multiplied_by_level(star):  # noqa: F811
    fact, skus, stores, networks = star
    words = active_stores.store_words(fact, skus, stores, networks, active_stores.store_numbers(stores))
    plan = words._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "Generate explode" in plan
    assert all("global_sku_name" not in line for line in plan.splitlines() if "Aggregate" in line)
