from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from salescube.operators import checks
from salescube.operators.star import slice_extract, sku_names
from salescube.plans import rollup
from salescube.sources import tables

MONTH = date(2024, 1, 1)
FACT = (
    "month_year date, week_start_date date, network_name string, network_subname string, "
    "global_sku_code string, global_pos_code string, pieces int, sales_rub double"
)
SKUS = (
    "global_sku_code string, category string, segment string, group string, brand string, producer string, "
    "global_sku_name string, weight double"
)


def sale(sku, pos, pieces, rub=1.0, month=MONTH, network="N"):
    return (month, month, network, "S", sku, pos, pieces, rub)


@pytest.fixture(scope="module")
def star(spark):
    fact = spark.createDataFrame(
        [sale("s1", "p1", 10, 10.005), sale("s2", "p1", 10), sale("s2", "p2", 5), sale("s3", "p3", 7), sale("gone", "p1", 99)],
        FACT,
    )
    skus = spark.createDataFrame(
        [
            ("s1", "c", "s", "g", "b", "pr", "one", 2.0),
            ("s2", "c", "s", "g", "b", "pr", "two", 4.0),
            ("s3", "c", "s", None, "b", "pr", "three", None),
        ],
        SKUS,
    )
    stores = spark.createDataFrame(
        [(p, "N", "retail" if p != "p2" else "wholesale") for p in ("p1", "p2", "p3")],
        "global_pos_code string, network_name string, store_format string",
    )
    networks = stores.select("global_pos_code", F.lit("S").alias("network_subname_alt"))
    return fact, skus, stores, networks


def by_row(df):
    return {(r["level"], r["group"], r["global_sku_name"]): r for r in df.collect()}


def test_levels_count_stores_once(star):
    rows = by_row(rollup.build(*star))
    group = rows[1, "g", None]
    assert (group["akb"], group["pieces"], group["kg"], group["weight"]) == (2, 25, 0.08, 0.0)
    total = rows[0, None, None]
    assert (total["akb"], total["pieces"], total["kg"], total["sales_rub"]) == (3, 32, 0.08, 13.0)
    weightless = rows[3, None, "three"]
    assert (weightless["kg"], weightless["weight"], weightless["akb"]) == (None, 0.0, 1)
    assert len(rows) == 8 and rows[1, None, None]["pieces"] == 7


def test_missing_group_is_not_taken_for_a_subtotal(star):
    """A product without a group keeps its level: grouping says what is a subtotal, not the null."""
    levels = [r["level"] for r in rollup.build(*star).where("group is null").collect()]
    assert sorted(levels) == [0, 1, 2, 3]


def test_duplicate_product_doubles_sales_and_is_caught(star):
    fact, skus, stores, networks = star
    doubled = skus.unionByName(skus.where("global_sku_code = 's1'"))
    assert by_row(rollup.build(fact, doubled, stores, networks))[3, "g", "one"]["pieces"] == 20
    with pytest.raises(checks.InputError, match="repeats 1 keys"):
        checks.require_clean({"base_sku": (doubled, ["global_sku_code"], ["global_sku_code"])})
    with pytest.raises(checks.InputError, match="no rows"):
        checks.require_clean({"base_sku": (skus.limit(0), ["global_sku_code"], [])})
    with pytest.raises(checks.InputError, match="missing required"):
        checks.require_clean({"base_sku": (skus, ["global_sku_code"], ["weight"])})
    checks.require_clean({"base_sku": (skus, ["global_sku_code"], ["category"])})


def test_variants(star):
    retail = rollup.build(*star, where=F.col("store_format") != "wholesale", store_columns=("store_format",))
    assert by_row(retail)[0, None, None]["akb"] == 2
    whole = rollup.build(*star, subname=F.col("network_name"))
    assert {r["network_subname"] for r in whole.collect()} == {"N"}
    fact, skus, stores, _ = star
    centres = stores.select("global_pos_code", F.concat(F.lit("C"), F.substring("global_pos_code", 2, 1)).alias("centre"))
    regrouped = tables.store_view(stores.withColumn("network_subname", F.lit("x")), centres, "centre")
    names = {r["network_subname"] for r in rollup.build(fact, skus, stores, regrouped).collect()}
    assert names == {"C1", "C2", "C3"}


def test_level_sums_agree(star):
    rows = rollup.build(*star).groupBy("level").agg(F.sum("pieces").alias("p")).collect()
    assert {r["p"] for r in rows} == {32}


def test_only_the_rewritten_slice_changes(spark, star, tmp_path):
    path = str(tmp_path / "rollup")
    fact, *dims = star
    second = date(2024, 2, 1)
    both = fact.unionByName(spark.createDataFrame([sale("s1", "p2", 3, month=second)], FACT))
    rollup.refresh(both, *dims, path, "01.01.2024", "29.02.2024", ["N"], ["N", "M"])
    before = rollup.read_rollup(spark, path).collect()
    changed = both.withColumn("pieces", F.col("pieces") * 2)
    for _ in range(2):
        rollup.refresh(changed, *dims, path, date(2024, 2, 1), date(2024, 2, 1), ["N"], ["N"])
        after = rollup.read_rollup(spark, path).collect()
        assert sorted(map(str, (r for r in after if r["report_date"] == MONTH))) == sorted(
            map(str, (r for r in before if r["report_date"] == MONTH))
        )
        assert {r["pieces"] for r in after if r["report_date"] == second} == {6}
        assert len(after) == len(before)
    assert isinstance(after[0]["last_update"], datetime)


def test_refresh_refuses_before_it_replaces(spark, star, tmp_path):
    path = str(tmp_path / "rollup")
    rollup.refresh(*star, path, "01.01.2024", "31.01.2024", ["N"], ["N"])
    before = sorted(map(str, rollup.read_rollup(spark, path).collect()))
    fact, skus, stores, networks = star
    with pytest.raises(checks.InputError, match="no sales for N in 2024-02-01"):
        rollup.refresh(*star, path, "01.01.2024", "01.02.2024", ["N"], ["N"])
    with pytest.raises(checks.InputError, match="unknown networks"):
        rollup.refresh(*star, path, "01.01.2024", "31.01.2024", ["Z"], ["N"])
    with pytest.raises(ValueError):
        rollup.refresh(*star, path, "01.02.2024", "31.01.2024", ["N"], ["N"])
    other = stores.withColumn("network_name", F.lit("M"))
    with pytest.raises(checks.InputError, match="not requested: 2024-01-01, M"):
        rollup.refresh(fact, skus, other, networks, path, "01.01.2024", "31.01.2024", ["N"], ["N"])
    with pytest.raises(checks.InputError, match="empty"):
        rollup.slice_table(spark, path).replace(rollup.read_rollup(spark, path).limit(0))
    assert sorted(map(str, rollup.read_rollup(spark, path).collect())) == before


def test_stale_slices_and_empty_periods_are_refused(spark, star, tmp_path):
    path = str(tmp_path / "rollup")
    fact, *dims = star
    second = date(2024, 2, 1)
    both = fact.unionByName(spark.createDataFrame([sale("s1", "p2", 3, month=second)], FACT))
    rollup.refresh(both, *dims, path, "01.01.2024", "29.02.2024", ["N"], ["N"])
    before = sorted(map(str, rollup.read_rollup(spark, path).collect()))
    unknown = both.withColumn("global_sku_code", F.when(F.col("month_year") == F.lit(second), "nowhere").otherwise(F.col("global_sku_code")))
    with pytest.raises(checks.InputError, match="would keep their old ones: 2024-02-01, N"):
        rollup.refresh(unknown, *dims, path, "01.01.2024", "29.02.2024", ["N"], ["N"])
    with pytest.raises(checks.InputError, match="no month starts"):
        rollup.refresh(both, *dims, path, "02.01.2024", "31.01.2024", ["N"], ["N"])
    assert sorted(map(str, rollup.read_rollup(spark, path).collect())) == before


def test_slice_extract_and_mismatch(spark, star):
    fact, _, stores, _ = star
    assert slice_extract(fact, F.lit(MONTH), F.lit("N")).count() == 5
    assert slice_extract(fact, F.lit(MONTH), F.lit("M")).count() == 0
    moved = fact.withColumn("network_name", F.lit("M"))
    assert [tuple(r) for r in checks.network_mismatch(moved, stores).collect()] == [("M", "N", 5)]
    assert checks.network_mismatch(fact, stores).count() == 0


def test_sku_name_is_the_first_in_text_order(spark):
    skus = spark.createDataFrame([("a", "z"), ("a", "b"), ("c", "d")], "global_sku_code string, global_sku_name string")
    assert {tuple(r) for r in sku_names(skus).collect()} == {("a", "b"), ("c", "d")}


def test_month_list():
    assert rollup.months_in("15.01.2022", "10.03.2022") == [date(2022, 2, 1), date(2022, 3, 1)]
    assert rollup.months_in(date(2021, 12, 1), date(2022, 1, 1)) == [date(2021, 12, 1), date(2022, 1, 1)]


def test_rows_travel_without_texts_and_are_not_multiplied_by_level(star):
    """A shuffle of all levels' rows with their texts took 38 times the input."""
    plan = rollup.build(*star)._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "Generate explode" in plan
    assert all("global_sku_name" not in line for line in plan.splitlines() if "Aggregate" in line or "Window" in line)


def test_levels_equal_plain_sums_over_odd_rows(spark):
    """Two codes of one product row, nulls in the hierarchy, a code and a store that come twice, a store in two networks."""
    fact = [sale(f"s{s}", f"p{p}", s + p, float(s * p)) for s in range(7) for p in range(6) if (s + p) % 4]
    skus = [
        ("s0", "c", "s", "g", "b", "x", "one", 2.0), ("s1", "c", "s", "g", "b", "x", "one", 2.0), ("s2", "c", "s", "g", "b", None, "two", 4.0),
        ("s3", "c", "s", None, "b", "x", "one", None), ("s4", "c", "s", "", "b", "x", None, 0.0), ("s5", None, "s", "g", "b", "x", "one", 2.0),
        ("s6", "c", "s", "g", "b", "y", "one", 2.0), ("s6", "c", "s", "g", "b", "y", "one", 2.0),
    ]
    stores = [("p0", "N"), ("p1", "N"), ("p1", "M"), ("p2", "M"), ("p2", "M"), ("p3", None), ("p4", "N")]
    subs = {"p0": "S", "p1": "S", "p2": "T", "p3": None, "p4": "S"}
    want = {}
    for month, _, _, _, sku, pos, pieces, rub in fact:
        for _, category, segment, group, brand, producer, name, weight in (r for r in skus if r[0] == sku):
            for _, network in (r for r in stores if r[0] == pos):
                texts = (category, segment, group, producer, brand, name, weight)
                for level, kept in enumerate((0, 3, 4, 7)):
                    key = (month, network, subs[pos], *[t if i < kept else None for i, t in enumerate(texts[:6])], (weight or 0.0) if level == 3 else 0.0, level)
                    row = want.setdefault(key, [set(), 0, 0.0, None])
                    row[0].add(pos)
                    row[1] += pieces
                    row[2] += rub
                    row[3] = row[3] if weight is None else (row[3] or 0.0) + pieces * weight
    found = rollup.build(
        spark.createDataFrame(fact, FACT), spark.createDataFrame(skus, SKUS),
        spark.createDataFrame(stores, "global_pos_code string, network_name string"),
        spark.createDataFrame(list(subs.items()), "global_pos_code string, network_subname_alt string"),
    ).collect()
    got = {
        (r["report_date"], r["network_name"], r["network_subname"], r["category"], r["segment"], r["group"], r["producer"], r["brand"],
         r["global_sku_name"], r["weight"], r["level"]): (r["akb"], r["pieces"], r["sales_rub"], r["kg"])
        for r in found
    }
    assert len(found) == len(got)
    assert got == {k: (len(v[0]), v[1], v[2], None if v[3] is None else round(v[3] / 1000, 2)) for k, v in want.items()}


def test_upper_levels_are_added_up_from_one_shuffle_by_group(star):
    """Producer rows were shuffled twice: once to be added up, and again beside the groups and totals."""
    plan = rollup.build(*star)._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert any("group_no" in line for line in dealt) and all("level" not in line and "producer_no" not in line for line in dealt)
