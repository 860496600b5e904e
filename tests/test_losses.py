"""What the star joins leave out."""

from datetime import date
from decimal import Decimal

from salescube.operators import losses
from salescube.plans import rollup

MONTH, LATER = date(2024, 1, 1), date(2024, 2, 1)
SALES = "month_year date, week_start_date date, network_name string, network_subname string, global_sku_code string, global_pos_code string, pieces int, sales_rub double"
SKUS = ("global_sku_code string, category string, segment string, `group` string, producer string, brand string, "
        "global_sku_name string, weight double, sales_rows string, loss string")


def _star(spark, sales):
    """Products a and b, stores 1 to 3, networks of stores 1, 2 and 9; columns whose names clash with those of the split."""
    skus = spark.createDataFrame([(c, "C", "S", "G", "P", "B", f"name {c}", 500.0, "x", "y") for c in "ab"], SKUS)
    stores = spark.createDataFrame([(c, "Net") for c in "123"], "global_pos_code string, network_name string")
    networks = spark.createDataFrame([(c, "Sub") for c in "129"], "global_pos_code string, network_subname_alt string")
    fact = spark.createDataFrame([(m, m, "Net", "Sub", sku, pos, n, rub) for m, sku, pos, n, rub in sales], SALES)
    return fact, skus, stores, networks


ROWS = [
    (MONTH, "a", "1", 1, 10.0), (MONTH, "a", "1", 2, 20.0), (LATER, "b", "2", 1, 5.0),
    (MONTH, "z", "1", 3, 7.0), (MONTH, "a", "3", 4, 8.0), (MONTH, "a", "9", 5, 9.0), (MONTH, "z", "8", 6, 1.5), (MONTH, "z", "8", 6, 1.5),
    (LATER, None, "1", 7, 2.0), (LATER, "b", None, 8, 3.0),
]


def test_every_row_is_kept_or_lost_for_a_reason(spark):
    cube, split = rollup.build_split(*_star(spark, ROWS))
    found = {(r.month_year, r.loss): (r.sales_rows, r.pieces, r.sales_rub) for r in losses.balance(split).collect()}
    assert found == {
        (MONTH, "kept"): (2, 3, Decimal("30")), (LATER, "kept"): (1, 1, Decimal("5")),
        (MONTH, "product"): (1, 3, Decimal("7")), (MONTH, "network"): (1, 4, Decimal("8")), (MONTH, "store"): (1, 5, Decimal("9")),
        (MONTH, "product,store,network"): (2, 12, Decimal("3")),
        (LATER, "product"): (1, 7, Decimal("2")), (LATER, "store,network"): (1, 8, Decimal("3")),
    }
    whole = rollup.build(*_star(spark, ROWS))
    assert sorted(map(tuple, cube.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)


def test_codes_that_lack_an_entry(spark):
    _, split = rollup.build_split(*_star(spark, ROWS))
    found = {(r.dimension, r.code): (r.sales_rows, r.sales_rub) for r in losses.missing_codes(split).collect()}
    assert found == {
        ("product", "z"): (3, Decimal("10")), ("product", None): (1, Decimal("2")),
        ("store", "9"): (1, Decimal("9")), ("store", "8"): (2, Decimal("3")), ("store", None): (1, Decimal("3")),
        ("network", "3"): (1, Decimal("8")), ("network", "8"): (2, Decimal("3")), ("network", None): (1, Decimal("3")),
    }


def test_repeated_codes_multiply_no_loss(spark):
    fact, skus, stores, networks = _star(spark, ROWS[3:4])
    split = rollup.build_split(fact, skus, stores.union(stores), networks.union(networks))[1]
    assert [r.sales_rows for r in losses.balance(split).collect()] == [1]


def test_nothing_sold_and_nothing_lost(spark):
    cube, split = rollup.build_split(*_star(spark, []))
    assert cube.count() == 0 and losses.balance(split).count() == 0 and losses.missing_codes(split).count() == 0
    _, split = rollup.build_split(*_star(spark, ROWS[:3]))
    assert split.lost.count() == 0 and split.kept.count() == 2


def test_the_sales_are_not_read_again_for_the_losses(spark, tmp_path):
    """The loss table reads the files of its marks alone: no scan of the sales, and none of the kept rows."""
    fact, *dims = _star(spark, ROWS)
    fact.write.parquet(str(tmp_path / "fact"))
    _, split = rollup.build_split(spark.read.parquet(str(tmp_path / "fact")), *dims)
    plan = losses.missing_codes(split)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and str(tmp_path / "fact") not in plan
    assert "PartitionFilters" in plan and "NOT (loss" in plan
