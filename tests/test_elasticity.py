from __future__ import annotations

from datetime import date, timedelta

import pytest
from conftest import one
from pyspark.sql import functions as F

from salescube.plans import elasticity

START = date(2024, 4, 1)
POINTS = "network_subname string, global_sku_code string, price_bin double, turnover double, akb long, price_bin_range string, kg double"
EXTRA = {"listed_kg": 0, "listed_stores": 0, "kept_stores": 0, "kept_rows": 0, "filter": 1}


def points(spark, rows, sku="s"):
    df = spark.createDataFrame([("n", sku, float(x), float(y), w, "", 1.0) for x, y, w in rows], POINTS)
    return df.withColumns({c: F.lit(v) for c, v in EXTRA.items()})


def test_fit_against_worked_values(spark):
    rows = [(102.5, 5, 10), (107.5, 4.2, 30), (112.5, 4, 25), (117.5, 3.1, 5)]
    fit = one(elasticity.fits(points(spark, rows)).select("ped", "alpha", "r2", "rmse", "points", "status"))
    assert fit == (-2.6729, 13.9655, 0.8692, 0.158, 4, "ok")
    predicted = [r["turnover_pred"] for r in elasticity.predictions(points(spark, rows)).orderBy("price_bin").collect()]
    assert predicted == [4.9056, 4.3192, 3.8250, 3.4053]


def test_fit_equals_the_library_regression(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    df = points(spark, [(20.0 + 5 * i, 9.0 - 0.3 * i + (i % 3) * 0.4, 3 + i) for i in range(15)])
    logs = df.select(F.ln("price_bin").alias("x"), F.ln("turnover").alias("y"), F.col("akb").cast("double").alias("w"))
    model = LinearRegression(featuresCol="f", labelCol="y", weightCol="w", solver="normal").fit(
        VectorAssembler(inputCols=["x"], outputCol="f").transform(logs)
    )
    slope, intercept = one(elasticity.fits(df).select("slope", "intercept"))
    assert slope == pytest.approx(model.coefficients[0], abs=1e-9)
    assert intercept == pytest.approx(model.intercept, abs=1e-9)


def test_too_few_points_and_no_turnover(spark):
    single = one(elasticity.fits(points(spark, [(10, 5, 1)])).select("status", "ped", "points"))
    assert single == ("too_few_points", None, 1)
    zero = one(elasticity.fits(points(spark, [(10, 5, 1), (15, 4, 1), (20, 0, 9)])).select("status", "points", "points_left_out"))
    assert zero == ("ok", 2, 1)
    text = elasticity.summary(
        elasticity.fits(points(spark, [(10, 5, 1)])),
        spark.createDataFrame([("s", "Soap")], "global_sku_code string, global_sku_name string"), START, 8,
    )
    assert one(text.select("sku", "dates", "weeks", "equation")) == ("Soap (s)", "2024.04.01-2024.05.20", "8", None)


@pytest.fixture(scope="module")
def market(spark):
    """Three stores over eight weeks: one sells in two weeks, one in three, one in all; a fourth has no weight to price."""
    rows = []
    for store, weeks, rub in (("rare", 2, 1000.0), ("some", 3, 1000.0), ("all", 8, 520.0)):
        for w in range(weeks):
            week = START + timedelta(weeks=w)
            rows.append((week, "s", store, 6, rub))
            rows.append((week, "s", store, 4, 0.0))
    rows.append((START - timedelta(weeks=1), "s", "all", 1, 1.0))
    rows.append((START + timedelta(weeks=8), "s", "all", 1, 1.0))
    rows.append((START, "w", "all", 5, 5.0))
    fact = spark.createDataFrame(
        rows, "week_start_date date, global_sku_code string, global_pos_code string, pieces int, sales_rub double"
    )
    skus = spark.createDataFrame(
        [("s", "Soap", 1000.0), ("w", "Weightless", 0.0)], "global_sku_code string, global_sku_name string, weight double"
    )
    stores = spark.createDataFrame([("rare",), ("some",), ("all",)], "global_pos_code string")
    return fact, skus, stores, stores.withColumn("network_subname_alt", F.lit("n")), START, 8


def test_store_activity(spark, market):
    weekly = elasticity.store_weeks(*market)
    listed = {(r["global_sku_code"], r["global_pos_code"]): r for r in elasticity.store_list(weekly, 8).collect()}
    soap = {pos: (r["wks"], r["filter"]) for (sku, pos), r in listed.items() if sku == "s"}
    assert soap == {"rare": (2, 0), "some": (3, 1), "all": (8, 1)}
    assert listed["s", "some"]["wks_list"] == "14;15;16" and float(listed["s", "all"]["kg"]) == 80.0
    flags = {(r["global_pos_code"], r["filter"]) for r in elasticity.flagged(weekly, 8).where("global_sku_code = 's'").collect()}
    assert flags == {("rare", 0), ("some", 1), ("all", 1)}
    kept = elasticity.kept_sales(weekly, elasticity.store_list(weekly, 8)).count()
    assert kept == 11 and elasticity.dropped_sales(weekly, elasticity.store_list(weekly, 8)).count() == weekly.count() - 11


def test_named_products_and_networks(market):
    assert {r["global_sku_code"] for r in elasticity.store_weeks(*market, products=["w"]).collect()} == {"w"}
    assert elasticity.store_weeks(*market, subnames=["m"]).count() == 0
    assert elasticity.store_weeks(*market, products=["s", "w"], subnames=["n"]).count() == 14


def test_week_numbers_keep_date_order_across_new_year(spark):
    weeks = [date(2024, 12, 23), date(2024, 12, 30), date(2025, 1, 6)]
    weekly = spark.createDataFrame(
        [("n", "s", "p", w, w.isocalendar()[1], 1.0, 1.0) for w in reversed(weeks)],
        "network_subname string, global_sku_code string, global_pos_code string, week_start_date date, wk_num int, "
        "kg double, rub double",
    )
    assert elasticity.store_list(weekly, 8).collect()[0]["wks_list"] == "52;1;2"


def test_bins_and_coverage(market):
    marked = elasticity.flagged(elasticity.store_weeks(*market), 8)
    prices = {(r["price_bin_range"], r["price_kg"]): (r["akb"]) for r in
              elasticity.weekly_prices(marked).where("week_start_date = '2024-04-01'").collect()}
    assert prices == {("100-105", 100.0): 1, ("50-55", 52.0): 1}
    levels = elasticity.price_levels(marked, 8, share=0.2).where("price_bin is not null")
    got = {r["price_bin_range"]: (r["akb"], r["akb_limit"], r["turnover"], r["filter"]) for r in levels.collect()}
    assert got == {"100-105": (3, 5, 10.0, 0), "50-55": (8, 5, 10.0, 1)}
    placed = elasticity.price_points(levels).collect()
    assert [(r["price_bin"], r["price_bin_range"]) for r in placed] == [(52.5, "50-55")]
    with pytest.raises(ValueError):
        elasticity.price_levels(marked, 8, base="some")


def test_coverage_limit_rounds_half_to_even(spark):
    flagged = spark.range(25).select(
        F.lit("n").alias("network_subname"), F.lit("s").alias("global_sku_code"), F.lit(5.0).alias("price_bin"),
        F.lit("5-10").alias("price_bin_range"), F.lit(1.0).alias("kg"), F.lit(True).alias("first_of_store"),
        F.lit(1).alias("filter"),
    )
    assert elasticity.price_levels(flagged, 10).collect()[0]["akb_limit"] == 2
    assert elasticity.price_levels(flagged, 10, share=0.0067, base="kept").collect()[0]["akb_limit"] == 2
    assert elasticity.price_levels(flagged, 30, share=0.0067, base="kept").collect()[0]["akb_limit"] == 5


def test_store_weeks_without_a_price_count_as_stores_only(market):
    levels = elasticity.price_levels(elasticity.flagged(elasticity.store_weeks(*market), 8), 8)
    weightless = levels.where("global_sku_code = 'w'").collect()
    assert [(r["price_bin"], r["listed_stores"], r["filter"]) for r in weightless] == [(None, 1, 0)]


def test_both_routes_agree_under_equal_settings(market):
    marked = elasticity.flagged(elasticity.store_weeks(*market), 8)
    levels = elasticity.price_levels(marked, 8, share=elasticity.COVERAGE_SHARE_KEPT, base="kept")
    columns = ["global_sku_code", "price_bin", "price_bin_range", "akb"]
    frames = elasticity.price_points(levels).select(*columns).collect()
    statement = elasticity.price_points_sql(*market).select(*columns).collect()
    assert sorted(frames) == sorted(statement) and len(frames) == 2


def test_study_writes_every_table(spark, market, tmp_path):
    from salescube.sources.tables import write_results

    tables = elasticity.study(*market)
    write_results(tables, str(tmp_path))
    counts = {name: spark.read.parquet(f"{tmp_path}/{name}").count() for name in tables}
    assert counts == {
        "store_list": 4, "store_weeks": 14, "weekly_prices": 11, "price_levels": 2, "price_points": 2, "results": 2,
    }
    results = {r["global_sku_code"]: r for r in spark.read.parquet(f"{tmp_path}/results").collect()}
    assert (results["w"]["status"], results["w"]["stores"], results["w"]["kg"], results["w"]["ped"]) == ("no_points", "0 / 1", "0 / 0", None)
    result = results["s"]
    assert (result["stores"], result["store_weeks"], result["kg"]) == ("2 / 3", "11 / 16 / 24", "110 / 130")


def test_bins_of_dropped_stores_are_no_price_levels(spark, market):
    fact, *rest = market
    dear = spark.createDataFrame([(START, "s", "rare2", 1, 900.0)], fact.schema)
    stores = rest[1].union(spark.createDataFrame([("rare2",)], rest[1].schema))
    networks = stores.withColumn("network_subname_alt", F.lit("n"))
    levels = elasticity.price_levels(elasticity.flagged(elasticity.store_weeks(fact.union(dear), rest[0], stores, networks, START, 8), 8), 8)
    assert "900-905" in {r["price_bin_range"] for r in levels.collect()}
    kept = elasticity.kept_levels(levels).collect()
    assert {r["price_bin_range"] for r in kept} == {"50-55", "100-105"} and {r["listed_stores"] for r in kept} == {4}
    status = {r["global_sku_code"]: r["status"] for r in elasticity.fits(elasticity.placed(levels)).collect()}
    assert status == {"s": "ok", "w": "no_points"}
