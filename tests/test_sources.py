from __future__ import annotations

from datetime import date, datetime

import pytest
import zstandard
from conftest import column
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from salescube.operators.checks import InputError, not_null
from salescube.plans import warehouse
from salescube.schemas import BASE_SKU, RAW_PARTITION, RETAIL_SALES, ROLLUP
from salescube.sources import scratch, snapshot, tables

HEADER = ";".join(RAW_PARTITION.fieldNames())


def raw_line(month, sku="k1", rub="12.5"):
    return f'2024;{month};Net;Sub;"a;b";{sku};x;p1;3;{rub};;2024-{month:02}-01;{month};"say ""hi""";2024-01-10 10:00:00;s;1;2024-{month:02}-01'


def dump(folder, month, *lines):
    path = folder / f"retail_sales_y2024m{month}_2024-01-10.zst"
    path.write_bytes(zstandard.compress("\n".join([HEADER, *lines, ""]).encode()))
    return path


def test_loads_compressed_dumps_in_one_read(spark, tmp_path):
    for month in (9, 10):
        dump(tmp_path, month, raw_line(month), raw_line(month, "k2"))
    sales = snapshot.read_dump(spark, f"{tmp_path}/retail_sales_y*", RAW_PARTITION)
    assert sales.count() == 4 and set(column(sales, "file")) == {'say "hi"'}
    assert sales.collect()[0]["created"] == datetime(2024, 1, 10, 10)
    tables.append_sales(sales, str(tmp_path / "fact"))
    tables.append_sales(sales.where("month = 10"), str(tmp_path / "fact"))
    fact = tables.read_table(spark, str(tmp_path / "fact"), RETAIL_SALES)
    assert fact.columns == RETAIL_SALES.fieldNames()
    assert {r["month_year"]: r["count"] for r in fact.groupBy("month_year").count().collect()} == {
        date(2024, 9, 1): 2, date(2024, 10, 1): 4,
    }
    plan = snapshot.read_dump(spark, f"{tmp_path}/retail_sales_y*", RAW_PARTITION).select("pieces")
    assert "ReadSchema: struct<pieces:int>" in plan._jdf.queryExecution().toString()


def test_malformed_and_missing_values_stop_the_load(spark, tmp_path):
    bad = dump(tmp_path, 1, raw_line(1, rub="much"))
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILED_READ_FILE"):
        snapshot.read_dump(spark, str(bad), RAW_PARTITION).collect()
    hole = dump(tmp_path, 2, raw_line(2, sku=""))
    with pytest.raises(PySparkException, match="null in required column global_sku_code"):
        tables.append_sales(snapshot.read_dump(spark, str(hole), RAW_PARTITION), str(tmp_path / "fact"))
    assert not list((tmp_path / "fact").glob("month_year=*"))


def test_partitions_sort_by_number_not_by_text(spark):
    names = ["retail_sales_y2024m10_x.zst", "retail_sales_y2024m9_x.zst", "retail_sales_y2023m12_x.zst", "calendar_x.zst"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = df.withColumn("p", snapshot.partition_number(F.col("n"))).where("p is not null").orderBy("p")
    assert column(got, "p") == [202312, 202409, 202410]


@pytest.fixture(scope="module")
def sales(spark):
    rows = [(date(y, m, 1), date(y, m, 1), "N", "S", "k", "p", m, float(m)) for y, m in ((2023, 12), (2024, 2), (2024, 10))]
    return spark.createDataFrame(rows, RETAIL_SALES)


def test_choice_of_partitions(sales):
    assert column(snapshot.partitions(sales), "month_year") == [date(2023, 12, 1), date(2024, 2, 1), date(2024, 10, 1)]
    assert warehouse.choose_partitions(sales, "latest").collect()[0]["pieces"] == 10
    assert sorted(column(warehouse.choose_partitions(sales, 2024), "pieces")) == [2, 10]
    assert warehouse.choose_partitions(sales).count() == 3
    with pytest.raises(InputError):
        warehouse.choose_partitions(sales, "newest")


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_snapshot_has_one_directory_per_month(spark, sales, tmp_path, fmt):
    paths = warehouse.take_snapshot({"retail_sales": sales}, str(tmp_path), date(2024, 1, 10), fmt=fmt)
    assert paths == {"retail_sales": f"{tmp_path}/retail_sales_2024-01-10"}
    months = sorted(p.name for p in (tmp_path / "retail_sales_2024-01-10").glob("month_year=*"))
    assert months == ["month_year=2023-12-01", "month_year=2024-02-01", "month_year=2024-10-01"]
    read = {"parquet": snapshot.read_snapshot, "csv": snapshot.read_dump}[fmt]
    back = read(spark, paths["retail_sales"], RETAIL_SALES).select(*RETAIL_SALES.fieldNames())
    assert sorted(back.collect()) == sorted(sales.collect())
    with pytest.raises(ValueError):
        snapshot.write_snapshot(sales, str(tmp_path / "x"), fmt="xml")


def test_month_filter_reads_one_directory(spark, sales, tmp_path):
    snapshot.write_snapshot(sales, str(tmp_path / "s"))
    one_month = snapshot.read_snapshot(spark, str(tmp_path / "s"), RETAIL_SALES).where("month_year = '2024-02-01' and pieces > 1")
    plan = one_month._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(month_year" in plan and "GreaterThan(pieces,1)" in plan


def test_database_reads_one_month_per_task():
    assert snapshot.jdbc_predicates([date(2024, 10, 1), date(2024, 9, 1)]) == [
        "month_year = DATE '2024-09-01'", "month_year = DATE '2024-10-01'",
    ]


def test_not_null_only_guards_required_columns(spark):
    df = spark.createDataFrame([("a",) + (None,) * 12], BASE_SKU.fieldNames()[0] + " string, " + ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in BASE_SKU.fields[1:]))
    with pytest.raises(PySparkException, match="null in required column"):
        not_null(df, BASE_SKU).collect()
    assert not_null(df, BASE_SKU).select("barcode", "change").collect()[0]["barcode"] is None


def test_insert_by_name_and_type(spark):
    with pytest.raises(InputError, match="kg"):
        tables.insert_aligned(spark.range(1).select(*[F.lit(None).alias(n) for n in ROLLUP.fieldNames() if n != "kg"]))
    shuffled = spark.range(1).select(*[F.lit(None).alias(n) for n in sorted(ROLLUP.fieldNames())])
    aligned = tables.insert_aligned(shuffled)
    assert [(f.name, f.dataType) for f in aligned.schema] == [(f.name, f.dataType) for f in ROLLUP]


def test_views_by_name(spark, sales):
    tables.register_views({"retail_sales": sales})
    assert spark.sql("select sum(pieces) from retail_sales").collect()[0][0] == 24
    skus = spark.createDataFrame([("a", 50.0), ("b", 150.0), ("c", 999.0)], "global_sku_code string, weight double")
    classes = tables.weight_category_view(skus, [(100, "small"), (500, "large")])
    assert {r["global_sku_code"]: r["weight_category"] for r in classes.collect()} == {"a": "small", "b": "large", "c": None}


def test_staged_table_lands_in_the_shared_folder(spark, sales):
    staged = scratch.stage(sales, "sales")
    assert scratch.scratch_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert all(scratch.scratch_dir(spark) in f for f in staged.inputFiles())
    assert sorted(staged.collect()) == sorted(sales.collect())


@pytest.fixture
def small_pieces(spark):
    names = ["spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize"]
    before = {n: spark.conf.get(n) for n in names}
    spark.conf.set(names[1], "1k")
    spark.conf.set(names[0], "16k")
    yield
    for n in names[::-1]:
        spark.conf.set(n, before[n])


def test_writers_split_a_hot_partition_by_its_bytes(spark, tmp_path, small_pieces):
    from salescube.plans import report
    from salescube.schemas import ROLLUP
    from salescube.sources.slices import SliceTable

    hot, cold = date(2024, 1, 1), date(2024, 2, 1)
    rows = spark.range(0, 60_000, 1, 12).select(
        F.when(F.col("id") < 59_900, F.lit(hot)).otherwise(F.lit(cold)).alias("month_year"), F.lit(hot).alias("week_start_date"), F.lit("n").alias("network_name"),
        F.lit("n").alias("network_subname"), F.sha2(F.col("id").cast("string"), 256).alias("global_sku_code"), F.lit("p").alias("global_pos_code"), F.lit(1).alias("pieces"),
        F.lit(1.5).alias("sales_rub"))
    tables.append_sales(rows, str(tmp_path / "fact"))
    snapshot.write_snapshot(rows, str(tmp_path / "copy"))
    slices = rows.select(*[
        (F.col("month_year") if f.name == "report_date" else F.col("global_sku_code") if f.name == "global_sku_name" else F.lit("n") if f.name == "network_name"
         else F.lit(None)).cast(f.dataType).alias(f.name) for f in ROLLUP.fields])
    stored = SliceTable(spark, str(tmp_path / "slices"), ["report_date", "network_name"], ROLLUP)
    stored.replace(slices)
    files = {key[0]: len(s.files) for key, s in stored.manifest().slices.items()}
    assert files[hot] > 3 and files[cold] <= 2, files
    wide = rows.select(F.col("month_year").cast("string").alias("network_subname"), F.monotonically_increasing_id().alias("position"), "global_sku_code")
    report.write(wide, str(tmp_path / "report"))
    for name, key in (("fact", "month_year"), ("copy", "month_year"), ("report", "network_subname")):
        files = {d: len(list((tmp_path / name / f"{key}={d}").rglob("*.parquet"))) for d in (hot, cold)}
        assert files[hot] > 3 and files[cold] <= 2, (name, files)


def test_more_decimals_than_sums_hold_are_refused(spark, sales, tmp_path):
    with pytest.raises(Exception, match="more than four decimal places"):
        tables.append_sales(sales.withColumn("sales_rub", F.lit(10.0) / 3), str(tmp_path / "fact"))


def test_release_removes_only_its_own_folder(spark, sales):
    import os

    from salescube.sources.scratch import release, scratch_dir, stage

    kept, gone = stage(sales, "kept"), stage(sales, "gone")
    release(gone)
    names = os.listdir(scratch_dir(spark))
    assert any(n.startswith("kept-") for n in names) and not any(n.startswith("gone-") for n in names)
    assert kept.count() == sales.count()
