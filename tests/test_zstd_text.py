"""Text dumps in Zstandard frames: what is written, read by many tasks, read from other tools, refused."""

from __future__ import annotations

import json
import os
from datetime import date, datetime

import pytest
import zstandard
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_sources import dump, raw_line

from salescube.plans import warehouse
from salescube.schemas import RAW_PARTITION, RETAIL_SALES
from salescube.sources import snapshot, tables
from salescube.sources.zstd_text import read_zstd, write_zstd

KINDS = T.StructType([
    T.StructField("day", T.DateType()), T.StructField("text", T.StringType()), T.StructField("x", T.DoubleType()),
    T.StructField("n", T.IntegerType()), T.StructField("at", T.TimestampNTZType()),
])
ROWS = [
    (date(2024, 9, 1), 'semi;colon "quoted"\nnext line', 0.1 + 0.2, -5, datetime(2024, 1, 10, 10, 0, 0, 5)),
    (date(2024, 10, 1), "", 1e300, None, None),
    (date(2024, 10, 1), None, None, 7, datetime(1999, 12, 31)),
    (None, "é 字 \r", -0.0, 0, None),
]


def written(folder):
    return sorted(f for f in os.listdir(folder) if not f.startswith(("_", ".")))


def test_every_value_comes_back_and_any_tool_reads_it(spark, tmp_path):
    path = str(tmp_path / "dump")
    write_zstd(spark.createDataFrame(ROWS, KINDS).coalesce(1), path, "retail_sales", "2024-01-10", "day")
    assert {f.rsplit("-", 1)[0] for f in written(path)} == {"retail_sales_y2024m9_2024-01-10", "retail_sales_y2024m10_2024-01-10", "retail_sales_none_2024-01-10"}
    assert sorted(map(str, read_zstd(spark, path, KINDS).collect())) == sorted(map(str, spark.createDataFrame(ROWS, KINDS).collect()))
    one = next(f for f in written(path) if "m10" in f)
    text = zstandard.ZstdDecompressor().stream_reader(open(f"{path}/{one}", "rb"), read_across_frames=True).read().decode()
    assert text == 'day;text;x;n;at\n2024-10-01;"";1e+300;;\n2024-10-01;;;7;1999-12-31 00:00:00.000000\n'
    numbers = spark.createDataFrame([(f,) for f in written(path)], "f string").select(snapshot.partition_number(F.col("f")).alias("p"))
    assert {r.p for r in numbers.collect()} == {202409, 202410, None}
    assert not [f for f in os.listdir(path) if f.startswith("_temporary")]


def test_many_tasks_read_one_file(spark, tmp_path):
    path = str(tmp_path / "dump")
    rows = spark.range(0, 20_000, 1, 1).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    write_zstd(rows, path, "big", frameBytes=50_000)
    assert written(path) == ["big-00000.zst"]
    index = json.load(open(f"{path}/_big-00000.zst.frames.json"))["frames"]
    assert len(index) > 10 and sum(f[3] for f in index) == 20_000
    back = read_zstd(spark, path, rows.schema, splitBytes=200_000)
    per_task = [r["count"] for r in back.groupBy(F.spark_partition_id()).count().collect()]
    assert len(per_task) > 3 and sum(per_task) == 20_000 and max(per_task) < 8_000
    assert back.exceptAll(rows).isEmpty()
    assert read_zstd(spark, path, rows.schema, ["text"]).columns == ["text"]
    assert read_zstd(spark, path, rows.schema, ["text"]).exceptAll(rows.select("text")).isEmpty()


def test_dumps_of_other_tools_are_streamed(spark, tmp_path):
    for month in (9, 10):
        dump(tmp_path, month, raw_line(month), raw_line(month, "k2"))
    sales = read_zstd(spark, str(tmp_path), RAW_PARTITION)
    assert sales.count() == 4 and {r["file"] for r in sales.collect()} == {'say "hi"'} and {r.pos_code for r in sales.collect()} == {"x"}
    assert {r.alt_sku for r in sales.collect()} == {None}
    tables.append_sales(read_zstd(spark, str(tmp_path), RAW_PARTITION, RETAIL_SALES.fieldNames()), str(tmp_path / "fact"))
    assert tables.read_table(spark, str(tmp_path / "fact"), RETAIL_SALES).count() == 4


def test_malformed_rows_and_broken_files_are_errors(spark, tmp_path):
    bad = dump(tmp_path, 1, raw_line(1, rub="much"))
    with pytest.raises(Exception, match="much"):
        read_zstd(spark, str(bad), RAW_PARTITION).collect()
    short = dump(tmp_path, 2, "2024;1;Net")
    with pytest.raises(Exception, match="Expected 18 columns"):
        read_zstd(spark, str(short), RAW_PARTITION).collect()
    with pytest.raises(Exception, match="nowhere"):
        read_zstd(spark, str(tmp_path / "nowhere"), RAW_PARTITION).collect()
    path = str(tmp_path / "dump")
    write_zstd(spark.range(3), path, "t")
    with pytest.raises(Exception, match="is not empty"):
        write_zstd(spark.range(3), path, "t")
    with open(f"{path}/{written(path)[0]}", "ab") as file:
        file.write(b"more")
    with pytest.raises(Exception, match="do not belong together"):
        read_zstd(spark, path, spark.range(1).schema).collect()


def test_a_failed_job_leaves_no_files(spark, tmp_path):
    path = str(tmp_path / "dump")
    rows = spark.range(0, 100, 1, 4).select(F.when(F.col("id") == 77, F.raise_error(F.lit("stop"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        write_zstd(rows, path, "t")
    assert not os.path.exists(path) or os.listdir(path) == []


def test_an_empty_table_and_a_star_of_dumps(spark, tmp_path):
    empty = spark.createDataFrame([], KINDS)
    write_zstd(empty, str(tmp_path / "none"), "t")
    (tmp_path / "none").mkdir(exist_ok=True)
    assert read_zstd(spark, str(tmp_path / "none"), KINDS).collect() == []
    paths = warehouse.take_snapshot({"retail_sales": spark.createDataFrame(ROWS, KINDS).withColumnRenamed("day", "month_year")}, str(tmp_path), date(2024, 1, 10), fmt="zst")
    assert paths["retail_sales"].endswith("retail_sales_2024-01-10") and any("retail_sales_y2024m9_2024-01-10" in f for f in written(paths["retail_sales"]))
