"""Dated snapshots of the source tables, and reading them back."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescube.sources.zstd_text import write_zstd

# The text dump format and the names of dumped partitions, as in retail_sales_y2024m1_2024-01-10.zst.
CSV_OPTIONS = {"sep": ";", "header": "true", "quote": '"', "escape": '"', "encoding": "UTF-8"}
PARTITION_NAME = r"retail_sales_y(\d{4})m(\d{1,2})"


def snapshot_path(root: str, name: str, taken: date) -> str:
    """Date-stamped directory of one snapshot of a table."""
    return f"{root.rstrip('/')}/{name}_{taken.isoformat()}"


def write_snapshot(
    df: DataFrame,
    path: str,
    partition_by: str | None = "month_year",
    fmt: str = "parquet",
) -> None:
    """One directory per partition. Adaptive execution spreads a large partition over tasks and files by its bytes.

    Parquet with zstd by default. `fmt="zst"` writes text dumps in Zstandard frames (`zstd_text`), whose files carry the name of the
    directory they are written to; `fmt="csv"` writes text compressed with gzip.
    """
    if fmt == "zst":
        name, _, taken = path.rstrip("/").rpartition("/")[2].rpartition("_")
        write_zstd(df, path, name or taken, taken if name else "", partition_by)
        return
    if partition_by is not None:
        df = df.hint("rebalance", partition_by)
    writer = df.write.mode("errorifexists")
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    if fmt == "parquet":
        writer.option("compression", "zstd").parquet(path)
    elif fmt == "csv":
        writer.options(**CSV_OPTIONS).option("compression", "gzip").csv(path)
    else:
        raise ValueError(f"unknown snapshot format {fmt!r}, expected 'parquet', 'zst' or 'csv'")


def read_snapshot(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """A Parquet snapshot under its declared schema, partition column included."""
    paths = [path] if isinstance(path, str) else path
    return spark.read.schema(schema).parquet(*paths).select(*schema.fieldNames())


def read_dump(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """Text dumps (.csv, .gz or .zst, by file extension) under a declared schema; a malformed row is an error."""
    return spark.read.options(**CSV_OPTIONS).option("mode", "FAILFAST").schema(schema).csv(path)


def partition_number(file_name: Column) -> Column:
    """Year and month of a dumped partition as one sortable number: 202410 comes after 202409."""
    year = F.regexp_extract(file_name, PARTITION_NAME, 1)
    month = F.regexp_extract(file_name, PARTITION_NAME, 2)
    return F.when(year != "", year.cast("int") * 100 + month.cast("int"))


def partitions(df: DataFrame, column: str = "month_year", year: int | None = None) -> DataFrame:
    """Partition values in calendar order, all of them or those of one year."""
    listed = df.select(column).distinct()
    if year is not None:
        listed = listed.where(F.year(column) == year)
    return listed.orderBy(column)


def latest_partition(df: DataFrame, column: str = "month_year") -> DataFrame:
    """Rows of the newest partition; the scalar subquery prunes all other directories."""
    newest = df.agg(F.max(column).alias("newest"))
    return df.where(F.col(column) == newest.scalar())


def jdbc_predicates(months: list[date], column: str = "month_year") -> list[str]:
    """One predicate per month, so that each month is read by its own task."""
    return [f"{column} = DATE '{m.isoformat()}'" for m in sorted(months)]


def read_jdbc(spark: SparkSession, url: str, table: str, months: list[date], properties: dict[str, str]) -> DataFrame:
    """A partitioned database table, one task and connection per month."""
    return spark.read.jdbc(url, table, predicates=jdbc_predicates(months), properties=properties)
