"""Snapshot the source tables, and load a typed, pruned star from the copies."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescube.operators.checks import InputError
from salescube.schemas import BASE_SALES_POINT, BASE_SKU, CALENDAR, RAW_PARTITION, RETAIL_SALES, STAR
from salescube.sources.snapshot import latest_partition, read_dump, read_snapshot, snapshot_path, write_snapshot
from salescube.sources.tables import append_sales, read_table, write_dimension
from salescube.sources.zstd_text import read_zstd

DIMENSIONS = {"calendar": CALENDAR, "base_sku": BASE_SKU, "base_sales_point": BASE_SALES_POINT}
FACT = "retail_sales"
CHOICES = ("all", "latest")


def choose_partitions(sales: DataFrame, which: str | int = "all") -> DataFrame:
    """All partitions, the latest, or those of one year."""
    if which == "all":
        return sales
    if which == "latest":
        return latest_partition(sales)
    if isinstance(which, int):
        return sales.where(F.col("month_year").between(F.lit(date(which, 1, 1)), F.lit(date(which, 12, 31))))
    raise InputError(f"unknown choice of partitions {which!r}, expected one of {CHOICES} or a year")


def take_snapshot(
    tables: dict[str, DataFrame],
    root: str,
    taken: date,
    which: str | int = "all",
    fmt: str = "parquet",
) -> dict[str, str]:
    """Copy the raw sales partitions and the dimensions to dated directories; returns their paths."""
    paths = {}
    for name, df in tables.items():
        paths[name] = snapshot_path(root, name, taken)
        if name == FACT:
            write_snapshot(choose_partitions(df, which), paths[name], "month_year", fmt)
        else:
            write_snapshot(df, paths[name], None, fmt=fmt)
    return paths


def load_star(
    spark: SparkSession,
    sales: str | list[str],
    dimensions: dict[str, str],
    target: str,
    fmt: str = "parquet",
) -> dict[str, DataFrame]:
    """Load dimensions and sales into the warehouse at `target` and return its tables.

    All sales files are read in one job, whatever their number; the columns the star does not hold are not parsed.
    """
    read = {"parquet": read_snapshot, "csv": read_dump, "zst": read_zstd}[fmt]
    target = target.rstrip("/")
    for name, path in dimensions.items():
        write_dimension(read(spark, path, DIMENSIONS[name]), f"{target}/{name}", DIMENSIONS[name])
    pruned = {"columns": RETAIL_SALES.fieldNames()} if fmt == "zst" else {}  # the other readers prune by themselves
    append_sales(read(spark, sales, RAW_PARTITION, **pruned), f"{target}/{FACT}")
    return {name: read_table(spark, f"{target}/{name}", STAR[name]) for name in [FACT, *dimensions]}
