"""The loaded warehouse: star tables, views over them, and results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescube.operators.checks import InputError, four_places, not_null
from salescube.schemas import RETAIL_SALES, ROLLUP


def append_sales(raw: DataFrame, path: str) -> None:
    """Prune raw partition rows to the fact's columns, reject nulls and roubles with more than four decimals, append by month.

    Rows are gathered by month, so that a task does not open a file in every month; adaptive execution splits a month by its
    bytes, so that one with a third of all rows is not written by one task.
    """
    fact = four_places(not_null(raw.select(*RETAIL_SALES.fieldNames()), RETAIL_SALES), "sales_rub")
    (
        fact.hint("rebalance", "month_year")
        .write.mode("append")
        .option("compression", "zstd")
        .partitionBy("month_year")
        .parquet(path)
    )


def write_dimension(df: DataFrame, path: str, schema: T.StructType) -> None:
    """Replace a dimension with checked, typed rows; a weight has four decimals at most."""
    four_places(not_null(df, schema), *{"weight"} & set(schema.fieldNames())).write.mode("overwrite").option("compression", "zstd").parquet(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def register_views(tables: dict[str, DataFrame]) -> None:
    """Make tables available to SQL by name."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def store_view(stores: DataFrame, mapping: DataFrame, column: str) -> DataFrame:
    """Stores with a reporting name from a mapping (format, corporate centre), else their own network's name."""
    named = mapping.select("global_pos_code", F.col(column).alias("__mapped"))
    return stores.join(named, "global_pos_code", "left").select(
        "global_pos_code", F.coalesce("__mapped", "network_subname").alias("network_subname_alt")
    )


def weight_category_view(skus: DataFrame, bounds: list[tuple[float, str]]) -> DataFrame:
    """Product codes with the name of their weight class; bounds are (upper limit in grams, name), ascending."""
    named = F.lit(None).cast("string")
    for limit, name in reversed(bounds):
        named = F.when(F.col("weight") <= limit, F.lit(name)).otherwise(named)
    return skus.select("global_sku_code", "weight", named.alias("weight_category"))


def insert_aligned(df: DataFrame, target: T.StructType = ROLLUP) -> DataFrame:
    """Columns of the target table, by name and in its order, with its types."""
    missing = sorted(set(target.fieldNames()) - set(df.columns))
    if missing:
        raise InputError(f"columns missing for the target table: {missing}")
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in target.fields])


def write_results(frames: dict[str, DataFrame], root: str) -> None:
    """One Parquet table per named result."""
    for name, df in frames.items():
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{root.rstrip('/')}/{name}")
