"""The star join: narrow, fold, then look the dimensions up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescube.functions.measures import exact
from salescube.functions.sizing import bounded_broadcast
from salescube.operators.prefix import join_null_safe
from salescube.schemas import GROUP, GROUP_KEYS, PRODUCER, ROW_KEYS, SKU
from salescube.sources.scratch import stage

#: Numbers of a product's group, producer and row, outermost first.
PRODUCT_NUMBERS = ["group_no", "producer_no", "row_no"]


def fold_sales(fact: DataFrame, *keys: str, counted: bool = False) -> DataFrame:
    """Sum pieces and roubles by the given key columns; `counted` adds the number of sales rows.

    Runs before any dimension join, so the first shuffle carries a few narrow columns, is combined map-side, and
    spreads a hot product over its stores and a hot store over its products.
    """
    return fact.groupBy(*keys).agg(
        F.sum(F.col("pieces").cast("long")).alias("pieces"),
        F.sum(exact("sales_rub")).alias("sales_rub"),
        *([F.count(F.lit(1)).alias("sales_rows")] if counted else []),
    )


def store_dimension(stores: DataFrame, networks: DataFrame, *columns: str) -> DataFrame:
    """Stores with their reporting network; a store missing from either table is left out. Networks are measured first."""
    (named,) = bounded_broadcast(networks.select("global_pos_code", "network_subname_alt"))
    return stores.select("global_pos_code", *columns).join(named, "global_pos_code", "inner")


def star_join(sales: DataFrame, skus: DataFrame, stores: DataFrame) -> DataFrame:
    """Inner joins to products and stores; each dimension is broadcast only below the measured bound."""
    skus, stores = bounded_broadcast(skus, stores)
    return sales.join(skus, "global_sku_code", "inner").join(stores, "global_pos_code", "inner")


def product_numbers(skus: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Products with the numbers of their group, producer and row, and the texts by row number.

    Equal product keys share a number, nulls included. A producer and a group go by the least number of their rows, so the
    texts of that row are theirs too.
    """
    texts = stage(skus.select(*ROW_KEYS).distinct().withColumn("row_no", F.monotonically_increasing_id()), "product-rows")
    producers = texts.groupBy(*GROUP_KEYS, "producer").agg(F.min("row_no").alias("producer_no"))
    groups = producers.groupBy(*GROUP_KEYS).agg(F.min("producer_no").alias("group_no"))
    numbers = join_null_safe(join_null_safe(texts, producers, [*GROUP_KEYS, "producer"]), groups, GROUP_KEYS)
    return stage(join_null_safe(skus.select("global_sku_code", *ROW_KEYS), numbers, ROW_KEYS), "product-numbers"), texts


def level_texts(numbered: DataFrame, texts: DataFrame) -> DataFrame:
    """Rows of all levels (`level`, `number`; a total has no number) with the product keys that their level shows, the others null."""
    (texts,) = bounded_broadcast(texts.withColumnRenamed("row_no", "number"))
    shown = {**dict.fromkeys(GROUP_KEYS, GROUP), "producer": PRODUCER}
    keys = {k: F.when(F.col("level") >= shown.get(k, SKU), F.col(k)) for k in ROW_KEYS}
    return numbered.join(texts, "number", "left").withColumns(keys).drop("number")


def slice_extract(fact: DataFrame, month: Column, network: Column) -> DataFrame:
    """The five columns a rollup needs, for one month and network; the month prunes partitions."""
    return fact.where((F.col("month_year") == month) & (F.col("network_name") == network)).select(
        "month_year", "global_sku_code", "global_pos_code", "pieces", "sales_rub"
    )


def in_dates(df: DataFrame, column: str, first: Column, last: Column) -> DataFrame:
    """Rows whose date lies in [first, last]."""
    return df.where(F.col(column).between(first, last))


def sku_names(skus: DataFrame) -> DataFrame:
    """One name per product code, the first in text order."""
    return skus.groupBy("global_sku_code").agg(F.min("global_sku_name").alias("sku_name"))
