"""Exact active-store counts that roll up: stored sets of stores instead of stored counts.

A count of distinct stores cannot be added up over months or products, so the rollup's monthly `akb` says nothing about a quarter. Here
every month, network and product level keeps the set itself: stores get dense numbers, and a row holds 64 of them as the bits of
one whole number. Sets are united by a bitwise or, which Spark combines map-side in hash aggregates, and counted by their bits; any
coarser period, product level or network comes from the stored rows without another look at the sales.

Rows of 64 stores, not blocks of 32,768 (as Spark's bitmap aggregates build them), since most product rows have a handful of stores:
a block takes 4 kB whatever it holds. A set of a million stores is 15,625 rows and never one value. Numbers run by network, so the
stores of a network share words.
"""

from __future__ import annotations

from collections.abc import Collection
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescube.functions.sizing import small_tasks
from salescube.operators.prefix import ranked
from salescube.operators.star import PRODUCT_NUMBERS, level_texts, product_numbers, star_join, store_dimension
from salescube.schemas import GROUP, PRODUCER, ROLLUP, ROW_KEYS, SKU, TOTAL
from salescube.sources.scratch import stage
from salescube.sources.slices import SliceTable
from salescube.sources.tables import insert_aligned

WORD = 64
SLICE = ["report_date", "network_name"]
_SLICE_KEYS = [*SLICE, "network_subname"]
STORE_WORDS = T.StructType(
    [f for f in ROLLUP.fields if f.name in {*_SLICE_KEYS, *ROW_KEYS, "level"}]
    + [T.StructField("word", T.IntegerType(), False), T.StructField("stores", T.LongType(), False)]
)


def store_numbers(stores: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """global_pos_code and store_no, from 0 without gaps, by network. Numbers already given stay; new stores follow them."""
    new = stores.select("network_name", "global_pos_code")
    start = F.lit(0)
    if known is not None:
        new = new.join(known.select("global_pos_code"), "global_pos_code", "left_anti")
        start = known.agg((F.coalesce(F.max("store_no"), F.lit(-1)) + 1).alias("n")).scalar()
    order = [F.col("network_name"), F.col("global_pos_code")]
    placed = ranked(new, [], order, "place", ["global_pos_code"])
    numbered = placed.select("global_pos_code", (F.col("place") - 1 + start).cast("long").alias("store_no"))
    return numbered if known is None else known.select("global_pos_code", "store_no").unionByName(numbered)


def store_words(
    fact: DataFrame,
    skus: DataFrame,
    stores: DataFrame,
    networks: DataFrame,
    numbers: DataFrame,
    *,
    months: tuple[date, date] | None = None,
    chains: list[str] | None = None,
) -> DataFrame:
    """Sets of active stores by month, network and each product level, for the same rows as the rollup.

    Rows travel under numbers of their product keys until they are finished. Each level is united from the one below, so only the
    product rows are as many as the sales; they are staged, since two levels of the result read them.
    """
    if months is not None:
        fact = fact.where(F.col("month_year").between(*months))
    if chains is not None:
        fact = fact.where(F.col("network_name").isin(chains))
    small_tasks(fact.sparkSession)
    sold = fact.select("month_year", "global_sku_code", "global_pos_code").distinct()
    places = store_dimension(stores, networks, "network_name").join(numbers, "global_pos_code")
    codes, texts = product_numbers(skus)
    joined = star_join(sold, codes.select("global_sku_code", *PRODUCT_NUMBERS), places)
    rows = joined.select(
        F.col("month_year").alias("report_date"), "network_name", F.col("network_subname_alt").alias("network_subname"), *PRODUCT_NUMBERS,
        F.floor(F.col("store_no") / WORD).cast("int").alias("word"),
        F.expr(f"shiftleft(1L, cast(store_no % {WORD} as int))").alias("bit"),
    )
    united_stores = F.bit_or("stores").alias("stores")
    products = stage(rows.groupBy(*_SLICE_KEYS, *PRODUCT_NUMBERS, "word").agg(F.bit_or("bit").alias("stores")), "store-words")
    producers = products.groupBy(*_SLICE_KEYS, "group_no", "producer_no", "word").agg(united_stores)
    level = F.col("level")
    number = F.when(level == PRODUCER, F.col("producer_no")).when(level == GROUP, F.col("group_no"))
    upper = (
        producers.withColumn("level", F.explode(F.array(F.lit(TOTAL), F.lit(GROUP), F.lit(PRODUCER))))
        .groupBy(*_SLICE_KEYS, "level", number.alias("number"), "word")
        .agg(united_stores)
    )
    lowest = products.select(*_SLICE_KEYS, F.lit(SKU).alias("level"), F.col("row_no").alias("number"), "word", "stores")
    cube = level_texts(lowest.unionByName(upper), texts)
    return cube.withColumn("weight", F.coalesce(F.col("weight").cast("double"), F.lit(0.0)))


def united(words: DataFrame, period: Column, keys: list[str]) -> DataFrame:
    """Sets over longer periods or coarser keys: `period` replaces the month; rows of one level only, if the level is no key."""
    return words.select(period.alias("period"), *keys, "word", "stores").groupBy("period", *keys, "word").agg(F.bit_or("stores").alias("stores"))


def counted(sets: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct stores of each set."""
    return sets.groupBy("period", *keys).agg(F.sum(F.bit_count("stores")).alias("akb"))


def counts(words: DataFrame, period: Column, keys: list[str] | None = None) -> DataFrame:
    """Active stores by period and keys (by default: network, reporting network and product row of every level)."""
    keys = [*_SLICE_KEYS[1:], *ROW_KEYS, "level"] if keys is None else keys
    return counted(united(words, period, keys), keys)


def quarter(month: Column) -> Column:
    return F.trunc(month, "quarter")


def year(month: Column) -> Column:
    return F.trunc(month, "year")


def trailing(words: DataFrame, months: int, keys: list[str] | None = None) -> DataFrame:
    """Active stores in the `months` months up to each month (a store counts once, whenever it was active in them).

    A month's set goes to the periods that it belongs to, so rows grow by `months`, not by the square of the months.
    """
    keys = [*_SLICE_KEYS[1:], *ROW_KEYS, "level"] if keys is None else keys
    last = words.agg(F.max("report_date").alias("last")).scalar()
    ends = F.sequence(F.col("report_date"), F.least(F.add_months("report_date", months - 1), last), F.expr("interval 1 month"))
    spread = words.select(F.explode(ends).alias("end"), *keys, "word", "stores")
    return counted(united(spread, F.col("end"), keys), keys)


def table(spark: SparkSession, path: str) -> SliceTable:
    """The stored sets, in the same slices as the rollup."""
    return SliceTable(spark, path, SLICE, STORE_WORDS)


def store(words: DataFrame, path: str, requested: Collection[tuple] | None = None, may_be_empty: bool | Collection[tuple] = False) -> int:
    """Replace slices of the stored sets; returns the version."""
    return table(words.sparkSession, path).replace(insert_aligned(words, STORE_WORDS), requested, may_be_empty)
