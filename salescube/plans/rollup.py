"""Monthly rollup: four product levels by month and network, with exact active-store counts."""

from __future__ import annotations

from collections.abc import Collection
from datetime import date
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salescube.functions.dates import period_bounds
from salescube.functions.measures import grams, round_even
from salescube.functions.sizing import small_tasks
from salescube.operators.checks import InputError, require_clean, require_known, require_slices
from salescube.operators.fingerprint import marks, table_mark
from salescube.operators.losses import Split, split_sales
from salescube.operators.star import PRODUCT_NUMBERS, fold_sales, level_texts, product_numbers, star_join, store_dimension
from salescube.schemas import DIMENSION_KEYS, GROUP, GROUP_KEYS, PRODUCER, ROLLUP, ROW_KEYS, SKU, TOTAL
from salescube.sources.scratch import stage
from salescube.sources.slices import SliceTable
from salescube.sources.tables import insert_aligned

SLICE = ["report_date", "network_name"]
_SLICE_KEYS = [*SLICE, "network_subname"]
_FOLD_KEYS = ["month_year", "global_sku_code", "global_pos_code"]


def build(
    fact: DataFrame,
    skus: DataFrame,
    stores: DataFrame,
    networks: DataFrame,
    *,
    months: tuple[date, date] | None = None,
    chains: list[str] | None = None,
    where: Column | None = None,
    subname: Column | None = None,
    store_columns: tuple[str, ...] = (),
) -> DataFrame:
    """All requested months and networks in one plan.

    `where` keeps only some joined rows (for example all but the wholesale channel), `subname` replaces the
    reporting network (for example by the whole network); name in `store_columns` the store attributes they read.
    A different `networks` table regroups the stores (for example by corporate centre).

    Shuffles: the fold, the months of each store, the product rows, those once more by group; all rows are numbers and
    short names. The product rows are staged, since all levels of the result read them. One task adds up a group in a month and
    network: as many rows as products of the group sold there.
    """
    folded = fold_sales(_requested(fact, months, chains), *_FOLD_KEYS)
    return _cube(folded, skus, stores, networks, where, subname, store_columns)


def build_split(
    fact: DataFrame,
    skus: DataFrame,
    stores: DataFrame,
    networks: DataFrame,
    *,
    months: tuple[date, date] | None = None,
    chains: list[str] | None = None,
    where: Column | None = None,
    subname: Column | None = None,
    store_columns: tuple[str, ...] = (),
) -> tuple[DataFrame, Split]:
    """The rollup, and the folded sales behind it with what the joins left out (`operators.losses`); the sales are read once."""
    split = split_sales(fold_sales(_requested(fact, months, chains), *_FOLD_KEYS, counted=True), skus, stores, networks)
    return _cube(split.kept, skus, stores, networks, where, subname, store_columns), split


def _requested(fact: DataFrame, months: tuple[date, date] | None, chains: list[str] | None) -> DataFrame:
    if months is not None:
        fact = fact.where(F.col("month_year").between(*months))
    if chains is not None:
        fact = fact.where(F.col("network_name").isin(chains))
    return fact


def _cube(
    folded: DataFrame,
    skus: DataFrame,
    stores: DataFrame,
    networks: DataFrame,
    where: Column | None,
    subname: Column | None,
    store_columns: tuple[str, ...],
) -> DataFrame:
    """The four levels over folded sales.

    Rows travel under numbers of their product keys; the texts are looked up once, for finished rows. Sorted by number, the
    sales of one store in one month and network tell which of them is the first of its product row, producer, group and
    network, so each level's distinct stores are a sum of such firsts, and the upper levels are added up from the product rows.
    """
    small_tasks(folded.sparkSession)
    codes, texts = product_numbers(skus)
    read = [k for k in ROW_KEYS if k == "weight" or not (where is None and subname is None)]
    joined = star_join(
        folded, codes.select("global_sku_code", *PRODUCT_NUMBERS, *read), store_dimension(stores, networks, "network_name", *store_columns)
    )
    if where is not None:
        joined = joined.where(where)
    rows = joined.select(
        F.col("month_year").alias("report_date"),
        "network_name",
        (F.col("network_subname_alt") if subname is None else subname).alias("network_subname"),
        *PRODUCT_NUMBERS,
        "weight",
        "global_pos_code",
        "pieces",
        "sales_rub",
    )
    store = Window.partitionBy(*_SLICE_KEYS, "global_pos_code").orderBy(*PRODUCT_NUMBERS)
    first_of = F.when(F.lag("row_no").over(store).isNull(), F.lit(TOTAL))
    for level, number in zip((GROUP, PRODUCER, SKU), PRODUCT_NUMBERS, strict=True):
        first_of = first_of.when(F.lag(number).over(store) != F.col(number), F.lit(level))
    products = stage(
        rows.withColumn("first_of", first_of)
        .groupBy(*_SLICE_KEYS, *PRODUCT_NUMBERS, "weight")
        .agg(
            F.sum("pieces").alias("pieces"),
            F.sum("sales_rub").alias("sales_rub"),
            *[F.count_if(F.col("first_of") <= level).alias(f"akb_{level}") for level in (TOTAL, GROUP, PRODUCER, SKU)],
        )
        .withColumn("grams", grams("pieces", "weight", digits=18)),
        "rollup-products",
    )
    sums = ("pieces", "grams", "sales_rub")

    def added(rows: DataFrame, *keys: str | Column, levels: tuple[int, ...]) -> DataFrame:
        return rows.groupBy(*_SLICE_KEYS, *keys).agg(*[F.sum(c).alias(c) for c in (*sums, *[f"akb_{level}" for level in levels])])

    by_group = products.repartition(*_SLICE_KEYS, "group_no")  # producers and groups are added up from one shuffle
    producers = added(by_group, "group_no", "producer_no", levels=(GROUP, PRODUCER))
    level = F.explode(F.array(F.lit(GROUP), F.lit(PRODUCER))).alias("level")
    shown = F.when(F.col("level") == PRODUCER, F.col("producer_no"))
    middle = added(producers.select("*", level).withColumn("producer_no", shown), "group_no", "level", "producer_no", levels=(GROUP, PRODUCER))
    upper = middle.select(
        *_SLICE_KEYS,
        "level",
        F.coalesce("producer_no", "group_no").alias("number"),
        F.when(F.col("level") == PRODUCER, F.col(f"akb_{PRODUCER}")).otherwise(F.col(f"akb_{GROUP}")).alias("akb"),
        *sums,
    ).unionByName(
        added(products, levels=(TOTAL,)).select(
            *_SLICE_KEYS, F.lit(TOTAL).alias("level"), F.lit(None).cast("long").alias("number"), F.col(f"akb_{TOTAL}").alias("akb"), *sums
        )
    )
    lowest = products.select(
        *_SLICE_KEYS, F.lit(SKU).alias("level"), F.col("row_no").alias("number"), F.col(f"akb_{SKU}").alias("akb"), *sums
    )
    cube = level_texts(lowest.unionByName(upper), texts)
    return cube.select(
        *_SLICE_KEYS,
        *[k for k in ROW_KEYS if k != "weight"],
        F.coalesce(F.col("weight").cast("double"), F.lit(0.0)).alias("weight"),
        "level",
        "akb",
        "pieces",
        round_even(F.col("grams").cast("double") / 1000, 2).alias("kg"),
        round_even("sales_rub", 2).alias("sales_rub"),
    )


def stamped(rollup: DataFrame) -> DataFrame:
    """The rollup in the column order of its table, with the time of the run."""
    return rollup.withColumn("last_update", F.localtimestamp()).select(*ROLLUP.fieldNames())


def months_in(start: str | date, end: str | date) -> list[date]:
    """Month starts inside the period."""
    first, last = period_bounds(start, end)
    every = [date(n // 12, n % 12 + 1, 1) for n in range(first.year * 12 + first.month - 1, last.year * 12 + last.month)]
    return [m for m in every if first <= m]


def slice_table(spark: SparkSession, path: str) -> SliceTable:
    """The stored rollup: one slice per month and network, replaced and deleted in one step."""
    return SliceTable(spark, path, SLICE, ROLLUP)


def _checked(skus: DataFrame, stores: DataFrame, networks: DataFrame, start: str | date, end: str | date, chains: list[str], known: list[str]) -> list[date]:
    months = months_in(start, end)
    if not months:
        raise InputError(f"no month starts between {start} and {end}")
    require_known(chains, known)
    require_clean({
        "base_sku": (skus, DIMENSION_KEYS["base_sku"], ["global_sku_code"]),
        "base_sales_point": (stores, DIMENSION_KEYS["base_sales_point"], ["global_pos_code", "network_name"]),
        "networks": (networks, DIMENSION_KEYS["networks"], ["global_pos_code", "network_subname_alt"]),
    })
    return months


def refresh(
    fact: DataFrame,
    skus: DataFrame,
    stores: DataFrame,
    networks: DataFrame,
    path: str,
    start: str | date,
    end: str | date,
    chains: list[str],
    known_chains: list[str],
    may_be_empty: bool | Collection[tuple[date, str]] = False,
    **variant,
) -> int:
    """Recompute the requested months and networks, replace exactly those slices of the stored rollup, and return its version.

    Parameters and dimensions are checked first; every requested slice must have sales, and rows in the new rollup, unless
    `may_be_empty` (True, or the (month, network) pairs that may be): such a slice is deleted. All slices change in one step; nothing
    changes if anything is refused. A sale whose network differs from its store's network cannot leak into a slice that
    was not requested. `variant` takes the options of `build`; each variant has its own table.
    """
    months = _checked(skus, stores, networks, start, end, chains, known_chains)
    require_slices(fact, months, chains, may_be_empty)
    result = build(fact, skus, stores, networks, months=(months[0], months[-1]), chains=chains, **variant)
    table = slice_table(fact.sparkSession, path)
    return table.replace(insert_aligned(stamped(result)), set(product(months, chains)), may_be_empty)


def input_marks(fact: DataFrame, months: list[date], chains: list[str], dimensions: str, variant: str = "") -> dict[tuple, str]:
    """Per (month, network) with sales: a mark of all that its slice is made from. One scan of the six columns a rollup reads."""
    asked = fact.where(F.col("month_year").isin(months) & F.col("network_name").isin(chains))
    columns = ["global_sku_code", "global_pos_code", "pieces", "sales_rub"]
    found = marks(asked, ["month_year", "network_name"], columns).collect()
    return {(r["month_year"], r["network_name"]): f"{r['mark']}|{dimensions}|{variant}" for r in found}


def refresh_changed(
    fact: DataFrame,
    skus: DataFrame,
    stores: DataFrame,
    networks: DataFrame,
    path: str,
    start: str | date,
    end: str | date,
    chains: list[str],
    known_chains: list[str],
    may_be_empty: bool | Collection[tuple[date, str]] = False,
    **variant,
) -> list[tuple[date, str]]:
    """`refresh`, but only of the slices whose sales, dimensions or options differ from those they were made from.

    The marks of the input are kept in the manifest beside each slice. Slices whose sales are gone are deleted where
    `may_be_empty` allows it. Returns the slices that changed; without any, nothing is written and the version stays.
    Any change of a dimension recomputes all requested slices.
    """
    months = _checked(skus, stores, networks, start, end, chains, known_chains)
    table = slice_table(fact.sparkSession, path)
    own = ["global_pos_code", "network_name", *variant.get("store_columns", ())]
    dimensions = table_mark(
        skus.select("global_sku_code", *ROW_KEYS), stores.select(*own), networks.select("global_pos_code", "network_subname_alt")
    )
    now = input_marks(fact, months, chains, dimensions, str(sorted((k, str(v)) for k, v in variant.items())))
    stored = table.manifest().slices
    changed = {k for k, mark in now.items() if k not in stored or stored[k].mark != mark}
    gone = {k for k in product(months, chains) if k in stored and k not in now}
    if not changed | gone:
        return []
    pairs = fact.sparkSession.createDataFrame(sorted(changed), "month_year date, network_name string")
    picked = fact.where(F.col("month_year").isin(sorted({m for m, _ in changed}) or [None])).join(
        F.broadcast(pairs), ["month_year", "network_name"], "left_semi"  # one row per month and network
    )
    result = build(picked, skus, stores, networks, **variant)
    table.replace(insert_aligned(stamped(result)), changed | gone, may_be_empty, now)
    return sorted(changed | gone)


def read_rollup(spark: SparkSession, path: str, slices: Collection[tuple[date, str]] | None = None) -> DataFrame:
    """The stored rollup, or some of its slices."""
    return slice_table(spark, path).read(slices=slices)
