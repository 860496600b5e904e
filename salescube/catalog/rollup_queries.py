"""Queries of the load, check and rollup jobs."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescube.catalog.star import Star, fine_star, table
from salescube.functions.dates import month_starts, mondays, weeks_between
from salescube.functions.measures import as_doubles
from salescube.operators import checks, losses
from salescube.operators.star import sku_names, slice_extract
from salescube.plans import active_stores, rollup, warehouse
from salescube.schemas import BASE_SALES_POINT, BASE_SKU, CALENDAR, RETAIL_SALES, SKU, TOTAL
from salescube.sources import snapshot, tables
from salescube.sources.scratch import new_path, stage
from salescube.sources.zstd_text import read_zstd

TAKEN = date(2024, 1, 10)
MONTH, NEXT_MONTH = date(1995, 3, 1), date(1995, 4, 1)
NETWORK = "ASIA"


def build_rollup(star: Star, **options) -> DataFrame:
    return rollup.build(star.fact, star.base_sku, star.base_sales_point, star.networks, **options)


def stored_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rollup as reports find it: a written table."""
    return stage(build_rollup(fine_star(spark, sf_dir)), "rollup")


def rollup_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_rollup(fine_star(spark, sf_dir))


def rollup_variant_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without the wholesale channel."""
    return build_rollup(
        fine_star(spark, sf_dir), where=F.col("store_format") != "wholesale", store_columns=("store_format",)
    )


def rollup_variant_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each network as a whole, not by its sub-networks."""
    return build_rollup(fine_star(spark, sf_dir), subname=F.col("network_name"))


def rollup_variant_regrouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By corporate centre, through another store mapping."""
    star = fine_star(spark, sf_dir)
    star.networks = tables.store_view(star.base_sales_point, star.base_sales_point, "corp_centre")
    return build_rollup(star)


def _gappy(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, losses.Split]:
    """The rollup while heavy products, wholesale stores and the stores of one network still lack their entries."""
    star = fine_star(spark, sf_dir)
    reported = star.base_sales_point.where(F.col("network_name") != NETWORK).select("global_pos_code")
    return rollup.build_split(
        star.fact, star.base_sku.where("weight <= 4000"), star.base_sales_point.where("store_format <> 'wholesale'"),
        star.networks.join(reported, "global_pos_code", "left_semi"),
    )


def join_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales by month and by the dimensions that lack them, beside what the rollup holds."""
    return as_doubles(losses.balance(_gappy(spark, sf_dir)[1]))


def missing_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes without an entry, with the sales they hold back."""
    return as_doubles(losses.missing_codes(_gappy(spark, sf_dir)[1]))


def rollup_of_matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rollup of the same pass, from the sales that every dimension knows."""
    return _gappy(spark, sf_dir)[0]


def slice_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store all slices, rewrite those of one network, read everything back."""
    star = fine_star(spark, sf_dir)
    table = rollup.slice_table(spark, new_path(spark, "dp-agg"))
    table.replace(tables.insert_aligned(rollup.stamped(build_rollup(star))))
    own = star.base_sales_point.where(F.col("network_name") == NETWORK)
    again = rollup.build(star.fact, star.base_sku, own, star.networks)
    stored = {k for k in table.manifest().slices if k[1] == NETWORK}
    table.replace(tables.insert_aligned(rollup.stamped(again)), stored)
    return table.read().drop("last_update")


def _job(spark: SparkSession, sf_dir: str) -> tuple:
    """What the monthly job works on: sales, dimensions, a new table, the period, the networks."""
    star = fine_star(spark, sf_dir)
    fact = stage(star.full_fact, "sales")
    chains = sorted(r.network_name for r in star.base_sales_point.select("network_name").distinct().collect())
    first, last = fact.agg(F.min("month_year"), F.max("month_year")).first()
    return fact, (star.base_sku, star.base_sales_point, star.networks), new_path(spark, "dp-agg"), (first, last, chains, chains)


def rollup_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly job with its checks: all months and networks once, then one month of one network again."""
    fact, dims, path, (first, last, chains, known) = _job(spark, sf_dir)
    rollup.refresh(fact, *dims, path, first, last, chains, known, may_be_empty=True)
    rollup.refresh(fact, *dims, path, MONTH, MONTH, [NETWORK], known, may_be_empty=[(MONTH, NETWORK)])
    return rollup.read_rollup(spark, path).drop("last_update")


def slice_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly job for two months, after the sales of one network in one of them were withdrawn: that slice goes."""
    fact, dims, path, (first, last, chains, known) = _job(spark, sf_dir)
    rollup.refresh(fact, *dims, path, first, last, chains, known, may_be_empty=True)
    withdrawn = fact.where(~((F.col("month_year") == MONTH) & (F.col("network_name") == NETWORK)))
    rollup.refresh(withdrawn, *dims, path, MONTH, NEXT_MONTH, chains, known, may_be_empty=True)
    return rollup.read_rollup(spark, path).drop("last_update")


def rollup_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rollup kept up to date: all slices, then those alone whose sales changed or were withdrawn, then none."""
    fact, dims, path, (first, last, chains, known) = _job(spark, sf_dir)
    rollup.refresh_changed(fact, *dims, path, first, last, chains, known)
    here = (F.col("month_year") == MONTH) & (F.col("network_name") == NETWORK)
    there = (F.col("month_year") == NEXT_MONTH) & (F.col("network_name") == NETWORK)
    later = fact.where(~there).withColumn("pieces", F.when(here, F.col("pieces") + 1).otherwise(F.col("pieces")))
    for _ in range(2):
        rollup.refresh_changed(later, *dims, path, first, last, chains, known, may_be_empty=True)
    return rollup.read_rollup(spark, path).drop("last_update")


def slice_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One network in one month as a reader sees it before and after it was rewritten without the wholesale channel."""
    star = fine_star(spark, sf_dir)
    table = rollup.slice_table(spark, new_path(spark, "dp-agg"))
    months = {"months": (MONTH, NEXT_MONTH)}
    first = table.replace(tables.insert_aligned(rollup.stamped(build_rollup(star, **months))))
    retail = build_rollup(star, **months, where=F.col("store_format") != "wholesale", store_columns=("store_format",))
    last = table.replace(tables.insert_aligned(rollup.stamped(retail)), {k for k in table.manifest().slices}, may_be_empty=True)
    seen = [table.read(version, [(MONTH, NETWORK)]).withColumn("version", F.lit(version)) for version in (first, last)]
    return seen[0].unionByName(seen[1]).drop("last_update")


def _stored_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sets of active stores, stored by month and network; those of one network are made again with two more numbered stores."""
    star = fine_star(spark, sf_dir)
    first = active_stores.store_numbers(star.base_sales_point.where(F.col("network_name") != NETWORK))
    numbers = stage(active_stores.store_numbers(star.base_sales_point, stage(first, "numbers")), "numbers")
    path = new_path(spark, "store-sets")
    words = active_stores.store_words(star.fact, star.base_sku, star.base_sales_point, star.networks, numbers)
    active_stores.store(words, path)
    return active_stores.table(spark, path).read()


def active_stores_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rollup's store counts, from stored sets."""
    return active_stores.counts(_stored_sets(spark, sf_dir), F.col("report_date"))


def active_stores_by_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stores active in a quarter, at every product level, from the stored monthly sets."""
    return active_stores.counts(_stored_sets(spark, sf_dir), active_stores.quarter(F.col("report_date")))


def active_stores_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stores active in a year by whole network, category and producer: levels the monthly sets do not have."""
    products = _stored_sets(spark, sf_dir).where(F.col("level") == SKU)
    return active_stores.counts(products, active_stores.year(F.col("report_date")), ["network_name", "category", "producer"])


def active_stores_trailing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stores active in the three months up to each month, by reporting network."""
    totals = _stored_sets(spark, sf_dir).where(F.col("level") == TOTAL)
    return active_stores.trailing(totals, 3, ["network_name", "network_subname"])


def snapshot_of_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copy the sales of one year, picked by its month directories, and read the copy."""
    stored = new_path(spark, "sales")
    tables.append_sales(as_doubles(fine_star(spark, sf_dir).full_fact), stored)
    sales = tables.read_table(spark, stored, RETAIL_SALES)
    paths = warehouse.take_snapshot({"retail_sales": sales}, new_path(spark, "snapshot"), TAKEN, which=MONTH.year)
    return snapshot.read_snapshot(spark, paths["retail_sales"], RETAIL_SALES)


def views_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables as views under their names, and a statement over them: roubles by store format and weight class."""
    star = fine_star(spark, sf_dir)
    tables.register_views({
        "retail_sales": star.fact, "base_sku": star.base_sku, "base_sales_point": star.base_sales_point,
        "formats": store_format_view(spark, sf_dir), "weight_classes": weight_categories(spark, sf_dir),
    })
    return as_doubles(spark.sql("""
        SELECT f.network_subname_alt AS place, w.weight_category, count(*) AS row_count, sum(s.sales_rub) AS sales_rub
        FROM retail_sales s JOIN formats f USING (global_pos_code) JOIN weight_classes w USING (global_sku_code)
        GROUP BY ALL"""))


def slice_extracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rollup's input columns for one month and network of the stored sales, whose month directory alone is read."""
    stored = new_path(spark, "sales")
    tables.append_sales(as_doubles(fine_star(spark, sf_dir).full_fact), stored)
    return as_doubles(slice_extract(tables.read_table(spark, stored, RETAIL_SALES), F.lit(MONTH), F.lit(NETWORK)))


def slice_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.slice_counts(fine_star(spark, sf_dir).full_fact)


def month_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month starts between each store's first and last day of sales."""
    span = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        F.min("l_shipdate").cast("date").alias("first_day"), F.max("l_shipdate").cast("date").alias("last_day")
    )
    return month_starts(span, F.col("first_day"), F.col("last_day"))


def week_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many Mondays as each store has weeks with sales, from its first day of sales on."""
    span = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        F.min("l_shipdate").cast("date").alias("first_day"),
        F.count_distinct(F.date_trunc("week", "l_shipdate")).cast("int").alias("weeks"),
    )
    return mondays(span, F.col("first_day"), F.col("weeks"))


def week_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh day from each store's first to its last day of sales."""
    span = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        F.min("l_shipdate").cast("date").alias("first_day"), F.max("l_shipdate").cast("date").alias("last_day")
    )
    return weeks_between(span, F.col("first_day"), F.col("last_day"))


def network_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The networks to choose from, read from the stored rollup."""
    return checks.network_names(stored_rollup(spark, sf_dir))


def dim_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of the fact (at its week grain) and of every dimension."""
    star = fine_star(spark, sf_dir)
    return checks.dimension_profile({
        "retail_sales": (
            star.fact, ["week_start_date", "global_sku_code", "global_pos_code"], ["pieces", "sales_rub"]
        ),
        "base_sku": (star.base_sku, ["global_sku_code"], ["category", "group", "weight"]),
        "base_sku_by_name": (star.base_sku, ["global_sku_name"], ["global_sku_name"]),
        "base_sales_point": (star.base_sales_point, ["global_pos_code"], ["network_name"]),
        "networks": (star.networks, ["global_pos_code"], ["network_subname_alt"]),
    })


def network_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales booked under the customer's region, against the region of the store."""
    star = fine_star(spark, sf_dir)
    regions = table(spark, sf_dir, "nation").join(
        F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey")
    )
    booked = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(F.broadcast(regions), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("l_suppkey").cast("string").alias("global_pos_code"), F.col("r_name").alias("network_name"))
    )
    return checks.network_mismatch(booked, star.base_sales_point)


def sku_name_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return sku_names(part.select(F.col("p_brand").alias("global_sku_code"), F.col("p_name").alias("global_sku_name")))


def store_format_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wholesale stores under their format, all others under their own network."""
    stores = fine_star(spark, sf_dir).base_sales_point
    wholesale = stores.where(F.col("store_format") == "wholesale")
    return tables.store_view(stores, wholesale, "store_format")


def weight_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    skus = fine_star(spark, sf_dir).base_sku
    return tables.weight_category_view(skus, [(1000, "light"), (3000, "medium")])


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw partition rows: the star's sales with the columns a source system adds."""
    fact = fine_star(spark, sf_dir).full_fact
    week = F.col("week_start_date")
    return fact.select(
        F.year(week).alias("year"),
        F.weekofyear(week).alias("week"),
        "network_name",
        "network_subname",
        F.concat(F.lit("K-"), "global_sku_code").alias("sku_code"),
        "global_sku_code",
        F.concat(F.lit("S;"), "global_pos_code").alias("pos_code"),
        "global_pos_code",
        "pieces",
        F.col("sales_rub").cast("double").alias("sales_rub"),
        F.lit(None).cast("string").alias("alt_sku"),
        "week_start_date",
        F.month(week).alias("month"),
        F.concat(F.lit('weekly "'), F.col("network_name"), F.lit('".xlsx')).alias("file"),
        week.cast("timestamp_ntz").alias("created"),
        F.lit("sheet").alias("sheet"),
        F.lit(1).alias("file_id"),
        "month_year",
    )


def source_dimensions(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The dimensions with all columns of a source system."""
    star = fine_star(spark, sf_dir)
    no_change = F.lit(None).cast("timestamp_ntz").alias("change")
    skus = star.base_sku.select(
        "global_sku_code",
        F.lit("any").alias("network_name"),
        F.concat(F.lit("K-"), "global_sku_code").alias("sku_code"),
        F.lit(None).cast("string").alias("barcode"),
        F.col("global_sku_name").alias("sku_name"),
        "global_sku_name", "category", "segment", "group", "brand", "producer", "weight",
        no_change,
    )
    stores = star.base_sales_point.select(
        "global_pos_code",
        "network_name",
        F.concat(F.lit("S;"), "global_pos_code").alias("pos_code"),
        F.concat(F.lit('"'), "global_pos_code", F.lit('" store')).alias("pos_name"),
        F.lit("address").alias("store_address"),
        "store_format",
        "network_subname",
        F.lit("district").alias("district"),
        F.col("network_name").alias("region"),
        F.lit("city").alias("city"),
        no_change,
    )
    week = F.col("week_start_date")
    calendar = star.fact.select(week).distinct().select(
        F.weekofyear(week).alias("week"),
        F.month(week).alias("month"),
        F.year(week).alias("year"),
        F.month(F.date_add(week, 3)).alias("month_upr"),
        F.year(F.date_add(week, 3)).alias("year_upr"),
        week,
        F.date_add(week, 6).alias("week_end_date"),
        F.trunc(week, "month").alias("month_date"),
        F.trunc(F.date_add(week, 3), "month").alias("month_upr_date"),
    )
    return {"calendar": calendar, "base_sku": skus, "base_sales_point": stores}


def snapshot_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copy all partitions of the sales to a dated snapshot and read it back."""
    fact = as_doubles(fine_star(spark, sf_dir).full_fact)
    paths = warehouse.take_snapshot({"retail_sales": fact}, new_path(spark, "snapshot"), TAKEN)
    return snapshot.read_snapshot(spark, paths["retail_sales"], RETAIL_SALES)


def _loaded(spark: SparkSession, sf_dir: str, fmt: str) -> dict[str, DataFrame]:
    source = {"retail_sales": raw_sales(spark, sf_dir), **source_dimensions(spark, sf_dir)}
    paths = warehouse.take_snapshot(source, new_path(spark, "dump"), TAKEN, fmt=fmt)
    sales = paths.pop("retail_sales")
    return warehouse.load_star(spark, sales, paths, new_path(spark, "warehouse"), fmt=fmt)


def warehouse_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dump all source tables as text, load the star, read the sales."""
    return _loaded(spark, sf_dir, "csv")["retail_sales"]


def zstd_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dump all source tables as Zstandard text, a file per month and task, load the star from the dumps, read the sales."""
    return _loaded(spark, sf_dir, "zst")["retail_sales"]


def zstd_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stores, whose texts hold separators and quotes, dumped as Zstandard text and read back with all columns."""
    source = {"base_sales_point": source_dimensions(spark, sf_dir)["base_sales_point"]}
    paths = warehouse.take_snapshot(source, new_path(spark, "dump"), TAKEN, fmt="zst")
    return read_zstd(spark, paths["base_sales_point"], BASE_SALES_POINT)


def warehouse_skus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load_dimension(spark, sf_dir, "base_sku", BASE_SKU)


def warehouse_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load_dimension(spark, sf_dir, "base_sales_point", BASE_SALES_POINT)


def warehouse_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load_dimension(spark, sf_dir, "calendar", CALENDAR)


def _load_dimension(spark: SparkSession, sf_dir: str, name: str, schema) -> DataFrame:
    source = {name: source_dimensions(spark, sf_dir)[name]}
    paths = warehouse.take_snapshot(source, new_path(spark, "dump"), TAKEN, fmt="csv")
    target = new_path(spark, "warehouse")
    tables.write_dimension(snapshot.read_dump(spark, paths[name], schema), target, schema)
    return tables.read_table(spark, target, schema)


def partition_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months of the sales in calendar order, with the dump name of each and the number it sorts by."""
    listed = snapshot.partitions(fine_star(spark, sf_dir).fact)
    month = F.col("month_year")
    named = listed.withColumn(
        "file_name",
        F.concat(
            F.lit("retail_sales_y"), F.year(month).cast("string"), F.lit("m"), F.month(month).cast("string"),
            F.lit("_2024-01-10.zst"),
        ),
    )
    number = snapshot.partition_number(F.col("file_name"))
    return named.withColumn("partition_number", number).orderBy("partition_number")


def partition_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest partition alone, the default choice of a snapshot."""
    return as_doubles(snapshot.latest_partition(fine_star(spark, sf_dir).fact))


QUERIES = {
    "rollup_grouping_sets": rollup_grouping_sets,
    "rollup_variant_filtered": rollup_variant_filtered,
    "rollup_variant_whole": rollup_variant_whole,
    "rollup_variant_regrouped": rollup_variant_regrouped,
    "join_losses": join_losses,
    "missing_codes": missing_codes,
    "rollup_of_matched": rollup_of_matched,
    "slice_replace": slice_replace,
    "rollup_refresh": rollup_refresh,
    "slice_delete": slice_delete,
    "rollup_incremental": rollup_incremental,
    "slice_versions": slice_versions,
    "active_stores_monthly": active_stores_monthly,
    "active_stores_by_quarter": active_stores_by_quarter,
    "active_stores_by_year": active_stores_by_year,
    "active_stores_trailing": active_stores_trailing,
    "snapshot_of_year": snapshot_of_year,
    "views_sql": views_sql,
    "slice_extract": slice_extracts,
    "slice_counts": slice_counts,
    "month_series": month_series,
    "week_series": week_series,
    "week_steps": week_steps,
    "network_list": network_list,
    "dim_checks": dim_checks,
    "network_mismatch": network_mismatch,
    "sku_name_lookup": sku_name_lookup,
    "store_format_view": store_format_view,
    "weight_categories": weight_categories,
    "snapshot_roundtrip": snapshot_roundtrip,
    "warehouse_sales": warehouse_sales,
    "zstd_roundtrip": zstd_roundtrip,
    "zstd_stores": zstd_stores,
    "warehouse_skus": warehouse_skus,
    "warehouse_stores": warehouse_stores,
    "warehouse_calendar": warehouse_calendar,
    "partition_list": partition_list,
    "partition_latest": partition_latest,
}
