"""Queries of the price elasticity study, over all weeks of the sales and every product and network."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescube.catalog.star import Star, coarse_star, table
from salescube.functions.measures import as_doubles
from salescube.plans import elasticity, ped_states
from salescube.plans.ped_windows import Windows
from salescube.sources import tables
from salescube.sources.scratch import new_path, stage

# Prices of the test tables run from 20 to 105,000 per kilogram.
WIDTH = 500
PRODUCTS = ["Brand#11", "Brand#23"]
NETWORKS = ["ASIA", "EUROPE"]
# Windows of two years; fewer store-weeks than the whole span has, so wider bins.
WINDOW_WEEKS = 104
WINDOW_WIDTH = 5_000


@dataclass
class Study:
    """The star and the window of weeks that covers all its sales."""

    star: Star
    start: date
    weeks: int

    @property
    def inputs(self):
        star = self.star
        return star.fact, star.base_sku, star.base_sales_point, star.networks, self.start, self.weeks

    def weekly(self) -> DataFrame:
        return elasticity.store_weeks(*self.inputs, width=WIDTH)

    def flagged(self) -> DataFrame:
        return elasticity.flagged(self.weekly(), self.weeks, width=WIDTH)

    def levels(self, **options) -> DataFrame:
        return elasticity.price_levels(self.flagged(), self.weeks, **options)

    def points(self) -> DataFrame:
        return elasticity.price_points(self.levels(), WIDTH)


def study(spark: SparkSession, sf_dir: str) -> Study:
    star = coarse_star(spark, sf_dir)
    week = F.date_trunc("week", "l_shipdate").cast("date")
    span = table(spark, sf_dir, "lineitem").agg(F.min(week).alias("first"), F.max(week).alias("last")).first()
    return Study(star, span["first"], (span["last"] - span["first"]).days // 7 + 1)


def store_week_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_doubles(study(spark, sf_dir).weekly())


def store_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = study(spark, sf_dir)
    return as_doubles(elasticity.store_list(s.weekly(), s.weeks))


def store_kept_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_doubles(study(spark, sf_dir).flagged().drop("price_kg", "price_bin"))


def semi_join_kept_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = study(spark, sf_dir)
    weekly = stage(s.weekly(), "store-weeks")
    return as_doubles(elasticity.kept_sales(weekly, elasticity.store_list(weekly, s.weeks)))


def anti_join_dropped_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = study(spark, sf_dir)
    weekly = stage(s.weekly(), "store-weeks")
    return as_doubles(elasticity.dropped_sales(weekly, elasticity.store_list(weekly, s.weeks)))


def price_bins_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_doubles(elasticity.weekly_prices(study(spark, sf_dir).flagged()))


def price_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_doubles(elasticity.kept_levels(study(spark, sf_dir).levels()))


def price_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = study(spark, sf_dir).points()
    return as_doubles(points.select(*elasticity.PAIR, "price_bin", "price_bin_range", "kg", "akb", "turnover"))


def price_points_kept_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage measured against kept stores, with the share of the SQL route."""
    s = study(spark, sf_dir)
    levels = s.levels(share=elasticity.COVERAGE_SHARE_KEPT, base="kept")
    points = elasticity.price_points(levels, WIDTH)
    return as_doubles(points.select(*elasticity.PAIR, "price_bin", "price_bin_range", "kg", "akb", "turnover"))


def price_points_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_doubles(elasticity.price_points_sql(*study(spark, sf_dir).inputs, width=WIDTH).orderBy(*elasticity.PAIR, "price_bin"))


def ped_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    fits = elasticity.fits(elasticity.placed(study(spark, sf_dir).levels(), WIDTH))
    return as_doubles(fits.drop("slope", "intercept"))


def ped_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_doubles(elasticity.predictions(study(spark, sf_dir).points()))


def ped_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = study(spark, sf_dir)
    return elasticity.summary(elasticity.fits(elasticity.placed(s.levels(), WIDTH)), s.star.base_sku, s.start, s.weeks)


def _written(spark: SparkSession, sf_dir: str, name: str, **options) -> DataFrame:
    """One table of the whole study, after all six have been written; results by name come back from their files."""
    s = study(spark, sf_dir)
    root = new_path(spark, "study")
    tables.write_results(elasticity.study(*s.inputs, width=WIDTH, **options), root)
    return as_doubles(spark.read.parquet(f"{root}/{name}"))


def study_store_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written(spark, sf_dir, "store_list")


def study_store_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written(spark, sf_dir, "store_weeks").drop("price_kg", "price_bin")


def study_weekly_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written(spark, sf_dir, "weekly_prices")


def study_price_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written(spark, sf_dir, "price_levels")


def study_price_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written(spark, sf_dir, "price_points")


def study_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written(spark, sf_dir, "results")


def study_of_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The price points of two products in two networks."""
    return _written(spark, sf_dir, "price_points", products=PRODUCTS, subnames=NETWORKS)


def price_points_sql_of_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SQL route for the same products and networks."""
    return as_doubles(elasticity.price_points_sql(*study(spark, sf_dir).inputs, width=WIDTH, products=PRODUCTS, subnames=NETWORKS))


def ped_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fits of pairs, products, networks and all together, read from the stored states of the pairs."""
    path = new_path(spark, "fit-states")
    ped_states.write_states(ped_states.states(study(spark, sf_dir).points()), path)
    return ped_states.all_fits(ped_states.read_states(spark, path))


def _windows(spark: SparkSession, sf_dir: str) -> Windows:
    s = study(spark, sf_dir)
    return Windows(elasticity.store_weeks(*s.inputs, width=WINDOW_WIDTH), s.start, s.weeks, WINDOW_WEEKS)


def kept_store_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The start weeks in whose windows each store is kept."""
    return _windows(spark, sf_dir).kept_spans()


def ped_by_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fits of every pair for every start week."""
    return as_doubles(_windows(spark, sf_dir).fits(WINDOW_WIDTH).drop("slope", "intercept"))


QUERIES = {
    "store_week_prices": store_week_prices,
    "store_activity": store_activity,
    "store_kept_flag": store_kept_flag,
    "semi_join_kept_stores": semi_join_kept_stores,
    "anti_join_dropped_stores": anti_join_dropped_stores,
    "price_bins_weekly": price_bins_weekly,
    "price_levels": price_levels,
    "price_points": price_points,
    "price_points_kept_base": price_points_kept_base,
    "price_points_sql": price_points_sql,
    "ped_fit": ped_fit,
    "ped_predictions": ped_predictions,
    "ped_summary": ped_summary,
    "study_store_list": study_store_list,
    "study_store_weeks": study_store_weeks,
    "study_weekly_prices": study_weekly_prices,
    "study_price_levels": study_price_levels,
    "study_price_points": study_price_points,
    "study_results": study_results,
    "study_of_products": study_of_products,
    "price_points_sql_of_products": price_points_sql_of_products,
    "ped_merged": ped_merged,
    "kept_store_spans": kept_store_spans,
    "ped_by_window": ped_by_window,
}
