"""Price elasticity of demand for every product and network in one job.

Store-weeks are cleaned by store activity, binned by price, filtered by coverage, and fitted as a weighted log-log line.
One shuffle brings store-weeks together, one the weeks of a store; all later steps see a few price bins per pair.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescube.functions.dates import day_span, week_range
from salescube.functions.measures import grams, kilograms, ratio, round_even
from salescube.functions.sizing import bounded_broadcast
from salescube.functions.text import range_label, signed, thousands
from salescube.operators.regression import weighted_line
from salescube.operators.star import fold_sales, in_dates, sku_names, star_join, store_dimension
from salescube.sources.scratch import stage

# Thresholds of the study.
ACTIVE_SHARE = 0.25
COVERAGE_SHARE = 0.01
COVERAGE_SHARE_KEPT = 0.0067
BIN_WIDTH = 5

PAIR = ["network_subname", "global_sku_code"]
STORE = [*PAIR, "global_pos_code"]


def store_weeks(
    fact: DataFrame, skus: DataFrame, stores: DataFrame, networks: DataFrame, start: date, weeks: int,
    width: float = BIN_WIDTH, products: list[str] | None = None, subnames: list[str] | None = None,
) -> DataFrame:
    """Kilograms, roubles, price and price bin by product, store and week of the window.

    All products and reporting networks, or only the named ones; named products are filtered in the scan.
    """
    first, last = week_range(start, weeks)
    if products is not None:
        fact = fact.where(F.col("global_sku_code").isin(products))
    if subnames is not None:
        networks = networks.where(F.col("network_subname_alt").isin(subnames))
    sales = in_dates(fact, "week_start_date", F.lit(first), F.lit(last)).select(
        "week_start_date", "global_sku_code", "global_pos_code", "pieces", "sales_rub"
    )
    folded = fold_sales(sales, "week_start_date", "global_sku_code", "global_pos_code")
    joined = star_join(folded, skus.select("global_sku_code", "weight"), store_dimension(stores, networks))
    summed = joined.groupBy(
        F.col("network_subname_alt").alias("network_subname"), "global_sku_code", "week_start_date", "global_pos_code"
    ).agg(
        kilograms(F.sum(grams("pieces", "weight"))).alias("kg"),
        F.sum("sales_rub").alias("rub"),
    )
    price = ratio("rub", "kg")
    return summed.select(
        *PAIR,
        F.weekofyear("week_start_date").alias("wk_num"),
        "week_start_date",
        "global_pos_code",
        "kg",
        "rub",
        price.alias("price_kg"),
        (F.floor(price / F.lit(float(width))).cast("double") * F.lit(float(width))).alias("price_bin"),
    )


def active_limit(weeks: int, share: float = ACTIVE_SHARE):
    """A store is kept when it sold in more weeks than this."""
    return F.floor(F.lit(float(share)) * F.lit(weeks))


def store_list(weekly: DataFrame, weeks: int, share: float = ACTIVE_SHARE) -> DataFrame:
    """Per product and store: active weeks, their numbers in date order, totals, and whether the store is kept."""
    listed = weekly.groupBy(*STORE).agg(
        F.count("week_start_date").alias("wks"),
        F.expr("listagg(CAST(wk_num AS string), ';') WITHIN GROUP (ORDER BY week_start_date)").alias("wks_list"),
        F.sum("kg").alias("kg"),
        F.sum("rub").alias("rub"),
    )
    return listed.withColumn("filter", F.when(F.col("wks") > active_limit(weeks, share), 1).otherwise(0))


def flagged(weekly: DataFrame, weeks: int, share: float = ACTIVE_SHARE, width: float = BIN_WIDTH) -> DataFrame:
    """Store-weeks with the activity of their store, a keep flag and the printed bin.

    The window holds at most one row per week of the study. `first_of_store` marks one row per store, so that stores
    can be counted by summing.
    """
    store = Window.partitionBy(*STORE)
    return weekly.select(
        "*",
        F.count("week_start_date").over(store).alias("wks"),
        (F.min("week_start_date").over(store) == F.col("week_start_date")).alias("first_of_store"),
    ).select(
        *weekly.columns,
        range_label(F.col("price_bin"), width).alias("price_bin_range"),
        "wks",
        "first_of_store",
        F.when(F.col("wks") > active_limit(weeks, share), 1).otherwise(0).alias("filter"),
    )


def kept_sales(weekly: DataFrame, listed: DataFrame) -> DataFrame:
    """Store-weeks of kept stores only, as a semi join against the store list."""
    return weekly.join(listed.where(F.col("filter") == 1).select(*STORE), STORE, "left_semi")


def dropped_sales(weekly: DataFrame, listed: DataFrame) -> DataFrame:
    """The complement: store-weeks of stores that are not kept."""
    return weekly.join(listed.where(F.col("filter") == 1).select(*STORE), STORE, "left_anti")


def weekly_prices(flagged_weeks: DataFrame) -> DataFrame:
    """Kept store-weeks by week and price rounded to kopecks: mean and total kilograms, number of stores."""
    priced = flagged_weeks.where((F.col("filter") == 1) & F.col("price_bin").isNotNull())
    kg = F.sum("kg")
    stores = F.count("global_pos_code")
    return priced.groupBy(
        *PAIR, "wk_num", "week_start_date", round_even("price_kg", 2).alias("price_kg"), "price_bin", "price_bin_range"
    ).agg(ratio(kg, stores).alias("turnover"), kg.alias("kg"), stores.alias("akb"))


def price_levels(
    flagged_weeks: DataFrame, weeks: int, share: float = COVERAGE_SHARE, base: str = "all",
) -> DataFrame:
    """All price bins of a pair, with turnover per store-week of kept stores and a flag for sufficient coverage.

    Bins that only dropped stores have come with `akb` 0: they carry the totals of the pair, and `kept_levels` leaves them
    out. A bin must reach `share` of all combinations of weeks and stores: of all listed stores or, with `base="kept"`, of the
    kept ones. Rows with `price_bin` null carry the store-weeks without a price; they count as stores, not as a bin.
    """
    kept = F.col("filter") == 1
    binned = flagged_weeks.groupBy(*PAIR, "price_bin", "price_bin_range").agg(
        F.sum(F.when(kept, F.col("kg"))).alias("kg"),
        F.count_if(kept).alias("akb"),
        F.sum("kg").alias("listed_kg"),
        F.count_if("first_of_store").alias("listed_stores"),
        F.count_if(F.col("first_of_store") & kept).alias("kept_stores"),
    )
    pair = Window.partitionBy(*PAIR)
    counted = binned.select(
        *PAIR, "price_bin", "price_bin_range", "kg", "akb",
        F.sum("listed_kg").over(pair).alias("listed_kg"),
        F.sum("listed_stores").over(pair).alias("listed_stores"),
        F.sum("kept_stores").over(pair).alias("kept_stores"),
        F.sum("akb").over(pair).alias("kept_rows"),
    )
    return covered(counted, weeks, share, base)


def covered(counted: DataFrame, weeks: int, share: float = COVERAGE_SHARE, base: str = "all") -> DataFrame:
    """Counted bins with their turnover, the coverage limit of their pair and whether they reach it."""
    if base not in ("all", "kept"):
        raise ValueError(f"unknown store base {base!r}, expected 'all' or 'kept'")
    stores = F.col("listed_stores" if base == "all" else "kept_stores")
    if base == "all":
        limit = F.rint(F.lit(float(share)) * stores * F.lit(weeks))
    else:
        limit = F.round(F.lit(share).cast("decimal(6,4)") * F.lit(weeks) * stores, 0)
    return counted.select(
        "*",
        round_even(ratio("kg", "akb"), 4).alias("turnover"),
        limit.cast("long").alias("akb_limit"),
    ).withColumn(
        "filter",
        F.when((F.col("akb") >= F.col("akb_limit")) & (F.col("akb") > 0) & F.col("price_bin").isNotNull(), 1).otherwise(0),
    )


def kept_levels(levels: DataFrame) -> DataFrame:
    """The price levels of the study: bins with a price in which a kept store sold."""
    return levels.where(F.col("price_bin").isNotNull() & (F.col("akb") > 0))


def placed(levels: DataFrame, width: float = BIN_WIDTH) -> DataFrame:
    """Levels at the midpoint of their bin."""
    return levels.withColumn("price_bin", F.col("price_bin") + F.lit(0.5 * width))


def price_points(levels: DataFrame, width: float = BIN_WIDTH) -> DataFrame:
    """Covered price bins, placed at their midpoint."""
    return placed(levels.where(F.col("filter") == 1), width)


def fitted(points: DataFrame, keys: Sequence[str] = PAIR) -> DataFrame:
    """Placed levels with the pair's fit through its covered bins and the predicted turnover; turnover of zero stays out of the fit."""
    positive = (F.col("filter") == 1) & (F.col("turnover") > 0)
    line = weighted_line(
        points,
        list(keys),
        x=F.when(positive, F.ln("price_bin")),
        y=F.when(positive, F.ln("turnover")),
        weight=F.col("akb"),
    )
    return line.withColumn("predicted", F.exp(F.col("intercept") + F.col("slope") * F.ln("price_bin")))


def predictions(points: DataFrame) -> DataFrame:
    return fitted(points).select(
        *PAIR, "price_bin", "price_bin_range", "kg", "akb", "turnover", round_even("predicted", 4).alias("turnover_pred")
    )


def fits(levels: DataFrame, keys: Sequence[str] = PAIR) -> DataFrame:
    """Slope, intercept and quality of every pair (or other `keys`) of the placed levels, the errors measured on the unlogged scale.

    A pair without a covered bin has status `no_points`, one with a single price `too_few_points`; both keep their stores,
    weeks and kilograms.
    """
    pair = Window.partitionBy(*keys).orderBy("price_bin").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    covered = F.col("filter") == 1
    used = covered & (F.col("turnover") > 0)
    w = F.when(used, F.col("akb").cast("double"))
    y = F.col("turnover")
    centred = fitted(levels, keys).withColumn(
        "__mean", F.try_divide(F.sum(w * y).over(pair), F.sum(w).over(pair))
    )
    error = F.sum(w * F.pow(y - F.col("predicted"), 2.0))
    total = F.sum(w * F.pow(y - F.col("__mean"), 2.0))
    per_pair = centred.groupBy(*keys).agg(
        F.max("slope").alias("slope"),
        F.max("intercept").alias("intercept"),
        F.max("fit_points").alias("points"),
        F.count_if(covered).alias("covered"),
        F.count_if(covered & (F.col("turnover") <= 0)).alias("points_left_out"),
        F.coalesce(F.sum(F.when(covered, F.col("kg"))), F.lit(0)).alias("covered_kg"),
        error.alias("error"),
        total.alias("total"),
        F.sum(w).alias("weight"),
        *[F.max(c).alias(c) for c in ("listed_kg", "listed_stores", "kept_stores", "kept_rows")],
    )
    return per_pair.select(
        *keys,
        F.when(F.col("covered") == 0, F.lit("no_points")).when(F.col("slope").isNull(), F.lit("too_few_points")).otherwise(F.lit("ok")).alias("status"),
        "points",
        "points_left_out",
        "slope",
        "intercept",
        round_even("slope", 4).alias("ped"),
        round_even("intercept", 4).alias("alpha"),
        round_even(F.lit(1.0) - F.try_divide("error", "total"), 4).alias("r2"),
        round_even(F.sqrt(F.try_divide("error", "weight")), 4).alias("rmse"),
        "covered_kg", "listed_kg", "listed_stores", "kept_stores", "kept_rows",
    )


def summary(pair_fits: DataFrame, skus: DataFrame, start: date, weeks: int) -> DataFrame:
    """The printed result of each pair: name, dates, counts, equation, quality."""
    first, last = week_range(start, weeks)
    named = pair_fits.join(sku_names(skus), "global_sku_code", "left")
    equation = F.concat(signed(F.col("slope")), F.lit("*ln(x) "), signed(F.col("intercept")))

    def counts(*numbers):
        return F.concat_ws(" / ", *[thousands(n) for n in numbers])

    kept, listed = F.col("kept_stores"), F.col("listed_stores")
    return named.select(
        *PAIR,
        F.concat(F.col("sku_name"), F.lit(" ("), F.col("global_sku_code"), F.lit(")")).alias("sku"),
        day_span(F.lit(first), F.lit(last)).alias("dates"),
        thousands(F.lit(weeks)).alias("weeks"),
        counts(kept, listed).alias("stores"),
        counts(F.col("kept_rows"), kept * weeks, listed * weeks).alias("store_weeks"),
        counts(F.col("covered_kg"), F.col("listed_kg")).alias("kg"),
        equation.alias("log_equation"),
        F.concat(F.lit("exp("), equation, F.lit(")")).alias("equation"),
        "status", "ped", "alpha", "r2", "rmse",
    )


def study(
    fact: DataFrame, skus: DataFrame, stores: DataFrame, networks: DataFrame, start: date, weeks: int,
    width: float = BIN_WIDTH, active_share: float = ACTIVE_SHARE,
    coverage_share: float = COVERAGE_SHARE, base: str = "all",
    products: list[str] | None = None, subnames: list[str] | None = None,
) -> dict[str, DataFrame]:
    """All result tables of the study, for every pair (or the named ones) at once; write them with `sources.tables.write_results`.

    The store-weeks are staged, so the sales are scanned once however many tables are written.
    """
    weekly = store_weeks(fact, skus, stores, networks, start, weeks, width, products, subnames)
    marked = stage(flagged(weekly, weeks, active_share, width), "store-weeks")
    levels = price_levels(marked, weeks, coverage_share, base)
    points = price_points(levels, width)
    return {
        "store_list": store_list(marked, weeks, active_share),
        "store_weeks": marked.drop("first_of_store"),
        "weekly_prices": weekly_prices(marked),
        "price_levels": kept_levels(levels),
        "price_points": predictions(points),
        "results": summary(fits(placed(levels, width)), skus, start, weeks),
    }


def price_points_sql(
    fact: DataFrame, skus: DataFrame, stores: DataFrame, networks: DataFrame, start: date, weeks: int,
    width: float = BIN_WIDTH, active_share: float = ACTIVE_SHARE, coverage_share: float = COVERAGE_SHARE_KEPT,
    products: list[str] | None = None, subnames: list[str] | None = None,
) -> DataFrame:
    """The same price points as one SQL statement over one scan, for every pair or the named ones; turnover is left unrounded.

    Sales are summed before they meet the measured dimensions. Kept stores are counted by their first weeks, so the coverage
    limit needs no second pass over the sales.
    """
    first, last = week_range(start, weeks)
    if products is not None:
        fact = fact.where(F.col("global_sku_code").isin(products))
    if subnames is not None:
        networks = networks.where(F.col("network_subname_alt").isin(subnames))
    skus, places = bounded_broadcast(skus.select("global_sku_code", "weight"), store_dimension(stores, networks))
    return fact.sparkSession.sql(
        """
        WITH folded AS (
            SELECT global_sku_code, global_pos_code, week_start_date, sum(CAST(pieces AS bigint)) AS pieces,
                   sum(CAST(sales_rub AS decimal(18, 4))) AS sales_rub
            FROM {fact}
            WHERE week_start_date BETWEEN :first AND :last
            GROUP BY ALL
        ),
        store_weeks AS (
            SELECT n.network_subname_alt AS network_subname, f.global_sku_code, f.global_pos_code, f.week_start_date,
                   CAST(sum(CAST(f.pieces AS decimal(10, 0)) * CAST(p.weight AS decimal(18, 4)))
                        * CAST(0.001 AS decimal(4, 3)) AS decimal(28, 7)) AS kg,
                   sum(f.sales_rub) AS rub
            FROM folded f
            JOIN {skus} p USING (global_sku_code)
            JOIN {places} n USING (global_pos_code)
            GROUP BY ALL
        ),
        active AS (
            SELECT *,
                   count(*) OVER (PARTITION BY network_subname, global_sku_code, global_pos_code) AS wks,
                   row_number() OVER (PARTITION BY network_subname, global_sku_code, global_pos_code
                                      ORDER BY week_start_date) AS nth_week
            FROM store_weeks
        ),
        binned AS (
            SELECT network_subname, global_sku_code,
                   floor(try_divide(CAST(rub AS double), CAST(kg AS double)) / :width) * CAST(:width AS double) AS low,
                   sum(kg) AS kg, count(*) AS akb, count_if(nth_week = 1) AS first_weeks
            FROM active
            WHERE wks > floor(:active_share * :weeks)
            GROUP BY ALL
        ),
        limited AS (
            SELECT *, round(:coverage_share * :weeks
                            * sum(first_weeks) OVER (PARTITION BY network_subname, global_sku_code), 0) AS akb_limit
            FROM binned
        )
        SELECT network_subname, global_sku_code,
               low + :width / 2 AS price_bin,
               concat(CAST(CAST(low AS bigint) AS string), '-', CAST(CAST(low + :width AS bigint) AS string))
                   AS price_bin_range,
               kg, akb, CAST(kg AS double) / akb AS turnover
        FROM limited
        WHERE low IS NOT NULL AND akb >= akb_limit
        """,
        args={
            "first": first, "last": last, "weeks": weeks, "width": float(width), "active_share": float(active_share),
            "coverage_share": Decimal(str(coverage_share)),
        },
        fact=fact, skus=skus, places=places,
    )
