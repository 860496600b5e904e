"""Wide sales report of every network: derived metrics, trailing sales, levels, pruning, numbering, pivot.

All ranking runs on narrow rows; the pivot comes last. Inputs are rows of a stored rollup.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescube.functions.dates import month_title
from salescube.functions.measures import price_per_kg, ratio, round_even
from salescube.functions.sizing import bounded_broadcast
from salescube.functions.text import roman
from salescube.operators.checks import InputError
from salescube.operators.prefix import bucketed, join_null_safe, magnitude, ranked
from salescube.schemas import GROUP, GROUP_KEYS, PRODUCER, ROW_KEYS, SKU, TOTAL
from salescube.sources.scratch import stage

# Labels and thresholds of the report.
WEEKLY_MARK = "понед."
WEEK, MONTH = "Неделя", "Месяц"
TOTAL_LABEL = "Общий итог"
TITLE_PREFIX = "Динамика основных показателей по продажам в "
LABELS = {
    "category": "Категория",
    "segment": "Сегмент",
    "group": "Товарная группа",
    "brand": "Бренд",
    "producer": "Производитель",
    "label": "Наименование",
    "weight": "Вес",
}
METRIC_LABELS = {
    "akb": "АКБ",
    "pieces_per_store": "Оборачиваемость, шт/ТТ",
    "rub_per_store": "РТО, руб/ТТ",
    "pieces": "ТО, шт",
    "kg": "ТО, кг",
    "price_piece": "Цена за шт",
    "price_kg": "Цена за кг",
    "sales_rub": "ТО, руб.",
}
MINOR_SHARE = 0.01
OWN_MINOR_RUB = 100
TRAILING_MONTHS = 3
TRAILING_WEEKS = 13

METRICS = list(METRIC_LABELS)
_NET = "network_subname"
_CELL_KEYS = [_NET, *ROW_KEYS, "level"]
_MONEY = T.DecimalType(18, 2)


def with_metrics(rollup: DataFrame) -> DataFrame:
    """Rollup rows with turnover per store, sales per store, price per piece and price per kilogram."""
    return rollup.select(
        *_CELL_KEYS,
        F.col("report_date").alias("period"),
        F.col("akb").cast("double").alias("akb"),
        ratio("pieces", "akb").alias("pieces_per_store"),
        ratio("sales_rub", "akb").alias("rub_per_store"),
        F.col("pieces").cast("double").alias("pieces"),
        "kg",
        ratio("sales_rub", "pieces").alias("price_piece"),
        price_per_kg("sales_rub", "kg").alias("price_kg"),
        "sales_rub",
    )


def _by_report_row(df: DataFrame) -> DataFrame:
    """Bring the periods of a report row together once; every aggregate over the row's keys then needs no further shuffle.

    A report row has at most one rollup row per period and network, so no partition can grow hot.
    """
    return df.repartition(*_CELL_KEYS)


def cells(rollup: DataFrame) -> DataFrame:
    """One row per report row and period; where two networks share a reporting name the larger value counts."""
    return _largest(_by_report_row(with_metrics(rollup)), _CELL_KEYS)


def _largest(metrics: DataFrame, keys: list[str]) -> DataFrame:
    return metrics.groupBy(*keys, "period").agg(*[round_even(F.max(m), 2).alias(m) for m in METRICS])


def header(rollup: DataFrame) -> DataFrame:
    """Per network: periods covered, weekly or monthly, start of the trailing window, title texts.

    Every period of a network has a total row, so only those rows are read.
    """
    spans = (
        rollup.where(F.col("level") == TOTAL)
        .groupBy(_NET)
        .agg(F.min("report_date").alias("first_period"), F.max("report_date").alias("last_period"))
    )
    weekly = F.col(_NET).contains(WEEKLY_MARK)
    first, last = F.col("first_period"), F.col("last_period")
    return spans.select(
        _NET,
        first,
        last,
        F.when(weekly, F.lit(WEEK)).otherwise(F.lit(MONTH)).alias("frequency"),
        F.when(weekly, F.date_sub(last, 7 * (TRAILING_WEEKS - 1)))
        .otherwise(F.add_months(last, 1 - TRAILING_MONTHS))
        .alias("trailing_start"),
        F.concat(F.lit(TITLE_PREFIX), _NET).alias("title"),
        F.concat(month_title(first), F.lit(" - "), month_title(last)).alias("dates"),
    )


def rows(rollup: DataFrame, heads: DataFrame | None = None) -> DataFrame:
    """One row per report row with its label and its sales over the trailing window and over all periods."""
    heads = header(rollup) if heads is None else heads
    (spans,) = bounded_broadcast(heads.select(_NET, "trailing_start", "last_period"))
    money = round_even(F.max("sales_rub"), 2).cast(_MONEY)
    sales = _by_report_row(rollup.select(*_CELL_KEYS, "report_date", "sales_rub"))
    per_period = sales.groupBy(*_CELL_KEYS, "report_date").agg(money.alias("rub"))
    trailing = F.col("report_date").between(F.col("trailing_start"), F.col("last_period"))
    summed = (
        per_period.join(spans, _NET)
        .groupBy(*_CELL_KEYS)
        .agg(
            F.coalesce(F.sum(F.when(trailing, F.col("rub"))), F.lit(0)).alias("sales_3m"),
            F.coalesce(F.sum("rub"), F.lit(0)).alias("sales_all"),
        )
    )
    return summed.withColumn("label", row_label())


def row_label() -> Column:
    level = F.col("level")
    return (
        F.when(level == TOTAL, F.lit(TOTAL_LABEL))
        .when(level == GROUP, F.col("group"))
        .when(level == PRODUCER, F.col("producer"))
        .otherwise(F.col("global_sku_name"))
    )


def producer_tail(report_rows: DataFrame, share: float = MINOR_SHARE, by: tuple[str, ...] = ("group",)) -> DataFrame:
    """Producer subtotals, smallest trailing sales first, with their running sum and whether they stay.

    A producer stays once the running sum reaches the share of its group's total. Groups are told apart by `by`.
    """
    keys = [_NET, *by]
    tie_break = [c for c in (*GROUP_KEYS, "producer") if c not in by]
    producers = report_rows.where(F.col("level") == PRODUCER)
    totals = producers.groupBy(*keys).agg(F.sum("sales_3m").alias("group_sales_3m"))
    running = bucketed(
        producers,
        buckets={**{k: F.col(k) for k in keys}, "size_bucket": magnitude("sales_3m")},
        bucket_order=[F.col("size_bucket")],
        order=[F.col("sales_3m"), *[F.col(c).asc_nulls_first() for c in tie_break]],
        sums={"running_sales_3m": ("sales_3m", keys)},
    )
    limit = F.lit(share).cast(T.DecimalType(6, 4)) * F.col("group_sales_3m")
    return join_null_safe(running, totals, keys).withColumn("is_top", F.col("running_sales_3m") >= limit)


def pruned(report_rows: DataFrame, share: float = MINOR_SHARE, by: tuple[str, ...] = ("group",)) -> DataFrame:
    """Report rows without the subtotals of tail producers; their products stay."""
    kept = producer_tail(report_rows, share, by).where("is_top").select(*report_rows.columns)
    return report_rows.where(F.col("level") != PRODUCER).unionByName(kept)


def marked(
    report_rows: DataFrame,
    own_producer: str,
    share: float = MINOR_SHARE,
    own_limit: int = OWN_MINOR_RUB,
) -> DataFrame:
    """Mark minor products and own products.

    A product is minor below the share of its group's trailing sales; one of the own producer below a fixed amount.
    """
    group_rows = report_rows.where(F.col("level") == GROUP).select(_NET, *GROUP_KEYS, F.col("sales_3m").alias("group_3m"))
    joined = join_null_safe(report_rows, group_rows, [_NET, *GROUP_KEYS], "left")
    is_sku = F.col("level") == SKU
    own = F.coalesce(F.col("producer") == own_producer, F.lit(False))
    small = F.when(own, F.col("sales_3m") < own_limit).otherwise(
        F.col("sales_3m") < F.lit(share).cast(T.DecimalType(6, 4)) * F.col("group_3m")
    )
    return joined.select(
        *report_rows.columns,
        F.coalesce(F.col("group_3m"), F.lit(0)).cast(_MONEY).alias("group_sales_3m"),
        (is_sku & F.coalesce(small, F.lit(False))).alias("is_minor"),
        (is_sku & own).alias("is_own"),
    )


def numbered(report_rows: DataFrame) -> DataFrame:
    """Add the display position in the network's report, the product number and the producer's Roman number.

    Order: category, segment, group, level; then trailing and all-time sales, largest first; then the label.
    """
    section = [_NET, *GROUP_KEYS, "level"]
    by_name = [*[F.col(k).asc_nulls_first() for k in GROUP_KEYS], F.col("level")]
    order = [
        *by_name,
        F.col("sales_3m").desc(),
        F.col("sales_all").desc(),
        F.col("label").asc_nulls_first(),
        F.col("producer").asc_nulls_first(),
        F.col("brand").asc_nulls_first(),
        F.col("weight"),
    ]
    placed = ranked(report_rows, [_NET], order, "position", report_rows.columns)
    first = placed.groupBy(*section).agg(F.min("position").alias("first_position"))
    in_section = F.col("position") - F.col("first_position") + 1
    placed = join_null_safe(placed, first, section).withColumn("number_in_section", in_section)
    number = F.col("number_in_section")
    return placed.select(
        *report_rows.columns,
        "position",
        F.when(F.col("level") == SKU, number.cast("string"))
        .when(F.col("level") == PRODUCER, roman(number))
        .alias("number"),
    )


def period_list(rollup: DataFrame) -> list[date]:
    """The periods present, in order: the only values a pivot needs on the driver, one per month or week."""
    found = rollup.where(F.col("level") == TOTAL).select("report_date").distinct().orderBy("report_date")
    return [r["report_date"] for r in found.collect()]


def pivoted(report_cells: DataFrame, periods: list[date], keys: list[str] | None = None) -> DataFrame:
    """Metric-major wide rows: all periods of the first metric, then of the next.

    Cells without any value are left out before the pivot, and with them the rows that hold nothing else. A period in
    which a network has no value stays as an empty column, so all metrics keep the same columns.
    """
    keys = _CELL_KEYS if keys is None else keys
    valued = report_cells.where(F.coalesce(*METRICS).isNotNull())
    wide = valued.groupBy(*keys).pivot("period", periods).agg(*[F.max(m).alias(m) for m in METRICS])
    period_major = [f"{m}_{p.isoformat()}" for p in periods for m in METRICS]
    metric_major = [f"`{m}_{p.isoformat()}`" for m in METRICS for p in periods]
    return wide.toDF(*keys, *period_major).select(*keys, *metric_major)


def build(
    rollup: DataFrame,
    own_producer: str,
    periods: list[date] | None = None,
    by: tuple[str, ...] = ("group",),
    subnames: list[str] | None = None,
) -> DataFrame:
    """The finished report of every network (or the named ones), one row per line, numbered by `position`.

    The narrow rows are staged before pruning and before numbering, which each read their input more than once. The
    finished line is attached to the long rows and the pivot groups by it, so no wide row is ever shuffled or joined.
    """
    if subnames is not None:
        rollup = rollup.where(F.col(_NET).isin(subnames))
    periods = period_list(rollup) if periods is None else periods
    if not periods:
        raise InputError("the rollup holds no rows for this report")
    narrow = stage(rows(rollup), "report-rows")
    final = numbered(stage(marked(pruned(narrow, by=by), own_producer), "report-lines"))
    lines = join_null_safe(with_metrics(rollup), final, _CELL_KEYS).repartition(_NET, "position")
    keys = [*_CELL_KEYS, *[c for c in final.columns if c not in _CELL_KEYS]]
    wide = pivoted(_largest(lines, keys), periods, keys)
    text = [f.name for f in wide.schema.fields if isinstance(f.dataType, T.StringType)]
    return wide.na.fill("", subset=text)


def labelled(wide: DataFrame, periods: list[date], weekly: bool = False) -> DataFrame:
    """The report under its printed column names, ready to save; weeks are shown by ISO number.

    Helper columns are dropped except `position`, which sorts the lines.
    """
    def shown(period: date) -> str:
        year, week, _ = period.isocalendar()
        return f"{year}-{week:02d}" if weekly else period.strftime("%Y-%m")

    renamed = [F.col(k).alias(label) for k, label in LABELS.items()]
    values = [
        F.col(f"`{m}_{p.isoformat()}`").alias(f"{label} {shown(p)}") for m, label in METRIC_LABELS.items() for p in periods
    ]
    return wide.select(_NET, "position", F.col("number").alias("№ п/п"), *renamed, *values)


def write(report: DataFrame, path: str) -> None:
    """One directory per network; adaptive execution splits a large network by its bytes."""
    (
        report.hint("rebalance", _NET)
        .write.mode("overwrite")
        .option("compression", "zstd")
        .partitionBy(_NET)
        .parquet(path)
    )
