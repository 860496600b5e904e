"""Databook tables: totals row and changes against earlier periods, for any number of row keys at once.

Works on long rows (keys, period, value). Each change is a conditional aggregate over at most two years of periods, so one
shuffle on the row keys serves all changes of a table.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescube.functions.measures import ratio
from salescube.functions.text import CHANGE_FORMS, change_text

# Names of comparisons, aggregates and the totals row.
PERIODS = ("m_on_m", "m_on_m_last_year", "ytd_on_ytd")
AGGREGATES = ("sum", "mean")
TOTAL_LABEL = "Итого"


def measure_by_period(sales: DataFrame, keys: list[str], period: str, value: Column, name: str = "value") -> DataFrame:
    """Long source table of a section: one value per row keys and period."""
    return sales.groupBy(*keys, F.col(period).alias("period")).agg(value.alias(name))


def with_totals(long: DataFrame, keys: list[str], value: str = "value", label: str = TOTAL_LABEL) -> DataFrame:
    """Long rows plus one total per period over all keys; missing values are skipped, nothing but missing sums to 0.

    Both come from one pass. The total's first key carries the label, its other keys are null.
    """
    total = F.grouping(keys[0]) == 1
    sets = [[F.col(k) for k in [*keys, "period"]], [F.col("period")]]
    summed = long.groupingSets(sets, *[F.col(k) for k in [*keys, "period"]]).agg(
        total.alias("is_total"),
        F.sum(value).alias("__sum"),
    )
    shown = F.when(F.col("is_total"), F.coalesce(F.col("__sum"), F.lit(0))).otherwise(F.col("__sum"))
    first = F.when(F.col("is_total"), F.lit(label)).otherwise(F.col(keys[0])).alias(keys[0])
    return summed.select(first, *keys[1:], "is_total", "period", shown.alias(value))


def _check(period: str, aggregate: str) -> None:
    if period not in PERIODS:
        raise ValueError(f"unknown comparison {period!r}, expected one of {PERIODS}")
    if aggregate not in AGGREGATES:
        raise ValueError(f"unknown aggregate {aggregate!r}, expected one of {AGGREGATES}")


def _pair(current: date, value: str, period: str, aggregate: str) -> tuple[Column, Column]:
    """Aggregates giving the earlier and the current value of a comparison."""
    month, v = F.col("period"), F.col(value)
    now = F.lit(current)
    if period == "ytd_on_ytd":
        to_date = F.month(month) <= current.month
        year = F.year(month)
        parts = [F.when(to_date & (year == y), v) for y in (current.year - 1, current.year)]
        if aggregate == "mean":
            return tuple(ratio(F.sum(p), F.count(p)) for p in parts)
        return tuple(F.coalesce(F.sum(p).cast("double"), F.lit(0.0)) for p in parts)
    back = 1 if period == "m_on_m" else 12
    return tuple(F.sum(F.when(month == F.add_months(now, -n), v)).cast("double") for n in (back, 0))


def changes(
    long: DataFrame,
    keys: list[str],
    current: date,
    period: str = "m_on_m",
    aggregate: str = "sum",
    value: str = "value",
) -> DataFrame:
    """Earlier value, current value and plain difference per row keys.

    `m_on_m` compares with the month before, `m_on_m_last_year` with the same month a year before, `ytd_on_ytd` the months
    so far with the same months a year before, summed or averaged over the months that have a value.
    """
    _check(period, aggregate)
    previous, now = _pair(current, value, period, aggregate)
    return (
        _recent(long, current)
        .groupBy(*keys)
        .agg(previous.alias("previous"), now.alias("current"))
        .withColumn("change", F.col("current") - F.col("previous"))
    )


def _recent(long: DataFrame, current: date) -> DataFrame:
    """January of last year up to the current month: all a databook table shows."""
    return long.where(F.col("period").between(F.lit(date(current.year - 1, 1, 1)), F.lit(current)))


def formatted(compared: DataFrame, form: str, name: str = "shown") -> DataFrame:
    if form not in CHANGE_FORMS:
        raise ValueError(f"unknown change form {form!r}, expected one of {CHANGE_FORMS}")
    return compared.withColumn(name, change_text(F.col("previous"), F.col("current"), form))


def table_periods(current: date) -> list[date]:
    """Columns of a table: January of last year to the current month."""
    return [date(y, m, 1) for y in (current.year - 1, current.year) for m in range(1, 13) if date(y, m, 1) <= current]


def table(
    long: DataFrame,
    keys: list[str],
    current: date,
    columns: dict[str, tuple[str, str, str]],
    value: str = "value",
    totals: bool = True,
) -> DataFrame:
    """The finished wide table: months as columns, then the change columns as text, then the totals row.

    `columns` maps a column name to (comparison, aggregate, form). Months and changes share one shuffle.
    """
    for period, aggregate, form in columns.values():
        _check(period, aggregate)
        if form not in CHANGE_FORMS:
            raise ValueError(f"unknown change form {form!r}, expected one of {CHANGE_FORMS}")
    source = _recent(long, current)
    if totals:
        source, keys = with_totals(source, keys, value), [*keys, "is_total"]
    months = [
        F.sum(F.when(F.col("period") == F.lit(p), F.col(value))).cast("double").alias(p.strftime("%Y-%m"))
        for p in table_periods(current)
    ]
    pairs = {name: _pair(current, value, period, aggregate) for name, (period, aggregate, _) in columns.items()}
    sides = [side.alias(f"__{tag}_{name}") for name, pair in pairs.items() for tag, side in zip("pc", pair, strict=True)]
    wide = source.groupBy(*keys).agg(*months, *sides)
    shown = [
        change_text(F.col(f"`__p_{name}`"), F.col(f"`__c_{name}`"), form).alias(name)
        for name, (_, _, form) in columns.items()
    ]
    return wide.select(*keys, *[F.col(f"`{p.strftime('%Y-%m')}`") for p in table_periods(current)], *shown)
