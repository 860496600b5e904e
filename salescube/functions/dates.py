"""Calendar expressions: month and week series, ISO weeks, Russian month names."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Month names used in report titles.
MONTHS_RU = (
    "Январь", "Февраль", "Март", "Апрель", "Май", "Июнь",
    "Июль", "Август", "Сентябрь", "Октябрь", "Ноябрь", "Декабрь",
)

DAY_FORMAT = "%d.%m.%Y"


def parse_day(text: str) -> date:
    """A DD.MM.YYYY parameter; anything else is an error."""
    try:
        return datetime.strptime(text, DAY_FORMAT).date()
    except (TypeError, ValueError) as err:
        raise ValueError(f"not a DD.MM.YYYY date: {text!r}") from err


def period_bounds(start: str | date, end: str | date) -> tuple[date, date]:
    """Both ends of a period as dates, checked for order."""
    first = parse_day(start) if isinstance(start, str) else start
    last = parse_day(end) if isinstance(end, str) else end
    if last < first:
        raise ValueError(f"the period ends ({last}) before it starts ({first})")
    return first, last


def parse_day_column(text: Column | str) -> Column:
    return F.to_date(text, "dd.MM.yyyy")


def month_on_or_after(day: Column) -> Column:
    """The first month start that is not before the day."""
    start = F.trunc(day, "month")
    return F.when(start == day, start).otherwise(F.add_months(start, 1))


def monday_on_or_after(day: Column) -> Column:
    return F.next_day(F.date_sub(day, 1), "MON")


def month_starts(df: DataFrame, start: Column, end: Column, name: str = "report_date") -> DataFrame:
    """One row per month start inside [start, end]; rows whose period holds none disappear."""
    first = month_on_or_after(start)
    series = F.when(first <= end, F.sequence(first, end, F.expr("interval 1 month")))
    return df.select("*", F.explode(series).alias(name))


def mondays(df: DataFrame, start: Column, weeks: Column | int, name: str = "week_start_date") -> DataFrame:
    """`weeks` Mondays from the first Monday on or after start."""
    count = F.lit(weeks) if isinstance(weeks, int) else weeks
    first = monday_on_or_after(start)
    last = F.date_add(first, ((count - 1) * 7).cast("int"))
    series = F.when(count > 0, F.sequence(first, last, F.expr("interval 7 days")))
    return df.select("*", F.explode(series).alias(name))


def weeks_between(df: DataFrame, start: Column, end: Column, name: str = "week_start_date") -> DataFrame:
    """Every seventh day from start to end, both ends included."""
    series = F.when(start <= end, F.sequence(start, end, F.expr("interval 7 days")))
    return df.select("*", F.explode(series).alias(name))


def week_range(start: date, weeks: int) -> tuple[date, date]:
    """First and last Monday of a window of whole weeks, for plan parameters."""
    if weeks < 1:
        raise ValueError(f"a window needs at least one week, got {weeks}")
    first = start + timedelta(days=(7 - start.weekday()) % 7)
    return first, first + timedelta(weeks=weeks - 1)


def iso_week_label(day: Column | str) -> Column:
    """ISO year and zero-padded ISO week, such as 2025-01 for 30 December 2024."""
    day = F.col(day) if isinstance(day, str) else day
    year = F.extract(F.lit("YEAROFWEEK"), day).cast("string")
    return F.concat(year, F.lit("-"), F.lpad(F.weekofyear(day).cast("string"), 2, "0"))


def month_title(day: Column | str) -> Column:
    """Russian month name and year."""
    day = F.col(day) if isinstance(day, str) else day
    names = F.array(*[F.lit(m) for m in MONTHS_RU])
    return F.concat(F.element_at(names, F.month(day)), F.lit(" "), F.year(day).cast("string"))


def day_span(first: Column, last: Column) -> Column:
    return F.concat(F.date_format(first, "yyyy.MM.dd"), F.lit("-"), F.date_format(last, "yyyy.MM.dd"))

