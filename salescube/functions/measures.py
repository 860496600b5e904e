"""Exact sums, guarded ratios and half-even rounding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Money (roubles) and weights (grams) carry at most four decimals. Summing them as decimals makes a sum
# independent of the order in which tasks finish, so a retried task cannot move a rounded digit.
EXACT = T.DecimalType(18, 4)
KILOGRAMS = T.DecimalType(28, 7)


def exact(column: Column | str) -> Column:
    return _column(column).cast(EXACT)


def grams(pieces: Column | str, weight: Column | str, digits: int = 10) -> Column:
    """Weight of the pieces sold, in grams; null where the product has no weight. A number of pieces has at most `digits` digits."""
    return _column(pieces).cast(T.DecimalType(digits, 0)) * exact(weight)


def kilograms(total_grams: Column) -> Column:
    """Exact kilograms from a sum of grams."""
    return (total_grams * F.lit(0.001).cast(T.DecimalType(4, 3))).cast(KILOGRAMS)


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient as double, null on a zero denominator."""
    return F.try_divide(_column(numerator).cast("double"), _column(denominator).cast("double"))


def round_even(column: Column | str, places: int) -> Column:
    """Scale, round half to even, scale back: the numeric-array convention."""
    scale = F.lit(float(10**places))
    return F.rint(_column(column).cast("double") * scale) / scale


def price_per_kg(rub: Column | str, kg: Column | str) -> Column:
    """Roubles per kilogram; 0 for goods sold without a known weight, null when nothing was sold."""
    rub, kg = _column(rub).cast("double"), _column(kg).cast("double")
    return F.when((kg == 0) & (rub > 0), F.lit(0.0)).otherwise(F.try_divide(rub, kg))


def as_doubles(df: DataFrame) -> DataFrame:
    """Decimal columns as doubles, for results handed to a user or a file."""
    decimals = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({name: F.col(f"`{name}`").cast("double") for name in decimals})


def _column(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column
