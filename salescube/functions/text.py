"""Text shown to a reader: bin labels, Roman numerals, formatted changes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from salescube.functions.measures import ratio

# The text forms the databook prints.
NO_VALUE = "–"
TIMES_SUFFIX = "x"
TIMES_ABOVE = 1.5
NEGATIVE_ZEROS = {"-0%": "0%", "-0": "0", "-0,0": "0,0"}

CHANGE_FORMS = ("abs_change", "pp_change", "pct_change")

_ROMAN_DIGITS = (
    ("", "C", "CC", "CCC", "CD", "D", "DC", "DCC", "DCCC", "CM"),
    ("", "X", "XX", "XXX", "XL", "L", "LX", "LXX", "LXXX", "XC"),
    ("", "I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX"),
)


def range_label(low: Column, width: int | float) -> Column:
    """`low-high` of a price bin, as whole numbers."""
    whole = low.cast("long")
    return F.concat(whole.cast("string"), F.lit("-"), (low + F.lit(width)).cast("long").cast("string"))


def roman(number: Column) -> Column:
    """Roman numeral, digit by digit, thousands as that many M; null below 1."""
    digits = [
        F.element_at(F.array(*[F.lit(d) for d in names]), (F.floor(number / power) % 10 + 1).cast("int"))
        for names, power in zip(_ROMAN_DIGITS, (100, 10, 1), strict=True)
    ]
    return F.when(number >= 1, F.concat(F.repeat(F.lit("M"), F.floor(number / 1000).cast("int")), *digits))


def thousands(number: Column, places: int = 0) -> Column:
    """Comma-grouped number, ties to even."""
    return F.format_number(number.cast("double"), places)


def spaced(number: Column, places: int) -> Column:
    """Space-grouped number with a decimal comma, ties to even."""
    return F.translate(thousands(number, places), ",.", " ,")


def signed(number: Column, places: int = 4) -> Column:
    """Number with its sign; null stays null."""
    return F.when(number.isNotNull(), F.format_string(f"%+.{places}f", number))


def change_text(previous: Column, current: Column, form: str) -> Column:
    """A change between two values as the databook shows it; a missing value or zero base gives a dash."""
    previous, current = previous.cast("double"), current.cast("double")
    if form == "abs_change":
        shown = spaced(current - previous, 0)
    elif form == "pp_change":
        shown = spaced(current - previous, 1)
    elif form == "pct_change":
        times = ratio(current, previous)
        growth = times - F.lit(1.0)
        ungrouped = lambda x, places: F.translate(thousands(x, places), ".,", ",")
        shown = F.when(growth > TIMES_ABOVE, F.concat(ungrouped(times, 1), F.lit(TIMES_SUFFIX))).otherwise(
            F.concat(ungrouped(growth * 100, 0), F.lit("%"))
        )
    else:
        raise ValueError(f"unknown change form {form!r}, expected one of {CHANGE_FORMS}")
    for negative, zero in NEGATIVE_ZEROS.items():
        shown = F.when(shown == negative, F.lit(zero)).otherwise(shown)
    return F.coalesce(shown, F.lit(NO_VALUE))
