from __future__ import annotations

import math
from datetime import date

import numpy as np
import pytest
from conftest import column, one
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from salescube.functions import dates, measures, sizing, text
from salescube.operators.prefix import bucketed, magnitude


def values(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_month_starts_skip_a_started_month(spark):
    df = values(spark, [(date(2022, 1, 15), date(2022, 3, 10)), (date(2022, 1, 2), date(2022, 1, 31))], "a date, b date")
    got = column(dates.month_starts(df, F.col("a"), F.col("b")), "report_date")
    assert got == [date(2022, 2, 1), date(2022, 3, 1)]


def test_mondays_from_a_tuesday(spark):
    df = values(spark, [(date(2024, 4, 2),)], "a date")
    assert column(dates.mondays(df, F.col("a"), 2), "week_start_date") == [date(2024, 4, 8), date(2024, 4, 15)]
    assert dates.mondays(df, F.col("a"), 0).count() == 0
    assert dates.week_range(date(2024, 4, 2), 2) == (date(2024, 4, 8), date(2024, 4, 15))
    assert dates.week_range(date(2024, 4, 1), 8) == (date(2024, 4, 1), date(2024, 5, 20))


def test_week_steps_include_both_ends(spark):
    df = values(spark, [(date(2024, 1, 15), date(2024, 3, 25)), (date(2024, 2, 1), date(2024, 1, 1))], "a date, b date")
    assert dates.weeks_between(df, F.col("a"), F.col("b")).count() == 11


def test_iso_labels_around_new_year(spark):
    df = values(spark, [(date(2024, 12, 30),), (date(2021, 1, 3),), (date(2024, 1, 1),)], "d date")
    assert column(df.select(dates.iso_week_label("d").alias("w")), "w") == ["2025-01", "2020-53", "2024-01"]


def test_day_parameters():
    assert dates.parse_day("01.05.2023") == date(2023, 5, 1)
    for bad in ("2023-05-01", "31.02.2023", None):
        with pytest.raises(ValueError):
            dates.parse_day(bad)
    with pytest.raises(ValueError):
        dates.period_bounds("02.01.2022", "01.01.2022")


def test_date_text(spark):
    df = values(spark, [("09.02.2024",)], "s string").select(dates.parse_day_column("s").alias("d"))
    got = one(df.select("d", dates.month_title("d"), dates.day_span(F.col("d"), F.date_add("d", 7))))
    assert got == (date(2024, 2, 9), "Февраль 2024", "2024.02.09-2024.02.16")


def test_price_bins_and_labels(spark):
    df = values(spark, [(99.99,), (100.0,), (104.99,), (None,)], "p double")
    low = F.floor(F.col("p") / 5.0).cast("double") * 5.0
    got = df.select(low.alias("low"), text.range_label(low, 5).alias("label")).collect()
    assert [tuple(r) for r in got] == [(95.0, "95-100"), (100.0, "100-105"), (100.0, "100-105"), (None, None)]


def test_price_per_kilogram_without_weight(spark):
    df = values(spark, [(0.0, 5.0), (0.0, 0.0), (2.0, 5.0)], "kg double, rub double")
    assert column(df.select(measures.price_per_kg("rub", "kg").alias("p")), "p") == [0.0, None, 2.5]


def test_roman_numerals(spark):
    wanted = {1: "I", 4: "IV", 9: "IX", 14: "XIV", 40: "XL", 49: "XLIX", 50: "L", 1994: "MCMXCIV", 3999: "MMMCMXCIX", 4000: "MMMM", 12345: "MMMMMMMMMMMMCCCXLV"}
    df = values(spark, [(n,) for n in [*wanted, 0]], "n int")
    assert column(df.select(text.roman(F.col("n")).alias("r")), "r") == [*wanted.values(), None]


CHANGES = [
    (0.0, 1234567.5, "1 234 568", "1 234 567,5", "–"),
    (10.0, 9.6, "0", "-0,4", "-4%"),
    (10.0, 9.96, "0", "0,0", "0%"),
    (100.0, 260.0, "160", "160,0", "2,6x"),
    (100.0, 250.0, "150", "150,0", "150%"),
    (100.0, 112.5, "12", "12,5", "12%"),
    (100.0, 0.0, "-100", "-100,0", "-100%"),
    (None, 5.0, "–", "–", "–"),
    (1.0, 123456.0, "123 455", "123 455,0", "123456,0x"),
    (1.0, -12345.0, "-12 346", "-12 346,0", "-1234600%"),
]


def test_change_texts(spark):
    df = values(spark, [c[:2] for c in CHANGES], "p double, c double")
    shown = df.select(*[text.change_text(F.col("p"), F.col("c"), form).alias(form) for form in text.CHANGE_FORMS])
    assert [tuple(r) for r in shown.collect()] == [c[2:] for c in CHANGES]
    with pytest.raises(ValueError):
        text.change_text(F.col("p"), F.col("c"), "share")


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.floats(-1e6, 1e6), st.floats(-1e6, 1e6)), min_size=1, max_size=30))
def test_numbers_round_and_print_as_in_python(spark, pairs):
    df = values(spark, pairs, "p double, c double")
    got = df.select(
        measures.round_even("p", 2).alias("r"),
        text.spaced(F.col("c") - F.col("p"), 1).alias("t"),
    ).collect()
    for (p, c), row in zip(pairs, got, strict=True):
        assert row["r"] == np.round(p, 2)
        assert row["t"] == f"{c - p:,.1f}".replace(",", " ").replace(".", ",")


def test_exact_sums_do_not_depend_on_order(spark):
    df = values(spark, [(0.1,)] * 1000 + [(1e12,), (-1e12,)], "v double")
    assert float(one(df.agg(F.sum(measures.exact("v"))))[0]) == 100.0


def test_broadcast_needs_a_measured_size(spark):
    small = values(spark, [("a", 1)], "k string, v int")
    assert sizing.measure_bytes(small, small.limit(0)) == [33, 0]
    fact = values(spark, [("a", 2)], "k string, w int")
    hinted, = sizing.bounded_broadcast(small)
    plain, = sizing.bounded_broadcast(small, max_bytes=1)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan(fact.join(hinted, "k"))
    assert "strategy" not in plan(fact.join(plain, "k"))
    assert fact.join(hinted, "k").collect() == fact.join(plain, "k").collect()


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(
    st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from([0, 0, 0, 1, 5]) | st.integers(-10**6, 10**6)),
    min_size=1, max_size=60,
))
def test_bucketed_numbers_equal_a_plain_window(spark, rows):
    df = values(spark, [(k, v, i) for i, (k, v) in enumerate(rows)], "k string, v long, i long")
    split = bucketed(
        df,
        buckets={"k": F.col("k"), "b": magnitude("v")},
        bucket_order=[F.col("b").desc()],
        order=[F.col("v").desc(), F.col("i")],
        numbers={"n": ["k"]},
        sums={"s": ("v", ["k"])},
    )
    whole = Window.partitionBy("k").orderBy(F.col("v").desc(), "i")
    plain = df.withColumns({
        "n": F.row_number().over(whole).cast("long"),
        "s": F.sum("v").over(whole.rowsBetween(Window.unboundedPreceding, 0)),
    })
    assert sorted(split.collect(), key=lambda r: r["i"]) == sorted(plain.collect(), key=lambda r: r["i"])


def test_magnitude_never_falls(spark):
    amounts = sorted([0.0, 0.01, -0.01, 1.0, -1.0, *[s * 10.0**e * m for s in (1, -1) for e in range(7) for m in (1, 3)]])
    df = values(spark, [(a,) for a in amounts], "a double")
    got = column(df.select("a", magnitude("a").alias("m")), "m")
    assert got == sorted(got) and got[amounts.index(0.0)] == 0
    assert sum(m == 0 for m in got) == 1 and not any(math.isnan(m) for m in got)
