from __future__ import annotations

from datetime import date

import pytest
from conftest import one

from salescube.plans import databook

NOW = date(2024, 2, 1)


@pytest.fixture(scope="module")
def long(spark):
    rows = [("a", date(2023, m, 1), 10.0 * m) for m in range(1, 13)]
    rows += [("a", date(2024, 1, 1), 15.0), ("a", date(2024, 2, 1), 35.0)]
    rows += [("b", date(2024, 1, 1), 7.0), ("b", date(2024, 2, 1), None), ("old", date(2022, 2, 1), 5.0)]
    return spark.createDataFrame(rows, "k string, period date, value double")


@pytest.mark.parametrize("period, aggregate, previous, current", [
    ("m_on_m", "sum", 15.0, 35.0),
    ("m_on_m_last_year", "sum", 20.0, 35.0),
    ("ytd_on_ytd", "sum", 30.0, 50.0),
    ("ytd_on_ytd", "mean", 15.0, 25.0),
])
def test_changes(long, period, aggregate, previous, current):
    got = databook.changes(long, ["k"], NOW, period, aggregate).where("k = 'a'")
    assert one(got.select("previous", "current", "change")) == (previous, current, current - previous)


def test_missing_months(long):
    def b(period, aggregate="sum", form="abs_change"):
        shown = databook.formatted(databook.changes(long, ["k"], NOW, period, aggregate), form)
        return one(shown.where("k = 'b'").select("previous", "current", "shown"))

    assert b("m_on_m") == (7.0, None, "–")
    assert b("m_on_m_last_year") == (None, None, "–")
    assert b("ytd_on_ytd") == (0.0, 7.0, "7")  # a sum over nothing is 0
    assert b("ytd_on_ytd", form="pct_change") == (0.0, 7.0, "–")
    assert b("ytd_on_ytd", "mean") == (None, 7.0, "–")  # a mean over nothing is not
    assert databook.changes(long, ["k"], NOW).where("k = 'old'").count() == 0


def test_totals_row(long):
    rows = {r["period"]: r["value"] for r in databook.with_totals(long, ["k"]).where("is_total").collect()}
    assert rows[date(2024, 1, 1)] == 22.0 and rows[NOW] == 35.0 and len(rows) == 15
    empty = databook.with_totals(long.where("k = 'b'"), ["k"]).where("period = '2024-02-01'").collect()
    assert {(r["k"], r["value"]) for r in empty} == {("b", None), ("Итого", 0.0)}


def test_finished_table(long):
    table = databook.table(long, ["k"], NOW, {
        "мес.": ("m_on_m", "sum", "abs_change"),
        "ytd %": ("ytd_on_ytd", "sum", "pct_change"),
    })
    assert table.columns == ["k", "is_total", *[f"2023-{m:02}" for m in range(1, 13)], "2024-01", "2024-02", "мес.", "ytd %"]
    shown = {r["k"]: (r["2024-02"], r["мес."], r["ytd %"]) for r in table.collect()}
    assert shown == {"a": (35.0, "20", "67%"), "b": (None, "–", "–"), "Итого": (35.0, "13", "90%")}
    plain = databook.table(long, ["k"], NOW, {}, totals=False)
    assert plain.columns[:2] == ["k", "2023-01"] and plain.count() == 2


@pytest.mark.parametrize("bad", [("w_on_w", "sum"), ("m_on_m", "max")])
def test_unknown_names_are_errors(long, bad):
    with pytest.raises(ValueError):
        databook.changes(long, ["k"], NOW, *bad)
    with pytest.raises(ValueError):
        databook.table(long, ["k"], NOW, {"x": (*bad, "abs_change")})
    with pytest.raises(ValueError):
        databook.formatted(databook.changes(long, ["k"], NOW), "share")
    with pytest.raises(ValueError):
        databook.table(long, ["k"], NOW, {"x": ("m_on_m", "sum", "share")})
