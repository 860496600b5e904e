from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from salescube.operators.checks import InputError
from salescube.plans import report
from salescube.schemas import GROUP, PRODUCER, ROLLUP, SKU, TOTAL

_COLUMNS = [f.name for f in ROLLUP.fields if f.name != "last_update"]


def line(level, rub, group="g", producer=None, name=None, month=date(2024, 3, 1), net="net", akb=2, pieces=4, kg=1.0,
         category="c", weight=None):
    shown = lambda value, least: value if level >= least else None
    return (
        month, "N", net, shown(category, 1), shown("s", 1), shown(group, 1), shown(producer, 2),
        shown("b", 3), shown(name, 3), (weight if weight is not None else 100.0) if level == SKU else 0.0,
        level, akb, pieces, kg, rub,
    )


def frame(spark, rows):
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ROLLUP.fields if f.name != "last_update")
    return spark.createDataFrame(rows, schema)


def test_trailing_window_by_month_and_week(spark):
    monthly = [line(TOTAL, 1.0, month=date(2023, m, 1)) for m in (11, 12)]
    monthly += [line(TOTAL, 10.0, month=date(2024, m, 1)) for m in (1, 2, 3)]
    name = "net понед."
    weekly = [line(TOTAL, 1.0, net=name, month=date(2023, 12, 25))]
    weekly += [line(TOTAL, 10.0, net=name, month=date(2024, 1, 1)), line(TOTAL, 10.0, net=name, month=date(2024, 3, 25))]
    rollup = frame(spark, monthly + weekly)
    heads = {r["network_subname"]: r for r in report.header(rollup).collect()}
    assert (heads["net"]["trailing_start"], heads["net"]["frequency"]) == (date(2024, 1, 1), "Месяц")
    assert heads["net"]["dates"] == "Ноябрь 2023 - Март 2024"
    assert heads["net"]["title"].endswith("по продажам в net")
    assert (heads[name]["trailing_start"], heads[name]["frequency"]) == (date(2024, 1, 1), "Неделя")
    sums = {r["network_subname"]: (r["sales_3m"], r["sales_all"]) for r in report.rows(rollup).collect()}
    assert sums == {"net": (30, 32), name: (20, 21)}


def test_duplicate_cells_show_the_larger_value(spark):
    rollup = frame(spark, [line(TOTAL, 5.0, akb=2, pieces=4), line(TOTAL, 9.0, akb=4, pieces=4, kg=0.0)])
    cell = report.cells(rollup).collect()[0]
    assert (cell["akb"], cell["sales_rub"], cell["pieces_per_store"], cell["rub_per_store"]) == (4.0, 9.0, 2.0, 2.5)
    assert (cell["price_piece"], cell["price_kg"]) == (2.25, 5.0)
    assert report.rows(rollup).collect()[0]["sales_all"] == 9


def test_smallest_producers_lose_their_subtotal(spark):
    rows = [line(PRODUCER, s, producer=p) for p, s in (("a", 0.5), ("b", 0.5), ("z", 99.0))]
    rows += [line(TOTAL, 100.0), line(GROUP, 100.0), line(SKU, 0.5, producer="a", name="kept")]
    lines = report.rows(frame(spark, rows))
    tail = {r["producer"]: (float(r["running_sales_3m"]), r["is_top"]) for r in report.producer_tail(lines).collect()}
    assert tail == {"a": (0.5, False), "b": (1.0, True), "z": (100.0, True)}
    left = {(r["level"], r["label"]) for r in report.pruned(lines).collect()}
    assert left == {(0, "Общий итог"), (1, "g"), (2, "b"), (2, "z"), (3, "kept")}


def test_groups_of_one_name_are_pruned_together_unless_told_apart(spark):
    rows = [line(PRODUCER, 0.5, producer="a", category="c1"), line(PRODUCER, 99.0, producer="z", category="c2")]
    rows += [line(TOTAL, 99.5)]
    lines = report.rows(frame(spark, rows))
    assert report.pruned(lines).count() == 2
    assert report.pruned(lines, by=("category", "segment", "group")).count() == 3


def test_nothing_sold_keeps_every_producer(spark):
    lines = report.rows(frame(spark, [line(TOTAL, 0.0), *[line(PRODUCER, 0.0, producer=p) for p in "ab"]]))
    assert report.pruned(lines).count() == 3


def test_minor_products(spark):
    rows = [line(TOTAL, 1000.0), line(GROUP, 1000.0)]
    rows += [line(SKU, s, producer=p, name=f"{p}{s}") for p, s in
             (("x", 9.99), ("x", 10.0), ("own", 99.99), ("own", 100.0))]
    got = {r["label"]: (r["is_minor"], r["is_own"]) for r in report.marked(report.rows(frame(spark, rows)), "own").collect()}
    assert got == {
        "Общий итог": (False, False), "g": (False, False),
        "x9.99": (True, False), "x10.0": (False, False), "own99.99": (True, True), "own100.0": (False, True),
    }


def test_order_and_numbers(spark):
    rows = [line(TOTAL, 60.0), line(GROUP, 50.0, group="g1"), line(GROUP, 10.0, group="g2")]
    rows += [line(PRODUCER, s, group="g1", producer=p) for p, s in (("big", 30.0), ("small", 20.0))]
    rows += [line(SKU, s, group="g1", producer="big", name=n) for n, s in (("b", 15.0), ("a", 15.0), ("c", 20.0))]
    rows += [line(PRODUCER, 10.0, group="g2", producer="big"), line(SKU, 10.0, group="g2", producer="big", name="d")]
    # products without trailing sales fall back on all-time sales
    rows += [line(SKU, s, group="g2", producer="big", name=n, month=date(2023, 1, 1)) for n, s in (("e", 1.0), ("f", 2.0))]
    got = report.numbered(report.rows(frame(spark, rows))).orderBy("position").collect()
    assert [(r["position"], r["label"], r["number"]) for r in got] == [
        (1, "Общий итог", None),
        (2, "g1", None), (3, "big", "I"), (4, "small", "II"), (5, "c", "1"), (6, "a", "2"), (7, "b", "3"),
        (8, "g2", None), (9, "big", "I"), (10, "d", "1"), (11, "f", "2"), (12, "e", "3"),
    ]


def test_finished_report(spark, tmp_path):
    rows = [line(TOTAL, 60.0), line(GROUP, 60.0), line(PRODUCER, 60.0, producer="own")]
    rows += [line(SKU, 60.0, producer="own", name="a"), line(TOTAL, 5.0, month=date(2024, 2, 1))]
    empty = list(line(SKU, 0.0, producer="own", name="empty"))
    empty[11:] = [None] * 4
    rollup = frame(spark, [*rows, tuple(empty)])
    periods = report.period_list(rollup)
    assert periods == [date(2024, 2, 1), date(2024, 3, 1)]
    wide = report.build(rollup, "own")
    metrics = [c for c in wide.columns if c[-10:] in ("2024-02-01", "2024-03-01")]
    assert metrics[:4] == ["akb_2024-02-01", "akb_2024-03-01", "pieces_per_store_2024-02-01", "pieces_per_store_2024-03-01"]
    assert len(metrics) == 16
    lines = wide.orderBy("position").collect()
    assert [r["label"] for r in lines] == ["Общий итог", "g", "own", "a"]
    assert lines[0]["category"] == "" and lines[0]["sales_rub_2024-02-01"] == 5.0 and lines[1]["sales_rub_2024-02-01"] is None
    printed = report.labelled(wide, periods)
    assert printed.columns[2:10] == [
        "№ п/п", "Категория", "Сегмент", "Товарная группа", "Бренд", "Производитель", "Наименование", "Вес",
    ]
    assert printed.columns[10:12] == ["АКБ 2024-02", "АКБ 2024-03"]
    assert report.labelled(wide, periods, weekly=True).columns[10:12] == ["АКБ 2024-05", "АКБ 2024-09"]
    report.write(wide, str(tmp_path / "report"))
    assert spark.read.parquet(str(tmp_path / "report")).count() == 4


def test_chosen_networks_only(spark):
    rollup = frame(spark, [line(TOTAL, 1.0, net="a"), line(TOTAL, 2.0, net="b", month=date(2020, 1, 1))])
    chosen = report.build(rollup, "own", subnames=["a"])
    assert [r["network_subname"] for r in chosen.collect()] == ["a"] and "akb_2020-01-01" not in chosen.columns
    with pytest.raises(InputError, match="no rows"):
        report.build(rollup, "own", subnames=["c"])


def test_largest_producer_always_stays(spark):
    rows = [line(PRODUCER, float(7 ** (i % 9)), group=f"g{i % 4}", producer=f"p{i:03}") for i in range(120)]
    lines = report.rows(frame(spark, [line(TOTAL, 1.0), *rows]))
    tail = report.producer_tail(lines)
    largest = tail.groupBy("group").agg(F.max_by("is_top", F.struct("sales_3m", "producer")).alias("top"))
    assert all(r["top"] for r in largest.collect())


@pytest.mark.parametrize("share, left", [(0.0, 3), (1.0, 1)])
def test_share_bounds(spark, share, left):
    lines = report.rows(frame(spark, [line(TOTAL, 3.0), *[line(PRODUCER, 1.0, producer=p) for p in "abc"]]))
    assert report.pruned(lines, share=share).where("level = 2").count() == left
