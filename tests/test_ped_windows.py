from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from salescube.plans import elasticity
from salescube.plans.ped_windows import Windows

START, SPAN, WIDTH = date(2024, 1, 1), 30, 10


@pytest.fixture(scope="module")
def star(spark):
    """Two networks, three products, a third of all sales in one pair; stores that pause, start late or stop early."""
    rng, rows = random.Random(5), []
    for store in range(8):
        for sku in ("hot", "warm", "rare"):
            share = {"hot": 0.8, "warm": 0.5, "rare": 0.12}[sku]
            pause = range(10, 10 + store * 2)
            for week in range(SPAN):
                if week not in pause and rng.random() < share:
                    pieces = rng.randrange(1, 20)
                    rows.append((START + timedelta(weeks=week), sku, str(store), pieces, pieces * float(rng.randrange(15, 70))))
    rows.append((START + timedelta(weeks=3), "weightless", "0", 5, 50.0))
    fact = spark.createDataFrame(rows, "week_start_date date, global_sku_code string, global_pos_code string, pieces int, sales_rub double")
    skus = spark.createDataFrame(
        [(s, s, w) for s, w in (("hot", 1000.0), ("warm", 500.0), ("rare", 1000.0), ("weightless", 0.0))],
        "global_sku_code string, global_sku_name string, weight double",
    )
    stores = spark.createDataFrame([(str(i),) for i in range(8)], "global_pos_code string")
    return fact, skus, stores, stores.withColumn("network_subname_alt", F.when(F.col("global_pos_code") < "5", "n").otherwise("m"))


def windows(star, weeks, span=SPAN):
    return Windows(elasticity.store_weeks(*star, START, span, WIDTH), START, span, weeks)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("weeks, base", [(8, "all"), (13, "kept"), (1, "all"), (SPAN, "all")])
def test_each_window_equals_its_own_study(star, weeks, base):
    found = windows(star, weeks)
    levels = elasticity.kept_levels(found.levels(WIDTH, base=base)).collect()
    fits = found.fits(WIDTH, base=base).collect()
    starts = sorted({r["window_start"] for r in fits})
    assert starts == [START + timedelta(weeks=i) for i in range(SPAN - weeks + 1)]
    for start in {starts[0], starts[len(starts) // 2], starts[-1]}:
        marked = elasticity.flagged(elasticity.store_weeks(*star, start, weeks, WIDTH), weeks, width=WIDTH)
        single = elasticity.price_levels(marked, weeks, base=base)
        names = elasticity.kept_levels(single).columns
        assert sorted((tuple(r[n] for n in names) for r in levels if r["window_start"] == start), key=str) == rows(elasticity.kept_levels(single))
        alone = elasticity.fits(elasticity.placed(single, WIDTH)).drop("slope", "intercept")
        assert sorted((tuple(r[n] for n in alone.columns) for r in fits if r["window_start"] == start), key=str) == rows(alone)
    assert weeks == 1 or {"ok"} <= {r["status"] for r in fits}


def test_kept_spans_are_whole_runs(star):
    weeks = 6
    sold = {}
    for r in elasticity.store_weeks(*star, START, SPAN, WIDTH).collect():
        sold.setdefault(tuple(r[c] for c in elasticity.STORE), set()).add((r["week_start_date"] - START).days // 7)
    want = set()
    for store, held in sold.items():
        kept = [s for s in range(SPAN - weeks + 1) if len(held & set(range(s, s + weeks))) > weeks // 4]
        for s in kept:
            if s - 1 not in kept:
                end = next(e for e in range(s, SPAN) if e + 1 not in kept)
                want.add((*store, START + timedelta(weeks=s), START + timedelta(weeks=end)))
    got = rows(windows(star, weeks).kept_spans())
    assert got == sorted(want, key=str) and len(want) > len({w[:3] for w in want})


def test_short_spans_and_no_sales(star):
    fact, *others = star
    assert windows(star, SPAN + 1).fits(WIDTH).count() == 0
    assert windows((fact.limit(0), *others), 4).fits(WIDTH).count() == 0
    with pytest.raises(ValueError):
        windows(star, 0)


def test_store_weeks_are_not_copied_into_their_windows(star, spark):
    """A kept store-week makes two changes at most for each run of its store, however many windows hold it."""
    found = windows(star, 20)
    changes = found._kept_changes()
    assert changes.count() <= 2 * found.rows.join(found.kept_runs(), elasticity.STORE).count()
    copied = found.rows.select(F.sum(found.closes - found.opens + 1)).first()[0]
    assert changes.count() < copied / 3
    plan = found.levels(WIDTH)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan
