from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from salescube.operators import moments
from salescube.plans import elasticity, ped_states


@pytest.fixture(scope="module")
def cloud(spark):
    rng = random.Random(3)
    rows = []
    for g in ("a", "b", "c"):
        for h in range(4):
            for _ in range(rng.randrange(2, 30)):
                x = rng.gauss(5 + h, 1)
                rows.append((g, h, x, 9 - 0.7 * x + rng.gauss(0, 0.3), float(rng.randrange(1, 50))))
    return rows, spark.createDataFrame(rows, "g string, h int, x double, y double, w double")


def states(df):
    return moments.point_states(df, ["g", "h"], F.col("x"), F.col("y"), F.col("w"))


def plain(rows):
    x, y, w = (np.array([r[i] for r in rows]) for i in (2, 3, 4))
    slope, intercept = np.polyfit(x, y, 1, w=np.sqrt(w))
    left = (w * (y - intercept - slope * x) ** 2).sum()
    return slope, intercept, 1 - left / (w * (y - np.average(y, weights=w)) ** 2).sum(), math.sqrt(left / w.sum())


@pytest.mark.parametrize("keys", [["g", "h"], ["g"], ["h"], []])
@pytest.mark.parametrize("parts", [1, 7])
def test_merged_states_fit_like_the_points(cloud, keys, parts):
    rows, df = cloud
    stored = moments.merged(states(df), ["g", "h"], parts)
    for r in moments.line(moments.merged(stored, keys, parts)).collect():
        mine = [p for p in rows if all(p["gh".index(k)] == r[k] for k in keys)]
        assert r["points"] == len(mine)
        assert (r["slope"], r["intercept"], r["explained"], r["error"]) == pytest.approx(plain(mine), abs=1e-9)


def test_far_from_zero_no_digit_is_lost(spark, cloud):
    rows, df = cloud
    far = moments.line(moments.merged(states(df.withColumn("x", F.col("x") + 1e7)), ["g"])).collect()
    near = {r["g"]: r for r in moments.line(moments.merged(states(df), ["g"])).collect()}
    assert all(r["slope"] == pytest.approx(near[r["g"]]["slope"], rel=1e-6) for r in far)


def test_one_price_no_points_and_flat_lines(spark):
    schema = "g string, h int, x double, y double, w double"
    df = spark.createDataFrame(
        [("one", 0, 1.0, 2.0, 3.0), ("one", 1, 1.0, 4.0, 3.0), ("flat", 0, 1.0, 2.0, 1.0), ("flat", 0, 2.0, 2.0, 1.0),
         ("none", 0, None, 2.0, 1.0), ("none", 0, 1.0, None, 1.0), ("none", 0, 1.0, 1.0, 0.0)], schema)
    got = {r["g"]: r for r in moments.line(moments.merged(states(df), ["g"])).collect()}
    assert set(got) == {"one", "flat"}
    assert (got["one"]["points"], got["one"]["slope"], got["one"]["explained"], got["one"]["error"]) == (2, None, None, None)
    assert (got["flat"]["slope"], got["flat"]["intercept"], got["flat"]["explained"], got["flat"]["error"]) == (0.0, 2.0, None, 0.0)
    assert moments.merged(states(df.limit(0)), []).count() == 0


def test_stored_states_of_one_network_are_replaced_alone(spark, tmp_path):
    def points(network, slope):
        rows = [(network, sku, float(x), float(x) ** slope * 100, 5, 1) for sku in ("s", "t") for x in (10, 20, 40)]
        return spark.createDataFrame(rows, "network_subname string, global_sku_code string, price_bin double, turnover double, akb long, filter int")

    path = str(tmp_path / "states")
    ped_states.write_states(ped_states.states(points("007", -1.0).unionByName(points("n", -2.0))), path)
    ped_states.write_states(ped_states.states(points("n", -0.5)), path)
    stored = ped_states.read_states(spark, path)
    pairs = {tuple(r) for r in ped_states.group_fits(stored, elasticity.PAIR).select(*elasticity.PAIR, "ped").collect()}
    assert pairs == {("007", "s", -1.0), ("007", "t", -1.0), ("n", "s", -0.5), ("n", "t", -0.5)}
    everything = ped_states.all_fits(stored)
    assert everything.count() == 4 + 2 + 2 + 1
    assert everything.where("network_subname IS NULL AND global_sku_code IS NULL").first()["points"] == 12
