"""Hard negatives against all inner products, and the bounds of the trees."""

import math
import random

import numpy as np
import pytest

from salescube.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, rank string, negative_id string"


def frame(spark, rows, partitions=3):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(partitions) if rows else spark.createDataFrame([], SCHEMA)


def plain(rows, every, positives=5, negatives=5):
    kept = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((i, [math.floor(256 * float(np.float32(x))) for x in v], label))
    out = []
    for i, v, label in kept:
        if i % every:
            continue
        scored = sorted(((sum(a * b for a, b in zip(v, w)), j, m) for j, w, m in kept if j != i), key=lambda x: (-x[0], x[1]))
        for p, j, _ in [x for x in scored if x[2] == label][:positives]:
            near = [x for x in scored if x[2] != label and 80 * p <= 100 * x[0] <= 100 * p][:negatives]
            out += [(i, j, rank, n[1], p, n[0]) for rank, n in enumerate(near, 1)]
    return sorted(out)


def mined(spark, rows, every, **options):
    usable = hn.usable(frame(spark, rows))
    return sorted(tuple(r) for r in hn.hard_negatives(usable, usable.where(f"vec_id % {every} = 0"), **options).collect())


def vectors(seed=2, n=700, dims=6, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, dims))
    rows = [(i, (centres[rng.integers(9)] * rng.choice([1, 1, 0.2]) + 0.1 * rng.normal(size=dims)).round(2).tolist(), int(rng.integers(labels))) for i in range(n)]
    rows += [(n + i, [0.5] * dims, i % 3) for i in range(90)]  # copies: ties in score
    rows += [(1007, None, 1), (1008, [math.nan] * dims, 1), (1009, [math.inf] + [0.0] * (dims - 1), 1), (1010, [None] + [1.0] * (dims - 1), 1),
             (1011, [1.0] * dims, None), (None, [1.0] * dims, 1), (1012, [], 1), (1020, [0.9, 0.4], 2), (1040, [0.7] * (dims + 2), 3), (1060, [0.0] * dims, 0)]
    return rows


@pytest.mark.parametrize("tree, leaf", [(2048, 32), (64, 4), (16, 1)])
def test_equals_all_inner_products(spark, monkeypatch, tree, leaf):
    monkeypatch.setattr(hn, "TREE", tree)
    monkeypatch.setattr(hn, "LEAF", leaf)
    rows = vectors()
    assert mined(spark, rows, 20) == plain(rows, 20)


def test_repeated_rows_are_candidates_of_their_own(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [0.9, 0.1], 0), (2, [0.9, 0.0], 1), (2, [0.9, 0.0], 1), (3, [0.8, 0.0], 1)]
    assert mined(spark, rows, 100) == plain(rows, 100)
    assert [r[3] for r in mined(spark, rows, 100)] == [2, 2, 3]


def test_scores_beyond_doubles_are_exact(spark):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1, 1) * 2.0 ** 19 for _ in range(5)], i % 2) for i in range(120)]
    rows = [(i, [float(np.float32(x)) for x in v], m) for i, v, m in rows]
    assert mined(spark, rows, 10) == plain(rows, 10)


def test_windows_without_positive_scores(spark):
    rows = [(0, [1.0], 0), (1, [-1.0], 0), (2, [-0.9], 1), (3, [0.0], 0), (4, [0.0], 1)]
    assert mined(spark, rows, 100) == plain(rows, 100) == [(0, 3, 1, 4, 0, 0)]


def test_empty_table_and_wrong_window(spark):
    assert mined(spark, [], 100) == []
    with pytest.raises(ValueError):
        mined(spark, vectors(n=5), 20, low=90, high=80)


def test_bounds_hold_and_cut(monkeypatch):
    """Every node's bounds hold for what lies below it, and on clustered vectors most leaves are never multiplied."""
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(40, 8)) * 300
    points = np.floor(centres[rng.integers(40, size=2000)] + rng.normal(size=(2000, 8)) * 5)
    order, nodes = hn.cover(points)
    points = points[order]
    shape = np.c_[nodes["parent"], nodes["low"], nodes["high"], nodes["level"]]
    tree = hn._Tree(0, np.arange(2000), points, points[nodes["centre"]], shape, nodes["angle"])
    seen = []
    scores = hn._Tree.scores
    monkeypatch.setattr(hn._Tree, "scores", lambda self, q, low, high: (seen.append((high - low).sum()), scores(self, q, low, high))[1])
    forest = object.__new__(hn._Forest)
    forest.trees, forest.labels = [tree], np.zeros(1, np.int64)
    for query in np.floor(rng.normal(size=(20, 8)) * 300):
        least, most = tree.bounds(query, float(np.sqrt(query @ query)))
        exact = points @ query
        for i in range(len(least)):
            below = exact[tree.low[i]:tree.high[i]]
            assert least[i] <= below.min() and below.max() <= most[i]
        (best,) = forest.search(query, np.arange(1), [(-np.inf, np.inf)], 5)
        assert best == sorted(zip(exact.astype(int).tolist(), range(2000)), key=lambda x: (-x[0], x[1]))[:5]
    assert sum(seen) < 0.5 * 20 * 2000
    radii = [nodes["angle"][nodes["level"] == i].max() for i in range(nodes["level"].max() + 1)]
    assert all(a >= b - 1e-9 for a, b in zip(radii, radii[1:]))
