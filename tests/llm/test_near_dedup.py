"""Groups against comparison of all pairs."""

import numpy as np
import pytest

from salescube.llm import near_dedup, tokens
from salescube.llm.components import connected
from tests.llm.samples import frame, lowered, near_copies, words


def _set(text, k):
    w = words(lowered(text))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k, percent=80):
    sets = {i: _set(t, k) for i, t in rows}
    ids = sorted(sets)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("k, seed", [(2, 3), (5, 4)])
def test_equals_all_pairs(spark, k, seed):
    rows = near_copies(seed)
    got = near_dedup.groups(frame(spark, rows), k).collect()
    assert len(got) == len(rows)
    want = brute(rows, k)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert 1 < len({c for _, c in want.values()}) < len(want)


def test_one_of_each_group_stays(spark):
    rows = near_copies(5) + [(None, "no id here at all"), (None, None)]
    kept = near_dedup.deduplicated(frame(spark, rows))
    assert kept.columns == frame(spark, []).columns
    want = brute([r for r in rows if r[0] is not None], 5)
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted({c for _, c in want.values()})
    assert kept.where("doc_id is null").count() == 2


def test_defined_cases(spark):
    assert near_dedup.groups(frame(spark, []), 2).count() == 0
    got = near_dedup.groups(frame(spark, [(None, "same text here"), (4, "same text here"), (None, "other words"), (2, None)]), 2).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got), key=str) == [
        (2, 0, 2, True), (4, 2, 4, True), (None, 1, None, True), (None, 2, 4, False)]


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(7)
    for share in (0.5, 0.8, 0.95):
        for size in (40, 400, 3000):
            common = tokens.mix(rng.integers(1, 1 << 60, int(size * share)).astype(np.uint64))
            own = [tokens.mix(rng.integers(1, 1 << 60, size - len(common)).astype(np.uint64)) for _ in (0, 1)]
            both = [np.unique(np.concatenate([common, o])) for o in own]
            signatures = near_dedup.superminhash(np.concatenate(both), np.array([0, len(both[0]), len(both[0]) + len(both[1])]))
            assert np.isfinite(signatures).all()
            true = len(common) / (2 * size - len(common))
            assert abs((signatures[0] == signatures[1]).mean() - true) < 0.17
    assert np.isinf(near_dedup.superminhash(np.zeros(0, np.uint64), np.array([0, 0]))).all()


def test_components_of_long_paths_and_stars(spark):
    rng = np.random.default_rng(1)
    order = rng.permutation(300).tolist()
    edges = list(zip(order[:120], order[1:121])) + [(order[130], x) for x in order[131:200]] + [(5, 5)]
    found = {r.node: r.component for r in connected(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {found[x] for x in order[:121]} == {min(order[:121])}
    assert {found[x] for x in order[130:200]} == {min(order[130:200])}
