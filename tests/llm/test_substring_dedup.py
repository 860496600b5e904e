import hashlib
from collections import Counter

import numpy as np
import pytest

from salescube.llm import substring_dedup
from salescube.llm.fm_index import FMIndex, repeated_windows
from tests.llm.samples import frame, near_copies, words


def brute(rows, window):
    seen = Counter(tuple(w[i:i + window]) for _, t in rows for w in [words(t)] for i in range(len(w) - window + 1))
    out = []
    for doc_id, text in rows:
        w = words(text)
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=str)


@pytest.mark.parametrize("window, hot, shard_words", [(35, None, 500_000), (35, None, 4_000), (12, 20_000, 300), (12, 1, 300), (8, 3, 1000)])
def test_equals_counting_all_windows(spark, window, hot, shard_words):
    rows = near_copies(9) + [(1000, "x y z " * 80), (1001, " ".join(f"line{i % 40}" for i in range(200))), (None, "a b " * 60)]
    got = substring_dedup.without_repeats(frame(spark, rows), window, texts=True, hot=hot, shard_words=shard_words).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, window)
    assert any(r.n_removed for r in got) and any(0 < r.n_removed < r.n_words for r in got)


@pytest.mark.parametrize("window", [36, 39])
def test_passages_of_exactly_one_window(spark, window):
    """Single windows that two documents share, at every place of a context."""
    rng = np.random.default_rng(window)
    rows = []
    for i in range(120):
        passage = [f"p{i}w{k}" for k in rng.integers(0, 10**6, window)]
        for j in range(2):
            before, after = (["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(rng.integers(1, 60))] for _ in range(2))
            rows.append((2 * i + j, " ".join(before + passage + after)))
    got = substring_dedup.without_repeats(frame(spark, rows), window, texts=True).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, window)
    assert all(r.n_removed >= window for r in got)


def test_empty_table_and_bad_window(spark):
    assert substring_dedup.without_repeats(frame(spark, [])).count() == 0
    assert substring_dedup.without_repeats(frame(spark, [(1, None), (2, "")])).agg({"n_words": "sum"}).first()[0] == 0
    with pytest.raises(ValueError):
        substring_dedup.without_repeats(frame(spark, []), window=60)


def test_backward_search_counts_occurrences():
    rng = np.random.default_rng(4)
    text = np.r_[rng.integers(1, 5, 400), 0]
    index = FMIndex(text, 6, 9)
    flat = text.tolist()
    for length in (1, 2, 5, 8):
        for start in rng.integers(0, 390, 20).tolist() + [0]:
            pattern = flat[start:start + length]
            low, high = np.array([0]), np.array([len(text)])
            for symbol in reversed(pattern):
                low, high = index.extend(np.array([symbol]), low, high)
            assert high[0] - low[0] == sum(flat[i:i + length] == pattern for i in range(len(flat) - length + 1))


def test_weights_count_as_occurrences():
    contexts = np.array([1, 2, 3, 4, 9, 8, 7, 6], np.uint64)
    assert repeated_windows(contexts, np.array([0, 4, 8]), np.array([2, 1]), 3).tolist() == [0b11, 0]
