"""Line removal against a plain count of all lines, and the runs when batches come one by one."""

import random
import re

import pytest

from llm.samples import frame, lowered
from salescube.llm import line_dedup
from salescube.llm.line_dedup import LineRuns, without_repeats


def plain(rows, min_docs, min_chars):
    def key(line):
        return lowered(re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line))

    def rank(doc_id):
        return (doc_id is not None, doc_id or 0)

    holders = {}
    for at, (doc_id, text) in enumerate(rows):
        for k in {key(line) for line in (text or "").split("\n")}:
            holders.setdefault(k, {})[at] = rank(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [line for line in lines if len(key(line)) < min_chars or len(holders[key(line)]) < min_docs
                or max(holders[key(line)].values()) == rank(doc_id)]
        out.append((doc_id, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def corpus(seed=5):
    rng = random.Random(seed)
    common = ["Common line %d with é and 字 inside" % i for i in range(12)] + ["x" * 9, "short", "Y" * 10]
    rows = []
    for doc_id in range(160):
        lines = [rng.choice(common) if rng.random() < 0.5 else "own %d %d" % (doc_id, rng.randrange(99)) for _ in range(rng.randrange(1, 9))]
        lines = [rng.choice(["", " ", "\t\r"]) + (line.upper() if rng.random() < 0.2 else line) + rng.choice(["", "\r", " \v"]) for line in lines]
        rows.append((doc_id - 40, "\n".join(lines) + rng.choice(["", "\n", "\n\n"])))
    rows += [(1000, None), (1001, ""), (1002, "\n"), (None, common[0]), (None, "only here\nonly without ids"), (None, "only without ids")]
    rows += [rows[3], rows[3], (2000, "\n".join([common[0]] * 40000 + ["tail é"])), (None, "only without ids")]
    return rows


@pytest.mark.parametrize("options", [
    {"batches": 1}, {"batches": 8, "fanout": 2, "shard_entries": 9000}, {"batches": 5, "shard_entries": 1 << 19}, {"batches": 8, "fanout": 3, "shard_entries": 3000},
])
def test_equals_plain_count(spark, options):
    rows = corpus()
    got = without_repeats(frame(spark, rows, 5).withColumn("n_lines", line_dedup.F.lit("clash")), min_docs=3, min_chars=10, **options)
    assert got.columns == ["doc_id", "lang", "source", "n_chars", "score", "component_id", "text", "n_lines", "n_dropped"]
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()), key=repr) == plain(rows, 3, 10)
    assert {r.score for r in got.collect()} == {"x"}


def test_small_tasks_fold_alike(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "_FOLD", 7)
    rows = corpus(9)
    got = without_repeats(frame(spark, rows, 2), min_docs=2, min_chars=1)
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()), key=repr) == plain(rows, 2, 1)


def test_empty_table(spark):
    assert without_repeats(frame(spark, [])).collect() == []


@pytest.mark.parametrize("order", ["up", "down"])
def test_batches_one_by_one(spark, order):
    rows = [(i, f"a line that all documents of this table hold\nown line number {i} of no other document") for i in range(64)]
    rows = rows if order == "up" else rows[::-1]
    runs = LineRuns(spark, bits=1, min_docs=3, min_chars=10, fanout=2)
    for at in range(0, 64, 8):
        runs.add(frame(spark, rows[at:at + 8]))
        assert all(len(level) < 2 for level in runs.levels)
    assert runs.settled == (7 if order == "down" else 0)  # a keeper that comes first settles its line for all later batches
    again = LineRuns(spark, runs.path, runs.bits, runs.levels, min_docs=3, min_chars=10)
    for one in (runs, again):
        store = one.repeated()
        assert [store.array(s, "last").tolist() for s in range(1 << store.bits)] == [[63]]


def test_equal_keys_of_different_lines_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(line_dedup.tokens, "mix", lambda h: h & line_dedup.np.uint64(3))
    lines = line_dedup._Lines(line_dedup.np.frombuffer(b"aaaa\nbbbb\ncccc\ndddd\neeee\nffff", line_dedup.np.uint8), line_dedup.np.array([0, 29]), 1)
    entries = line_dedup.np.zeros(6, line_dedup._ENTRY)
    entries["key"], entries["check"], entries["docs"] = 1, line_dedup.np.arange(6), 1
    merged = line_dedup._merged(entries)
    assert len(lines.key) == 6 and len(merged) == 6
    run = LineRuns(spark)._store("one")
    line_dedup._write(run, 0, merged)
    found = line_dedup._find(run, 0, line_dedup.np.array([1, 1, 2], line_dedup.np.uint64), line_dedup.np.array([4, 9, 0], line_dedup.np.uint64))
    assert found.tolist() == [4, -1, -1]
