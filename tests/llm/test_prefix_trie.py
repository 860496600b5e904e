"""Nodes of the trie against one built turn by turn."""

import hashlib
import random
import zlib

import pytest

from salescube.llm import prefix_trie
from salescube.llm.prefix_trie import trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, n long"


def plain(rows):
    own = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own.setdefault(conv_id, []).append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(turns)] for c, turns in own.items()}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    members, ends = {}, {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    saved = {k: (len(m) - 1) * len(k[-1][1].encode()) if k else 0 for k, m in members.items()}
    children = {k: 0 for k in members}
    for k in members:
        if k:
            children[k[:-1]] += 1
    below, leaves = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for k in members:
        for d in range(len(k) + 1):
            below[k[:d]] += saved[k]
            leaves[k[:d]] += not children[k]
    return sorted((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children[k], leaves[k], below[k],
                   hashlib.sha256(",".join(map(str, sorted(ends.get(k, [])))).encode()).hexdigest(), len(ends.get(k, []))) for k, m in members.items())


def frame(spark, rows, partitions=3):
    return spark.createDataFrame([(*r, "x", 7) for r in rows], SCHEMA).repartition(partitions)


def conversations(seed=1, n=120):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(5 * n), n):
        for turn in range(rng.choice([1, 2, 3, 5, 12])):
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice(["hi", "ünï", "", None, "long " * 40])))
    rows += [(c, t, "user", "same") for c in range(5 * n, 5 * n + 40) for t in range(4)]  # a group of copies
    rows += [(2000, None, "user", "before all"), (2000, 0, "user", "z"), (2000, 0, "user", "a"), (2000, 0, "assistant", "z"), (2000, 0, "user", "a")]
    rows += [(None, 0, "user", "nobody's"), (2005, -3, None, None), (2006, 7, "user", "ab"), (2006, 8, "userab", "")]
    rows += [(3000, t, "user", f"turn {t % 7}") for t in range(300)] + [(3001, t, "user", f"turn {t % 7}") for t in range(250)]
    rng.shuffle(rows)
    return rows


def collected(nodes):
    return sorted((tuple(r) for r in nodes.collect()), key=lambda r: tuple((x is not None, x) if i == 2 else x for i, x in enumerate(r)))


@pytest.mark.parametrize("stretch, block", [(1 << 12, 1 << 13), (16, 3)])
def test_equals_a_trie_built_turn_by_turn(spark, monkeypatch, stretch, block):
    monkeypatch.setattr(prefix_trie, "STRETCH", stretch)
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    rows = conversations()
    want = sorted(plain(rows), key=lambda r: tuple((x is not None, x) if i == 2 else x for i, x in enumerate(r)))
    assert collected(trie(frame(spark, rows))) == want


def test_conversations_that_lose_all_turns_end_at_the_root(spark):
    alone = next(c for c in range(1, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 2)
    assert collected(trie(frame(spark, [(alone, 0, "user", "hi")]))) == plain([(alone, 0, "user", "hi")])


def test_empty_table(spark):
    assert trie(spark.createDataFrame([], SCHEMA)).collect() == []


def test_no_window_or_join_holds_a_conversation(spark):
    """Places come from ranges of the sorted rows: one conversation with all rows is spread over tasks."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        own = prefix_trie.turns(frame(spark, [(5, t, "user", f"{t:05d}") for t in range(4000)]))
        assert sorted(r.n for r in own.collect()) == list(range(1, 4001))
        plan = own._jdf.queryExecution().executedPlan().toString()
        assert "Window" in plan and "t1" not in plan.split("Window", 1)[1].split("\n")[0]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
