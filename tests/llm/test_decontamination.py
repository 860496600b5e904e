import random
import re

import duckdb
import numpy as np
import pandas as pd
import pytest

from salescube.llm import decontamination
from salescube.llm.oracles import ORACLES
from tests.llm.samples import frame


def _set(text):
    w = [x for x in re.split(r"[\x00-/:-@\[-`{-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows, items):
    sets = {}
    for i, t in items:
        if i is not None:
            sets.setdefault(i, set()).update(_set(t))
    out = []
    for doc_id, text in rows:
        mine = _set(text)
        best = max(((len(s & mine) / len(s), -i) for i, s in sets.items() if s and len(s & mine) >= 0.8 * len(s) - 1e-9), default=None)
        out.append((doc_id, -best[1] if best else None, best[0] if best else None, best is not None))
    return sorted(out, key=str)


def _case(seed=8):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(500)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 60)))) for i in range(40)] + [(50, None), (51, ""), (52, "?!"), (None, "x y z"), (3, "more words of item three")]
    rows = []
    for n in range(150):
        text = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 900))]
        if n % 3 == 0:
            item = items[rng.randrange(40)][1].split()
            if n % 2:
                item = item[:max(1, len(item) * rng.randrange(70, 100) // 100)]
            text[rng.randrange(len(text) + 1):0] = item
        rows.append((n, (" | " if n % 5 == 0 else " ").join(text).title()))
    return rows + [(200, None), (201, ""), (None, items[7][1]), (3, rows[3][1]), (202, items[9][1] + " " + items[9][1])], items


@pytest.mark.parametrize("block", [4_000_000, 100])
def test_equals_exact_containment(spark, block):
    rows, items = _case()
    benchmark = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id long")
    got = decontamination.scan(frame(spark, rows), benchmark, block_shingles=block).collect()
    want = brute(rows, items)
    assert sorted(map(tuple, got), key=str) == want and 20 < sum(x[3] for x in want) < len(want)


def test_sketches_cannot_miss():
    for size in range(1, 300):
        k = min(size, decontamination.sketch_size(decontamination.size_partition(size), 0.8))
        need = -(-8 * size // 10)
        assert k > size - need


def test_clean_and_empty(spark):
    rows, items = _case()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    kept = decontamination.clean(frame(spark, rows), benchmark)
    assert kept.columns == frame(spark, []).columns and kept.count() == sum(not x[3] for x in brute(rows, items))
    assert decontamination.clean(frame(spark, rows), benchmark.limit(0)).count() == len(rows)
    assert decontamination.scan(frame(spark, []), benchmark).count() == 0


def test_items_under_five_words_are_found_inside_long_documents(spark):
    long = [f"w{i}" for i in range(400)]
    items = [(1, "What is 2 + 2?"), (2, "lonely"), (3, "two words"), (4, " ".join(long[50:80])), (5, "not in any")]
    put = lambda text: " ".join(long[:200]) + f" ({text}) " + " ".join(long[200:])
    rows = [(1, put("WHAT is 2+2")), (2, put("lonely")), (3, "two words"), (4, "two, words here"), (5, put("two other words")),
            (6, "two"), (7, "words lonely two"), (8, None), (9, "not in"), (10, "any " + put("x") + " not in")]
    for cut in (1, 2, 4):
        benchmark = spark.createDataFrame([x for x in items if x[0] != 4 or cut > 1], "item_id long, text string")
        got = {r.doc_id: r.item_id for r in decontamination.scan(frame(spark, rows, cut), benchmark, block_shingles=10 ** 6 if cut < 4 else 1).collect()}
        whole = {1: 1, 2: 2, 3: 3, 4: 3, 5: None, 6: None, 7: 2, 8: None, 9: None, 10: None}
        assert got == (whole if cut == 1 else whole | {5: 4, 10: 4})


def test_rows_of_one_item_are_united(spark):
    words = [f"u{i}" for i in range(48)]
    parts = [" ".join(words[:24]), " ".join(words[24:])]  # 20 shingles each
    raw = [np.frombuffer(p.encode(), np.uint8) for p in parts]
    hashed = sorted((int(h), p, i) for p, r in enumerate(raw) for i, h in enumerate(decontamination.shingles(r, np.array([0, len(r)]))[0]))
    least = {(p, i) for _, p, i in hashed[:8]}  # 32 of the 40 shingles are left: exactly the threshold
    piece = lambda p, i: " ".join(words[24 * p + i:24 * p + i + 5])
    lacking = " | gap | ".join(piece(p, i) for p in (0, 1) for i in range(20) if (p, i) not in least)
    items = [(1, parts[0]), (1, parts[1]), (2, " ".join(f"v{i}" for i in range(24))), (2, " ".join(f"v{i}" for i in range(12, 36)))]
    rows = [(1, lacking), (2, " ".join(f"v{i}" for i in range(30))), (3, " ".join(f"v{i}" for i in range(6, 36)))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.scan(frame(spark, rows), benchmark).collect()
    want = brute(rows, items)
    assert sorted(map(tuple, got), key=str) == want and want[0] == (1, 1, 0.8, True)


def test_reference_sql_finds_short_items_too(spark):
    """The registered SQL against the operator where items have one to four words, inside longer and shorter documents."""
    items = [(1, "What is 2 + 2?"), (2, "blue"), (3, "a b c d e f g"), (4, "four words make it"), (5, None), (6, "?"), (7, "tie here"), (8, "here tie")]
    rows = [(1, "so what is 2 2 he asked"), (2, "Blue."), (3, "x a b c d e f g y"), (4, "four words make"), (5, "well, four words make it so"), (6, None),
            (7, ""), (8, "the tie here tie"), (9, "bluer what is 2"), (10, "a b c d e f"), (11, "what is 2 2")]
    db = duckdb.connect()
    db.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]))
    db.register("benchmark", pd.DataFrame(items, columns=["item_id", "text"]))
    want = sorted(db.execute(f"SELECT doc_id, item_id, containment, contaminated FROM ({ORACLES['op9_decontamination']})").fetchall())
    got = decontamination.scan(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, got.select("doc_id", "item_id", "containment", "contaminated").collect())) == want
    assert [r[1] for r in want] == [1, 2, 3, None, 4, None, None, 7, None, None, 1]
