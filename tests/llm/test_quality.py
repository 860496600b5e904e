import re
from collections import Counter

import pytest

from salescube.llm import quality
from tests.llm.samples import frame, near_copies, words

EXTRA = ["a b c d e " * 30, "same line\nsame line\nother\n \n \nsame line", "# * $ % & | < > x y", "one two three four five six seven eight nine ten", "WORD " * 12,
         "x" * 5000, "ü " * 40, "a\x0bb\x0cc\rd e f g h i j k", "p q r s t p q r s t u p q r s t"]


def brute(text):
    text = text or ""
    w = words(text)
    windows = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if windows[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if words(x)]
    chars, symbols = sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text))
    dup = len(lines) - len(set(lines))
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    rejected = failed or 2 * symbols > len(w) or not 2 * len(w) <= chars <= 15 * len(w) or 2 * len(re.findall("[A-Z]", text)) > chars \
        or 2 * dup > len(text.split("\n"))
    return len(w), chars, symbols, dup, len(covered), failed, not rejected


def test_equals_brute_force_in_any_order(spark):
    rows = near_copies(2) + [(900 + i, t) for i, t in enumerate(EXTRA)] + [(None, "no id")]
    documents = frame(spark, rows)
    want = sorted(((i, *brute(t)) for i, t in rows), key=str)
    order = quality.cascade_order(documents, sample=50)
    assert sorted(order) == sorted(quality._rules(quality._measures("text", "words"), "text"))
    for o in (order, order[::-1]):
        assert sorted(map(tuple, quality.measured(documents, o).collect()), key=str) == want
        kept = quality.clean(documents, o)
        assert kept.columns == documents.columns and kept.count() == sum(x[-1] for x in want)


def test_real_texts_and_clean_documents(spark):
    path = "/root/testdata/sf0.01"
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    rows = quality.op8_quality_rules(spark, path).collect()
    assert all(tuple(r)[1:] == brute(text[r.doc_id]) for r in rows)
    good = {r.doc_id for r in spark.read.parquet(f"{path}/labels.parquet").where("quality = 1").collect()}
    mine = [r for r in rows if r.doc_id in good and not r.base_failed]
    assert sum(r.kept for r in mine) / len(mine) > 0.98


def test_order_follows_cost_and_rejections():
    rows = [{"a": True, "b": False, "c": True}] * 6 + [{"a": False, "b": True, "c": False}] * 4 + [{"a": False, "b": False, "c": False}] * 90
    assert quality._order({"a": 1.0, "b": 1.0, "c": 1.0}, rows) == ["a", "b", "c"]
    assert quality._order({"a": 8.0, "b": 1.0, "c": 2.0}, rows) == ["b", "c", "a"]
    assert quality._order({"a": 1.1, "b": 0.9, "c": 1.05}, rows) == quality._order({"a": 0.95, "b": 1.1, "c": 1.0}, rows)
    assert quality._order({"b": 4.0, "a": 1.0}, []) == ["a", "b"]


def test_order_is_stable_and_copies_do_not_fill_the_sample(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").cache()
    orders = [quality.cascade_order(documents) for _ in range(5)]
    first = {o[0] for o in orders}
    assert len(first) == 1, orders
    text = documents.first().text
    copies = frame(spark, [(i, text) for i in range(300)] + [(1000 + i, f"text {i}") for i in range(300)])
    held = [r.text for r in quality._sampled(copies, 60).collect()]
    assert len(held) == 60 and 10 < held.count(text) < 50


def test_a_rule_is_evaluated_only_on_what_earlier_ones_leave(spark):
    """The second rule fails the job when it is reached."""
    rules = {"first": "id < 900", "second": "raise_error(concat('reached ', id)) is not null"}
    verdict = quality._verdict(rules, ["first", "second"])
    assert spark.range(900).selectExpr(f"{verdict} as kept").where("kept").count() == 0
    with pytest.raises(Exception, match="reached 9"):
        spark.range(901, 999).selectExpr(f"{verdict} as kept").where("kept").count()


def test_native_and_empty(spark):
    out = quality.measured(frame(spark, []))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
    assert out.count() == 0
