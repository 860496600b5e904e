"""The Spark model against a dictionary model of the same formulas."""

import math
import os
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from salescube.llm import ngram_lm, store

TEXTS = [(i, t) for i, t in enumerate([
    "the cat sat on the mat", "The cat sat on the hat", "a dog sat\ton the log", "", None, "the the the the", "dog\x0beats cat",
    "ünï the cat", "the mat sat on a dog and the cat ran on", "on the log the cat sat on the mat " * 30, "zzz yyy xxx", "the cat sat"] * 3)]


def _tokens(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered) + ["</s>"]


def _held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 7 == 2


def _discounts(counter):
    n = Counter(counter.values())
    if not (n[1] and n[2] and n[3]):
        return [0, 0.5, 0.5, 0.5]
    y = n[1] / (n[1] + 2 * n[2])
    raw = [1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3]]
    return [0, *(min(max(d, 0.05), top) for d, top in zip(raw, (0.95, 1.9, 2.85)))]


def brute(rows):
    """score, base_score, n_known by doc_id."""
    uni, bi = Counter(), Counter()
    texts = 0
    for doc_id, text in rows:
        if not _held_out(doc_id):
            texts += 1
            toks = _tokens(text)
            uni.update(toks)
            bi.update(zip(["<s>"] + toks, toks))
    follow, precede = defaultdict(Counter), Counter()
    for (v, w), c in bi.items():
        follow[v][min(c, 3)] += 1
        precede[w] += 1
    D, E = _discounts(bi), _discounts(precede)
    K, V, N = sum(precede.values()), len(uni), sum(uni.values())
    low_rest = sum(E[min(c, 3)] for c in precede.values()) / K if K else 1.0

    def prob(v, w):
        low = (max(precede[w] - E[min(precede[w], 3)], 0) / K if K else 0) + low_rest / (V + 1)
        c = texts if v == "<s>" else uni[v]
        if not c:
            return low
        return max(bi[v, w] - D[min(bi[v, w], 3)], 0) / c + sum(D[k] * n for k, n in follow[v].items()) / c * low

    out = {}
    for doc_id, text in rows:
        toks = _tokens(text)
        out[doc_id] = (len(toks), sum(uni[t] > 0 for t in toks), N, sum(math.log10((uni[t] + 1) / (N + V + 1)) for t in toks),
                       sum(math.log10(prob(v, w)) for v, w in zip(["<s>"] + toks, toks)))
    mass = {v: sum(prob(v, w) for w in uni) + prob(v, "never seen") for v in ["<s>", *uni] if v != "</s>"}
    return out, mass


def _scored(spark, rows, tmp_path):
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(path)
    return {r.doc_id: r for r in ngram_lm.op1_lm_scoring(spark, str(tmp_path)).collect()}


def test_equals_brute_force(spark, tmp_path):
    want, mass = brute(TEXTS)
    assert all(m == pytest.approx(1) for m in mass.values())
    got = _scored(spark, TEXTS, tmp_path)
    assert len(got) == len(TEXTS)
    for doc_id, (n, known, total, base, score) in want.items():
        r = got[doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (_held_out(doc_id), n, known, total)
        assert r.base_score == pytest.approx(base) and r.score == pytest.approx(score)
        assert r.perplexity == pytest.approx(10 ** (-score / n))


def test_small_blocks_give_the_same(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ngram_lm, "FOLD", 5)
    monkeypatch.setattr(ngram_lm, "SHARD_ENTRIES", 3)
    want, _ = brute(TEXTS)
    assert all(r.score == pytest.approx(want[i][4]) for i, r in _scored(spark, TEXTS, tmp_path).items())


def test_files_of_several_shards_give_the_same(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ngram_lm, "FOLD", 5)
    monkeypatch.setattr(ngram_lm, "SHARD_ENTRIES", 3)
    monkeypatch.setattr(ngram_lm, "FILE_BITS", 1)
    want, _ = brute(TEXTS)
    for doc_id, r in _scored(spark, TEXTS, tmp_path).items():
        assert (r.n_known, r.train_tokens) == want[doc_id][1:3]
        assert r.base_score == pytest.approx(want[doc_id][3]) and r.score == pytest.approx(want[doc_id][4])


def test_scoring_holds_few_files_whatever_the_number_of_shards(spark, monkeypatch):
    monkeypatch.setattr(ngram_lm, "SHARD_ENTRIES", 1)
    rows = [(k, " ".join(f"w{k * 100 + i}" for i in range(100))) for k in range(20)]
    model = ngram_lm.train(spark.createDataFrame(rows, "doc_id long, text string"))
    texts = pa.array([text for _, text in rows])
    held = len(os.listdir("/proc/self/fd"))
    now, before, _ = ngram_lm._pair_lists(np.frombuffer(texts.buffers()[2], np.uint8), np.frombuffer(texts.buffers()[1], np.int32).astype(np.int64))
    logs, counts = model.log10(now, before)
    assert counts.tolist() == [1 if i % 101 < 100 else 20 for i in range(2020)] and np.isfinite(logs).all()
    assert len(model.words.open) + len(model.pairs.open) + len(model.often.open) <= 10 * 256
    assert len(os.listdir("/proc/self/fd")) <= held + 10


@pytest.mark.parametrize("mounted", [True, False])
def test_a_file_appears_when_all_its_runs_are_written(tmp_path, monkeypatch, mounted):
    if not mounted:
        monkeypatch.setattr(store, "_local", lambda uri: None)
    kept = store.SortedStore(str(tmp_path), "s", 0, {"n": np.int64})
    with pytest.raises(KeyError), kept.appending(0, "key", "n") as add:
        add(key=np.arange(3, dtype=np.uint64), n=np.arange(3))
        raise KeyError
    assert not os.listdir(tmp_path)
    with kept.appending(0, "key", "n") as add:
        for run in (range(3), range(0), range(3, 7)):
            add(key=np.array(run, np.uint64), n=np.array(run) * 2)
    assert len(os.listdir(tmp_path)) == 2
    found, values = kept.find(np.array([0, 2, 3, 6, 9], np.uint64))
    assert found.tolist() == [True] * 4 + [False] and values["n"].tolist() == [0, 4, 6, 12, 0]


def test_empty_table_and_other_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, score string")
    model = ngram_lm.train(empty)
    assert ngram_lm.score(empty, model).count() == 0
    row = ngram_lm.score(spark.createDataFrame([(None, "a b", "x")], "doc_id long, text string, score string"), model).first()
    assert (row.doc_id, row.n_tokens, row.n_known, row.base_score, row.score) == (None, 3, 0, 0.0, 0.0)


def test_held_out_text_is_likelier_than_under_single_words(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = ngram_lm.train(documents.where("crc32(cast(cast(doc_id as string) as binary)) % 7 <> 2"))
    base, score = ngram_lm.score(documents.where("crc32(cast(cast(doc_id as string) as binary)) % 7 = 2"), model).selectExpr(
        "sum(base_score)", "sum(score)").first()
    assert score > base
