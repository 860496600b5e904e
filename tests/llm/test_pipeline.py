"""Each stage on its own input against a plain version; then the whole."""

import re

import pytest
import sentencepiece

import corpus_pipeline
from salescube.llm import piece_codec, toxicity
from tests.llm.test_decontamination import brute as leaks
from tests.llm.test_near_dedup import brute as groups
from tests.llm.test_pii import brute as personal

PATH = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{PATH}/documents.parquet")
    held = [docs]
    for name, function in corpus_pipeline.STAGES:
        function(spark, held[-1], PATH).write.parquet(str(root / name))
        held.append(spark.read.parquet(str(root / name)))
    return held


def _rows(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_toxic_documents_go(spark, steps):
    model = toxicity.train(steps[0], spark.read.parquet(f"{PATH}/labels.parquet"))
    before, after = _rows(steps[0]), _rows(steps[1])
    assert after == {i: t for i, t in before.items() if model.score(t.encode()) < toxicity.THRESHOLD}


def test_one_near_copy_stays(steps):
    before = _rows(steps[1])
    assert _rows(steps[2]) == {i: before[i] for i, (_, c) in groups(list(before.items()), 5).items() if i == c}


def test_leaks_go(spark, steps):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{PATH}/benchmark.parquet").collect()]
    before = _rows(steps[2])
    assert _rows(steps[3]) == {x[0]: before[x[0]] for x in leaks(list(before.items()), items) if not x[3]}


def test_personal_data_is_replaced(steps):
    before, after = _rows(steps[3]), _rows(steps[4])
    assert before.keys() == after.keys()
    for i, text in after.items():
        assert sum(personal(before[i])[:4]) == 0 and text == before[i] or re.search("<(email|ip|card|phone)>", text)
        assert sum(personal(text)[:2]) == 0
    assert all(r.n_chars == len(r.text) for r in steps[4].collect())


def test_ids_decode_to_the_text(steps):
    reference = sentencepiece.SentencePieceProcessor(model_file=piece_codec.MODEL_FILE)
    rows = steps[5].collect()
    assert _rows(steps[5]) == _rows(steps[4]) and all(r.round_trip and list(r.token_ids) == reference.encode(r.text) for r in rows)


def test_columns_and_whole_run(spark, steps):
    assert all(s.columns == steps[0].columns for s in steps[1:5])
    assert {tuple(r) for r in corpus_pipeline.run(spark, PATH).select("doc_id", "n_tokens").collect()} == {(r.doc_id, r.n_tokens) for r in steps[5].collect()}
