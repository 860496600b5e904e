import random

import numpy as np
import pytest
import sentencepiece

from salescube.llm import piece_codec
from tests.llm.samples import frame


def _bytes(texts):
    data = [t.encode() for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.r_[0, np.cumsum([len(b) for b in data])].astype(np.int64)


def _encode(pieces, texts):
    flat, at = pieces.encode(*_bytes(texts))
    return [flat[a:b].tolist() for a, b in zip(at, at[1:])]


@pytest.fixture(scope="module")
def pieces():
    return piece_codec.load()


def _texts():
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz      \n\t0123456789ABC.,!éßñ中文日🙂aaaeeettt"
    made = ["".join(rng.choice(letters) for _ in range(rng.randrange(90))) for _ in range(1500)]
    return made + ["", " ", "a" * 300, "  hello  world ", "indistinguishable internationalization " * 20, " " * 300 + "x" + " " * 77, "=" * 60,
                   "no_spaces_but_long_" * 400, "The quick brown fox.\nJumps over 12345 dogs"]


def test_ids_are_those_of_the_library(pieces, monkeypatch):
    reference = sentencepiece.SentencePieceProcessor(model_file=piece_codec.MODEL_FILE)
    texts = _texts()
    for _ in range(2):  # then from the cache
        for text, ids in zip(texts, _encode(pieces, texts)):
            assert ids == reference.encode(text), text
    monkeypatch.setattr(piece_codec, "_CACHED_WORDS", 50)  # the cache starts anew with every piece
    for at in range(0, len(texts), 40):
        assert _encode(pieces, texts[at:at + 40]) == [reference.encode(t) for t in texts[at:at + 40]]


def test_a_text_longer_than_a_piece(spark, pieces):
    rng = random.Random(8)
    long = " ".join("".join(rng.choice("etaoin shrdlu") for _ in range(rng.randrange(12))) for _ in range(260_000))
    assert len(long) > 1 << 20
    reference = sentencepiece.SentencePieceProcessor(model_file=piece_codec.MODEL_FILE)
    got = {r.doc_id: r for r in piece_codec.encoded(frame(spark, [(1, long), (2, "short"), (3, long[:50])]), pieces).collect()}
    assert list(got[1].token_ids) == reference.encode(long) and list(got[3].token_ids) == reference.encode(long[:50])
    assert all(r.round_trip for r in got.values())


def test_bytes_that_do_not_come_back_are_reported(pieces):
    raw, offs = _bytes(["good text", "bad", "", "  more"])
    flat, at = pieces.encode(raw, offs)
    assert pieces.returns(flat, at, raw, offs).tolist() == [True] * 4
    other = raw.copy()
    other[10] += 1
    assert pieces.returns(flat, at, other, offs).tolist() == [True, False, True, True]
    shorter, cut = _bytes(["good text", "ba", "", "  more"])
    assert pieces.returns(flat, at, shorter, cut).tolist() == [True, False, True, True]


def test_round_trip_in_spark(spark, pieces):
    texts = [*_texts()[:300], None, "a ▁ literal mark▁", "▁", "tab\tand\x0bmore\x00"]
    rows = list(enumerate(texts)) + [(None, "x"), (3, texts[3])]
    documents = frame(spark, rows).withColumnRenamed("score", "n_tokens")
    out = piece_codec.encoded(documents, pieces)
    assert out.columns == [*documents.columns, "n_tokens_", "token_ids_", "round_trip_"]
    got = out.collect()
    assert len(got) == len(rows) and all(r.round_trip_ and r.n_tokens_ == len(r.token_ids_) for r in got)
    back = piece_codec.decoded(out.select("doc_id", out.token_ids_.alias("token_ids")), pieces).collect()
    assert sorted(map(tuple, back), key=str) == sorted(((i, t or "") for i, t in rows), key=str)


def test_empty_table(spark, pieces):
    assert piece_codec.encoded(frame(spark, []), pieces).count() == 0


def test_registered_query(spark):
    out = piece_codec.op7_sentencepiece(spark, "/root/testdata/sf0.001")
    reference = sentencepiece.SentencePieceProcessor(model_file=piece_codec.MODEL_FILE)
    text = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in out.collect():
        assert r.round_trip and list(r.token_ids) == reference.encode(text[r.doc_id])
