import random

import numpy as np
import pyarrow as pa

from salescube.llm import tokens
from tests.llm.samples import words


def _pieces(texts, size):
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    return tokens.text_chunks([batch, batch.slice(1)], size=size)


def test_words_and_hashes_do_not_depend_on_the_piece():
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab ü\n\t日.") for _ in range(rng.randrange(40))) for _ in range(200)] + ["", None, "x" * 5000, None, ""]
    expected = {}
    for size in (1, 64, 1 << 20):
        seen = []
        for rows, raw, offs in _pieces(texts, size):
            starts, ends, first = tokens.word_spans(raw, offs)
            hashes = tokens.word_hashes(raw, starts, ends)
            data = raw.tobytes()
            for i, text in enumerate(rows.column(0).to_pylist()):
                mine = slice(first[i], first[i + 1])
                got = [data[a:b].decode() for a, b in zip(starts[mine], ends[mine])]
                assert got == words(text)
                for word, value in zip(got, hashes[mine].tolist()):
                    assert expected.setdefault(word, value) == value
                seen.append(text)
        assert seen == texts + texts[1:]
    assert len(set(expected.values())) == len(expected)


def test_runs_are_equal_where_words_are():
    rng = np.random.default_rng(2)
    sequence = tokens.mix(rng.integers(0, 4, 500).astype(np.uint64))
    for length in (1, 2, 5):
        names = {}
        for i, h in enumerate(tokens.run_hashes(sequence, length).tolist()):
            assert names.setdefault(tuple(sequence[i:i + length]), h) == h
        assert len(set(names.values())) == len(names)
        starts = np.arange(len(sequence) - length + 1)
        assert (tokens.span_hashes(sequence, starts, starts + length) == tokens.run_hashes(sequence, length)).all()


def test_shingle_sets():
    sequence = tokens.mix(np.array([1, 2, 1, 2, 3, 9, 8, 7], np.uint64))
    first = np.array([0, 5, 5, 6, 8])
    values, at = tokens.shingle_sets(sequence, first, 2)
    assert np.diff(at).tolist() == [3, 0, 1, 1]
    assert set(values[:3].tolist()) == set(tokens.run_hashes(sequence[:5], 2).tolist())
    assert values[3] == tokens.run_hashes(sequence[5:6], 1)[0]
