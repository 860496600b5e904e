"""Language identification by hyperdimensional profiles.

Every letter has a fixed random vector of `dimensions` values -1 and 1, drawn from its code point. A three-letter run of a word
(with one space at either end) is bound to a vector: the first letter's vector rotated twice, times the second's rotated once,
times the third's. The vectors of all runs of a text, bundled by addition, are its profile; the profiles of a language's training
texts add up to the language's prototype. A text is given the language whose prototype has the largest cosine with its profile.

Training sums whole numbers over all training rows: each task passes on one vector per language, so the order of tasks and the
number of rows of a language do not matter. Prototypes (dimensions x languages) go through the driver, up to `MOST_LANGUAGES`.

Defined cases: a null text or one without a letter gives `und` and 0, as does a model without languages; a null lang teaches
nothing; of equal cosines the first language in byte order wins; repeated rows count each time and each come back; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from salescube.llm import tokens

DIMENSIONS = 1024
MOST_LANGUAGES = 10_000
UNKNOWN = "und"
_CELLS = 1 << 22
_COLUMNS = 1 << 12
_TABLES: dict = {}


def _is_letter() -> np.ndarray:
    if "letter" not in _TABLES:
        _TABLES["letter"] = np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)
    return _TABLES["letter"]


def letter_vector(point: int, dimensions: int) -> np.ndarray:
    """The fixed random vector of a letter (0: the space)."""
    key = point, dimensions
    if key not in _TABLES:
        _TABLES[key] = (np.random.default_rng(point).integers(0, 2, dimensions, dtype=np.int8) * 2 - 1).astype(np.int8)
    return _TABLES[key]


def run_vectors(runs: np.ndarray, dimensions: int) -> np.ndarray:
    """One bound vector per three-letter run (packed code points)."""
    letters = np.stack([runs >> 42, (runs >> 21) & 0x1FFFFF, runs & 0x1FFFFF])
    names, at = np.unique(letters, return_inverse=True)
    table = np.stack([letter_vector(int(p), dimensions) for p in names])
    at = at.reshape(letters.shape)
    return np.roll(table, 2, axis=1)[at[0]] * np.roll(table, 1, axis=1)[at[1]] * table[at[2]]


def letter_runs(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Packed three-letter runs of all texts, and the text of each."""
    lowered = [t.lower() for t in texts]
    points = np.frombuffer(("\n" + "\n".join(lowered) + "\n").encode("utf-32-le", "replace"), np.uint32)
    text = np.repeat(np.arange(len(texts) + 1), [1 + len(t) for t in lowered] + [1])
    letter = _is_letter()[points]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[:-1] |= letter[1:]
    points = np.where(letter, points, 0)[keep].astype(np.int64)
    middle = np.flatnonzero(points)
    return points[middle - 1] << 42 | points[middle] << 21 | points[middle + 1], text[keep][middle]


def profiles(rows: np.ndarray, runs: np.ndarray, count: int, dimensions: int) -> np.ndarray:
    """Sum of the run vectors of each of `count` rows, exact in whole numbers."""
    names, at = np.unique(runs, return_inverse=True)
    out = np.zeros((count, dimensions), np.float32)
    step = max(1, _CELLS // max(count, 1))
    for low in range(0, len(names), min(step, _COLUMNS)):
        high = min(low + min(step, _COLUMNS), len(names))
        here = (at >= low) & (at < high)
        counts = np.bincount(rows[here] * (high - low) + at[here] - low, minlength=count * (high - low)).reshape(count, high - low)
        out += counts.astype(np.float32) @ run_vectors(names[low:high], dimensions).astype(np.float32)
    return out


def _texts(column: pa.Array) -> list[str]:
    return [b.decode("utf-8", "replace") if b is not None else "" for b in column.cast(pa.binary()).to_pylist()]


@dataclass
class Prototypes:
    languages: list[str]
    vectors: np.ndarray

    def __post_init__(self):
        size = np.linalg.norm(self.vectors, axis=1, keepdims=True)
        self.units = np.divide(self.vectors, size, out=np.zeros(self.vectors.shape), where=size > 0).astype(np.float32)

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        runs, rows = letter_runs(texts)
        seen = np.bincount(rows, minlength=len(texts)) > 0
        if not self.languages or not seen.any():
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        found = profiles(rows, runs, len(texts), self.vectors.shape[1])
        size = np.linalg.norm(found, axis=1)
        cosines = (found @ self.units.T) / np.maximum(size, 1e-9)[:, None]
        best = cosines.argmax(axis=1)
        score = np.clip(cosines[np.arange(len(texts)), best].astype(np.float64), 0, 1)
        return [self.languages[b] if s else UNKNOWN for b, s in zip(best.tolist(), seen.tolist())], np.where(seen, score, 0.0)


def train(documents: DataFrame, dimensions: int = DIMENSIONS) -> Prototypes:
    """Prototypes of all languages of `documents` (columns text and lang)."""

    def bundle(batches):
        held: dict[str, np.ndarray] = {}
        for rows, _, _ in tokens.text_chunks(batches):
            langs = rows.column(1).to_pylist()
            names = sorted(set(langs))
            runs, text = letter_runs(_texts(rows.column(0)))
            of_text = np.array([names.index(x) for x in langs])
            for name, vector in zip(names, profiles(of_text[text], runs, len(names), dimensions)):
                held[name] = held.get(name, 0) + vector.astype(np.int64)
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array([v.tobytes() for v in held.values()], pa.binary())], names=["lang", "vector"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(v, np.int64) for v in table.column("vector").to_pylist())
        return pa.table({"lang": [table.column("lang")[0].as_py()], "vector": pa.array([total.tobytes()], pa.binary())})

    known = documents.where("lang is not null").select("text", "lang")
    sums = known.mapInArrow(bundle, "lang string, vector binary").groupBy("lang").applyInArrow(add, "lang string, vector binary")
    found = sorted((r.lang.encode(), r.lang, r.vector) for r in sums.limit(MOST_LANGUAGES + 1).collect())
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    vectors = np.array([np.frombuffer(v, np.int64) for _, _, v in found], np.float64).reshape(len(found), dimensions)
    return Prototypes([name for _, name, _ in found], vectors)


def predict(documents: DataFrame, prototypes: Prototypes) -> DataFrame:
    """One row per document row: doc_id, lang_pred, score (the cosine, from 0 to 1)."""

    def run(batches):
        for rows, _, _ in tokens.text_chunks(batches):
            names, scores = prototypes.predict(_texts(rows.column(1)))
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(names, pa.string()), pa.array(scores)], names=["doc_id", "lang_pred", "score"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def _held_out() -> F.Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2


def op3_language_id(spark, sf_dir: str) -> DataFrame:
    """Languages of all documents, learnt from those that are not held out."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = predict(documents, train(documents.where(~_held_out())))
    return found.select("doc_id", _held_out().alias("held_out"), "lang_pred", "score")
