"""Toxicity by compression distance: how much shorter a text gets with a dictionary of toxic text than with one of ordinary text.

Fit, on the driver, on a bounded sample of labelled rows (`SAMPLE` texts per class of at most `SAMPLE_BYTES` bytes each, those with
the smallest hash of doc_id):
1. A zstandard dictionary is trained on the ordinary texts. The toxic word dictionary holds, in front of the same content, the words
   that toxic texts have significantly more often than ordinary ones (exact one-sided test, p below `SIGNIFICANT` over the number of
   words tried), if all their runs of `PIECE` bytes are in toxic texts at `LIFT` times the ordinary share or more (matches of
   compression need no whole word, and this pair takes none shorter than `PIECE`, which the shares would not cover). Matches with
   ordinary content cost the same with either, so the lengths differ by toxic content alone. Windows of `WINDOW` words are compressed with both. A text's measures are its largest gain, the mean of its three
   largest, its mean gain, and the logarithm of the number of windows that gain `CLEAR` bytes or more.
2. Two more zstandard dictionaries of equal size, of at most `TRAINED_BYTES`, are trained on the toxic and on the ordinary texts, for
   phrases and spellings that no single word shows. Windows of `WIDE` words are compressed with both; the measures are the largest
   and the mean gain. For the fit a text is measured with dictionaries that it did not train (`FOLDS` parts of the sorted sample).
3. A logistic curve over these measures, fitted by Newton steps, calibrates the score; a text is called toxic at `THRESHOLD`.
   Sampled texts weigh as many as all labelled documents of their class, so the curve does not follow the sample's shares.
   Its constant is then shifted so that `THRESHOLD` stands where `PRECISION` of the sample's texts called toxic are toxic (within
   `CUTS` of the curve's own values): the threshold follows what it gets wrong, not how steep the curve came out.

Scoring covers all windows of whole texts, in tasks that hold the four dictionaries (about a hundred kilobytes) and one piece of text.

Defined cases: null and empty texts score as a text without gain; without labels of both classes every score is the share of toxic
labels (0 without any); rows with a null label teach nothing, a doc_id with labels of both kinds counts as toxic; repeated rows
each come back; an empty table gives an empty result; columns with other names are ignored by `scored` and kept by `clean`.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from salescube.llm import tokens

SAMPLE, SAMPLE_BYTES = 2_000, 32_000
SIGNIFICANT, PIECE, LIFT = 0.01, 6, 6.0
WINDOW, CLEAR, THRESHOLD = 8, 2, 0.7
PRECISION, CUTS = 0.95, (0.5, 0.7)
DICTIONARY_BYTES = 1 << 13
TRAINED_BYTES, WIDE, FOLDS = 1 << 15, 32, 4
LEVEL = 5
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_EDGES = b".,;:!?|*#$%&()[]<>\"'"
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def _words(text: bytes) -> list[bytes]:
    return _WORD.findall(text.translate(_LOWER))


def _log_choose(n: int, k: int) -> float:
    return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)


def _log_p(n: int, held: int, toxic: int, total: int) -> float:
    """Log of the chance that n or more of the `held` texts with a word are among the `toxic` ones of `total` (Fisher's exact test)."""
    term = tail = 1.0
    for i in range(n, min(held, toxic)):
        term *= (toxic - i) * (held - i) / ((i + 1) * (total - toxic - held + i + 1))
        tail += term
        if term < 1e-12 * tail:
            break
    return _log_choose(toxic, n) + _log_choose(total - toxic, held - n) - _log_choose(total, held) + math.log(tail)


def _pieces(word: bytes) -> set[bytes]:
    word = b" " + word + b" "
    return {word[i:i + PIECE] for i in range(max(1, len(word) - PIECE + 1))}


def distinctive_words(toxic: list[list[bytes]], ordinary: list[list[bytes]]) -> list[bytes]:
    """Words of toxic texts by significance, the strongest last (nearest to the content that follows)."""
    texts = [[{w.strip(_EDGES) for w in words} - {b""} for words in side] for side in (ordinary, toxic)]
    seen = [Counter(w for words in side for w in words) for side in texts]
    total, limit = len(toxic) + len(ordinary), math.log(SIGNIFICANT / max(1, len(seen[1])))
    strength = {}
    for word, n in seen[1].items():
        held = n + seen[0][word]
        if n * total > held * len(toxic) and (p := _log_p(n, held, len(toxic), total)) < limit:
            strength[word] = -p
    wanted = set().union(*map(_pieces, strength))
    parts = {w: _pieces(w) & wanted for w in seen[0].keys() | seen[1].keys()} if wanted else {}
    shares = [Counter(x for words in side for x in set().union(*(parts[w] for w in words))) if wanted else {} for side in texts]

    def clear(word: bytes) -> bool:
        return all(shares[1][x] * len(ordinary) >= LIFT * shares[0][x] * len(toxic) for x in _pieces(word))

    return [w for s, w in sorted((s, w) for w, s in strength.items()) if clear(w)]


def _spaced(words: list[bytes]) -> bytes:
    return b" " + b" ".join(words) + b" "


def _content(texts: list[list[bytes]], size: int = DICTIONARY_BYTES) -> bytes:
    """What zstandard's training picks from the samples; too few samples are taken as they are."""
    samples = [_spaced(w) for w in texts if w] or [b" "]
    try:
        trained = zstandard.train_dictionary(size, samples)
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]
    return trained.as_bytes()[-(size - 600):]


def _trained(toxic: list[list[bytes]], ordinary: list[list[bytes]]) -> tuple[bytes, bytes]:
    """Ordinary and toxic content of equal size, each from texts of its class."""
    both = [_content(texts, TRAINED_BYTES) for texts in (ordinary, toxic)]
    size = min(map(len, both))
    return both[0][-size:], both[1][-size:]


def _compressor(content: bytes, shortest: int = 4):
    setting = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, min_match=shortest, window_log=17, write_content_size=False, write_checksum=False, write_dict_id=False)
    held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    held.precompute_compress(compression_params=setting)
    return zstandard.ZstdCompressor(compression_params=setting, dict_data=held).compress


def _gains(words: list[bytes], width: int, ordinary, toxic) -> np.ndarray:
    """Bytes that the toxic compressor saves in each window, the largest first."""
    windows = [_spaced(words[i:i + width]) for i in range(0, len(words), width)]
    return np.sort(np.array([len(ordinary(w)) - len(toxic(w)) for w in windows] or [0]))[::-1]


def _style(words: list[bytes], ordinary, toxic) -> list[float]:
    gains = _gains(words, WIDE, ordinary, toxic)
    return [float(gains[0]) * WINDOW / WIDE, float(gains.mean()) * WINDOW / WIDE]


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    trained: tuple[bytes, bytes] = (b"", b"")
    weights: np.ndarray = None
    constant: float | None = None
    tools: list = field(default_factory=list, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "tools": []}

    def measures(self, text: bytes, trained: list | None = None) -> list[float]:
        """Measures of a text; `trained` are compressors to take in place of those of all texts."""
        if not self.tools:
            self.tools += [_compressor(c, PIECE) for c in (self.ordinary, self.toxic)] + [_compressor(c) for c in self.trained]
        words = _words(text)
        gains = _gains(words, WINDOW, *self.tools[:2])
        return [1.0, float(gains[0]), float(gains[:3].mean()), float(gains.mean()), math.log1p(int((gains >= CLEAR).sum())),
                *_style(words, *(trained or self.tools[2:]))]

    def score(self, text: bytes) -> float:
        if self.constant is not None:
            return self.constant
        return float(1 / (1 + math.exp(-max(-30.0, min(30.0, float(np.dot(self.weights, self.measures(text))))))))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.05, steps: int = 50) -> np.ndarray:
    weights = np.zeros(x.shape[1])
    penalty = np.eye(x.shape[1]) * ridge
    penalty[0, 0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + penalty, x.T @ (weight * (y - p)) - penalty @ weights)
        weights += step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def _cut(scores: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The lowest score, between the `CUTS`, down to which at least `PRECISION` of what is called toxic is; two more wrong calls are
    counted than there are, so that few texts prove little."""
    order = np.argsort(-scores, kind="stable")
    called = np.arange(1, len(order) + 1)
    right = np.cumsum((weight * y)[order]) / np.cumsum(weight[order]) * called / (called + 2)
    fine = np.flatnonzero(right >= PRECISION)
    return float(np.clip(scores[order[fine[-1]]] if len(fine) else 1.0, *CUTS))


def fit(texts: list[bytes], toxic: list[int], counts: dict[int, int] | None = None) -> Model:
    """A model of labelled texts; equal texts count once. `counts` has the documents of each class that the texts stand for."""
    known = sorted({(t, y) for t, y in zip(texts, toxic)})
    if len({y for _, y in known}) < 2:
        return Model(b"", b"", constant=float(np.mean([y for _, y in known])) if known else 0.0)
    sampled = Counter(toxic)
    standing = [(counts or sampled)[y] / sampled[y] for _, y in known]
    fold = np.arange(len(known)) * FOLDS // len(known)  # near copies are neighbours and stay in one part

    words = [_words(t) for t, _ in known]

    def split(part: int) -> list[list[list[bytes]]]:
        return [[w for w, (_, y), f in zip(words, known, fold) if y == k and f != part] for k in (1, 0)]

    toxic_words, ordinary_words = split(-1)
    content = _content(ordinary_words)
    model = Model(content, _spaced(distinctive_words(toxic_words, ordinary_words)) + content, _trained(toxic_words, ordinary_words))
    others = [[*map(_compressor, _trained(*split(f)))] for f in range(FOLDS)]
    x = np.array([model.measures(t, others[f]) for (t, _), f in zip(known, fold)])
    weight = np.array(standing) * len(known) / sum(standing)
    y = np.array([float(y) for _, y in known])
    model.weights = _logistic(x, y, weight)
    cut = _cut(1 / (1 + np.exp(-np.clip(x @ model.weights, -30, 30))), y, weight)
    model.weights[0] += math.log(THRESHOLD / (1 - THRESHOLD)) - math.log(cut / (1 - cut))
    return model


def train(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on the sample of documents (doc_id, text) that labels (doc_id, toxic) cover."""
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    short = documents.where(f"octet_length(text) <= {SAMPLE_BYTES}")
    ids = short.select("doc_id").join(known, "doc_id").distinct()
    picked = []
    for kind in (0, 1):
        picked += ids.where(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).collect()
    chosen = F.broadcast(documents.sparkSession.createDataFrame(picked, ids.schema))  # two ids per sampled text at most
    texts = short.select("doc_id", F.col("text").cast("binary").alias("text")).join(chosen, "doc_id").groupBy("doc_id").agg(
        F.min("text").alias("text"), F.max("toxic").alias("toxic")).collect()
    counts = documents.select("doc_id").join(known, "doc_id").distinct().groupBy("toxic").count().collect()
    return fit([bytes(r.text) for r in texts], [r.toxic for r in texts], {r[0]: r[1] for r in counts})


def _score(model: Model):
    def run(batches):
        for rows, raw, offs in tokens.text_chunks(batches):
            data = raw.tobytes()
            scores = [model.score(data[a:b]) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())]
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(scores, pa.float64())], names=[*rows.schema.names, "score"])
    return run


def scored(documents: DataFrame, model: Model) -> DataFrame:
    """One row per document row: doc_id, score, predicted."""
    out = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_score(model), "doc_id long, text string, score double")
    return out.select("doc_id", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def clean(documents: DataFrame, model: Model) -> DataFrame:
    """The documents that are not called toxic, with the columns they had."""
    verdict = "toxic_score"
    while verdict in {c.lower() for c in documents.columns}:
        verdict += "_"

    def run(batches):
        for batch in _score(model)(batches):
            yield batch.rename_columns([*documents_columns, verdict])

    documents_columns = documents.columns
    fields = documents.withColumn(verdict, F.lit(0.0)).schema
    return documents.mapInArrow(run, fields).where(F.col(verdict) < THRESHOLD).drop(verdict)


def _held_out() -> F.Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learnt from labels of those that are not held out."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(documents.where(~_held_out()), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored(documents, model).select("doc_id", _held_out().alias("held_out"), "score", "predicted")
