"""Interpolated modified Kneser-Ney bigram model: counted in Spark, kept in sorted hash arrays, mapped into memory for scoring.

Texts are lower-cased (A-Z); tokens are words (runs of characters other than ASCII white space) and one end per text. The model is
    P(w | v) = max(c(vw) - D(c(vw)), 0) / c(v) + g(v) * Pc(w),      Pc(w) = max(k(w) - E(k(w)), 0) / K + h * 1 / (V + 1)
with c the counts, k(w) the number of distinct tokens seen before w, K their sum, D and E the modified discounts of counts 1, 2
and 3 or more, and g, h the mass that discounting frees. The text's start is the context of its first token; an unseen context
leaves Pc. V + 1 words share the uniform part, the last being all unseen ones.

1. Token counts: every task folds its tokens and sends sorted blocks of hashes to shards by their top bits; a shard merges its
   blocks and appends them to the store `words`. A token's place in all shards together is its number.
2. Bigram counts: pairs of numbers are spread by a hash of both tokens, so no frequent token gathers in one shard. A shard merges
   its blocks, appends to the store `pairs` (counts of 255 and more to the store `often`), and passes on, folded by token, how many
   distinct followers a token has that were seen once, twice or more, and how many distinct predecessors.
3. These are summed per token and become columns of the store `words`.
4. Scoring maps the stores and probes the distinct tokens and pairs of one piece of text at a time.

Blocks are columns of numbers in one binary row, so Spark moves thousands of entries per row, and shards are sized from measured
totals. A store's file holds a run of shards, which one task merges one after another: shards grow in number with the input, but files
do not, nor do the maps that scoring holds and visits for every piece of text. All counts cover all training rows. A task holds one
shard or one piece of text.

Defined cases: a null or empty text is one end token; a null doc_id is hashed as empty text for the split; an empty training set
gives N = V = 0, base scores of log10(1) and a uniform model; repeated rows count each time and each come back; other columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from salescube.llm import tokens
from salescube.llm.store import SortedStore, new_path, shard_bits
from salescube.sources.scratch import stage

END, START = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
SHARD_ENTRIES = 1_000_000
#: Top bits that give the file of a key: 256 files for each column of a store.
FILE_BITS = 8
FOLD = 600_000
_PAIR = np.uint64(0xC2B2AE3D27D4EB4F)


def _token_lists(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, each with its end, and where each text starts."""
    raw = tokens.lower(raw)
    starts, ends, first = tokens.word_spans(raw, offs)
    at = first + np.arange(len(first))
    out = np.full(at[-1], END, np.uint64)
    words = np.ones(at[-1], bool)
    words[at[1:] - 1] = False
    out[words] = tokens.word_hashes(raw, starts, ends)
    return out, at


def _pair_lists(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token and the token before it (the start for the first), for all texts."""
    now, at = _token_lists(raw, offs)
    before = np.roll(now, 1)
    before[at[:-1]] = START
    return now, before, at


def _fold(keys: np.ndarray, *sums: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted distinct keys and the sums of their values."""
    order = np.argsort(keys)
    keys = keys[order]
    begun = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[begun], *(np.add.reduceat(s[order], begun) if len(begun) else s[:0] for s in sums)


def _blocks(keys: np.ndarray, bits: int, **columns: np.ndarray):
    """Cut sorted keys at their top bits into one binary row per shard."""
    shards = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    cuts = np.flatnonzero(np.r_[True, shards[1:] != shards[:-1], True]) if len(keys) else np.zeros(1, np.int64)
    named = {"key": keys, **columns}
    arrays = [pa.array(shards[cuts[:-1]] if len(keys) else shards, pa.int64())]
    arrays += [pa.array([v[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()) for v in named.values()]
    return pa.RecordBatch.from_arrays(arrays, names=["shard", *named])


def _joined(table: pa.Table, column: str, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(column).to_pylist()), dtype)


def _narrow(counts: np.ndarray) -> np.ndarray:
    return np.minimum(counts, 2**32 - 1).astype(np.uint32)


def _count_words(bits: int):
    def run(batches):
        held, size = [], 0
        for _, raw, offs in tokens.text_chunks(batches):
            names, counts = np.unique(_token_lists(raw, offs)[0], return_counts=True)
            held.append((names, counts))
            size += len(names)
            if size > FOLD:
                yield _word_block(held, bits)
                held, size = [], 0
        if held:
            yield _word_block(held, bits)
    return run


def _word_block(held: list, bits: int) -> pa.RecordBatch:
    names, counts = _fold(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held]))
    return _blocks(names, bits, n=_narrow(counts))


def _merged(blocks: DataFrame, bits: int, run, schema: str) -> DataFrame:
    """`run` over the blocks in the order of their shards, the shards of a file in one task; a file has `bits` of a shard's bits less."""
    return blocks.repartition(F.shiftright("shard", bits)).sortWithinPartitions("shard").mapInArrow(run, schema)


def _files(batches, bits: int):
    """For sorted blocks: each file's number, and its shards with their blocks."""
    def shards():
        held, last = [], -1
        for batch in batches:
            numbers = batch.column("shard").to_numpy()
            cuts = np.flatnonzero(np.r_[True, numbers[1:] != numbers[:-1], True]) if len(numbers) else []
            for a, b in zip(cuts[:-1], cuts[1:]):
                if held and numbers[a] != last:
                    yield last, pa.Table.from_batches(held)
                    held = []
                last = int(numbers[a])
                held.append(batch.slice(a, b - a))
        if held:
            yield last, pa.Table.from_batches(held)
    return groupby(shards(), lambda shard: shard[0] >> bits)


def _merge_words(store: SortedStore, bits: int):
    def run(batches):
        for file, shards in _files(batches, bits):
            with store.appending(file, "key", "n") as add:
                for shard, table in shards:
                    names, counts = _fold(_joined(table, "key", np.uint64), _joined(table, "n", np.uint32).astype(np.int64))
                    add(key=names, n=counts)
                    yield pa.RecordBatch.from_pydict({"shard": [shard], "kinds": [len(names)], "total": [int(counts.sum())]})
    return run


def _numbers(words: SortedStore, firsts: np.ndarray, before: np.ndarray, now: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the tokens of pairs: from 1, in hash order; 0 is the start, -1 an unseen token."""
    names, back = np.unique(np.concatenate([before, now]), return_inverse=True)
    number = words.places(names, firsts)
    number = np.where(number >= 0, number + 1, -1)
    number[names == START] = 0
    return number[back[:len(before)]], number[back[len(before):]]


def pair_key(before: np.ndarray, now: np.ndarray) -> np.ndarray:
    return tokens.mix(tokens.mix(before.astype(np.uint64) * _PAIR) + now.astype(np.uint64))


def _count_pairs(words: SortedStore, firsts: np.ndarray, bits: int, width):
    def folded(held: list) -> pa.RecordBatch:
        keys, counts, before, now = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(keys)
        keys = keys[order]
        begun = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        at = order[begun]
        return _blocks(keys[begun], bits, n=_narrow(np.add.reduceat(counts[order], begun)), before=before[at], now=now[at])

    def run(batches):
        held, size = [], 0
        for _, raw, offs in tokens.text_chunks(batches):
            now, before, _ = _pair_lists(raw, offs)
            before, now = (x.astype(width) for x in _numbers(words, firsts, before, now))
            keys, first, counts = np.unique(pair_key(before, now), return_index=True, return_counts=True)
            held.append((keys, counts, before[first], now[first]))
            size += len(keys)
            if size > FOLD:
                yield folded(held).drop_columns(["key"])
                held, size = [], 0
        if held:
            yield folded(held).drop_columns(["key"])
    return run


def _merge_pairs(pairs: SortedStore, often: SortedStore, bits: int, firsts: np.ndarray, width):
    def merged(table: pa.Table) -> tuple[np.ndarray, np.ndarray, pa.RecordBatch]:
        before, now = _joined(table, "before", width), _joined(table, "now", width)
        keys, counts = pair_key(before, now), _joined(table, "n", np.uint32).astype(np.int64)
        order = np.argsort(keys)
        keys = keys[order]
        begun = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        counts, keys, at = np.add.reduceat(counts[order], begun), keys[begun], order[begun]
        followed = _fold(before[at].astype(np.int64), *((counts == k).astype(np.int64) for k in (1, 2)), (counts > 2).astype(np.int64))
        preceded = _fold(now[at].astype(np.int64), np.ones(len(at), np.int64))
        numbers = np.concatenate([followed[0], preceded[0]])
        none = [np.zeros(len(x[0]), np.int64) for x in (preceded, followed)]
        numbers, *sums = _fold(numbers, *(np.concatenate([f, none[0]]) for f in followed[1:]), np.concatenate([none[1], preceded[1]]))
        owner = np.searchsorted(firsts, np.maximum(numbers - 1, 0), side="right") - 1
        cuts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1], True])
        columns = {"number": numbers.astype(width), **dict(zip(_PARTS, map(_narrow, sums)))}
        seen = np.bincount(np.minimum(counts, 5), minlength=6)[1:5].tolist()
        out = {"shard": pa.array(owner[cuts[:-1]])}
        out |= {c: pa.array([v[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()) for c, v in columns.items()}
        return keys, counts, pa.RecordBatch.from_pydict(out | {"seen": pa.array([seen] + [None] * (len(cuts) - 2), pa.list_(pa.int64()))})

    def run(batches):
        for file, shards in _files(batches, bits):
            with pairs.appending(file, "key", "n") as add, often.appending(file, "key", "n") as add_often:
                for _, table in shards:
                    keys, counts, contexts = merged(table)
                    add(key=keys, n=np.minimum(counts, 255))
                    add_often(key=keys[counts >= 255], n=counts[counts >= 255])
                    yield contexts
    return run


_PARTS = ("one", "two", "more", "preceded")


def _merge_contexts(words: SortedStore, bits: int, bounds: np.ndarray, width):
    """`bounds`: the places of each shard's first key, and the end."""
    def run(batches):
        for file, shards in _files(batches, bits):
            with words.appending(file, *_PARTS) as add:
                for shard, table in shards:
                    number = _joined(table, "number", width).astype(np.int64)
                    sums = {}
                    for column in _PARTS:
                        sums[column] = np.zeros(bounds[shard + 1] - bounds[shard] + 1, np.int64)
                        np.add.at(sums[column], np.where(number > 0, number - bounds[shard], 0), _joined(table, column, np.uint32).astype(np.int64))
                    add(**{c: _narrow(v[1:]) for c, v in sums.items()})
                    seen = np.bincount(np.minimum(sums["preceded"][1:], 5), minlength=6)[1:6].tolist()
                    start = [int(sums[c][0]) for c in _PARTS[:3]]
                    yield pa.RecordBatch.from_pydict({"shard": [shard], "seen": [seen], "total": [int(sums["preceded"].sum())], "start": [start]})
    return run


def _discounts(seen: list[int]) -> np.ndarray:
    """Modified Kneser-Ney discounts of counts 1, 2 and 3 or more from the numbers of things seen 1, 2, 3 and 4 times."""
    n1, n2, n3, n4 = (float(x) for x in seen[:4])
    if not n1 or not n2 or not n3:
        return np.array([0.0, 0.5, 0.5, 0.5])
    y = n1 / (n1 + 2 * n2)
    return np.array([0.0, *np.clip([1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3], 0.05, [0.95, 1.9, 2.85])])


@dataclass
class Model:
    """Stores in the shared folder and the few global numbers of the model."""

    words: SortedStore
    firsts: np.ndarray
    pairs: SortedStore
    often: SortedStore
    total: int
    kinds: int
    texts: int
    start: list[int]
    discounts: np.ndarray
    low_discounts: np.ndarray
    continuations: int
    low_rest: float

    def log10(self, now: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 P(now | before), and the training counts of `now`."""
        names, back = np.unique(np.concatenate([now, before]), return_inverse=True)
        now_at, before_at = back[:len(now)], back[len(now):]
        parts = {c: v.astype(np.float64) for c, v in self.words.find(names)[1].items()}
        first = names == START
        for column, value in zip(("n", "one", "two", "more"), (self.texts, *self.start)):
            parts[column][first] = value
        kept = np.maximum(parts["preceded"] - self.low_discounts[np.minimum(parts["preceded"], 3).astype(np.int64)], 0)
        low = kept / max(self.continuations, 1) + self.low_rest / (self.kinds + 1)
        freed = self.discounts[1] * parts["one"] + self.discounts[2] * parts["two"] + self.discounts[3] * parts["more"]
        rest = np.where(parts["n"] > 0, freed / np.maximum(parts["n"], 1), 1.0)
        keys, pair_at = np.unique(pair_key(*_numbers(self.words, self.firsts, before, now)), return_inverse=True)
        seen = self.pairs.find(keys)[1]["n"].astype(np.int64)
        many = np.flatnonzero(seen == 255)
        seen[many] = self.often.find(keys[many])[1]["n"]
        seen = seen.astype(np.float64)[pair_at]
        high = np.maximum(seen - self.discounts[np.minimum(seen, 3).astype(np.int64)], 0) / np.maximum(parts["n"][before_at], 1)
        count = np.where(first, 0, parts["n"])[now_at]
        return np.log10(high + rest[before_at] * low[now_at]), count


def train(documents: DataFrame) -> Model:
    """The model of all rows of `documents` (column text)."""
    spark = documents.sparkSession
    texts = documents.select("text")
    rows, size = texts.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    root = new_path(spark, "model")
    bits = shard_bits(rows + size // 6, SHARD_ENTRIES, int(spark.conf.get("spark.sql.shuffle.partitions", "8")))
    files = min(bits, FILE_BITS)
    words = SortedStore(root, "words", files, {"n": np.int64, **dict.fromkeys(_PARTS, np.uint32)})
    counted = _merged(texts.mapInArrow(_count_words(bits), "shard long, key binary, n binary"), bits - files,
                      _merge_words(words, bits - files), "shard long, kinds long, total long").collect()
    kinds, total = sum(r.kinds for r in counted), sum(r.total for r in counted)
    sizes = np.zeros(1 << bits, np.int64)
    for r in counted:
        sizes[r.shard] = r.kinds
    ends = np.r_[0, np.cumsum(sizes)]
    firsts = ends[:-1:1 << (bits - files)]
    width = np.uint32 if kinds < 2**32 - 1 else np.uint64

    pairs, often = SortedStore(root, "pairs", files, {"n": np.uint8}), SortedStore(root, "often", files, {"n": np.int64})
    named = min(bits, max(files, shard_bits(kinds, SHARD_ENTRIES)))  # contexts are as many as tokens, far fewer than pairs
    bounds = ends[::1 << (bits - named)]
    schema = "shard long, number binary, " + ", ".join(f"{c} binary" for c in _PARTS)
    blocks = texts.mapInArrow(_count_pairs(words, firsts, bits, width), "shard long, n binary, before binary, now binary")
    merged = stage(_merged(blocks, bits - files, _merge_pairs(pairs, often, bits - files, bounds[:-1], width), schema + ", seen array<long>"), "contexts")
    seen = merged.select(*(F.coalesce(F.sum(F.col("seen")[k]), F.lit(0)) for k in range(4))).first()
    done = _merged(merged.drop("seen"), named - files, _merge_contexts(words, named - files, bounds, width),
                   "shard long, seen array<long>, total long, start array<long>").collect()
    lower = [sum(r.seen[k] for r in done) for k in range(5)]
    continuations = sum(r.total for r in done)
    start = [sum(r.start[k] for r in done) for k in range(3)]
    low = _discounts(lower[:4])
    freed = low[1] * lower[0] + low[2] * lower[1] + low[3] * (lower[2] + lower[3] + lower[4])
    return Model(words, firsts, pairs, often, total, kinds, rows, start, _discounts(seen), low, continuations, freed / continuations if continuations else 1.0)


def score(documents: DataFrame, model: Model) -> DataFrame:
    """One row per document row: doc_id, n_tokens, n_known, train_tokens, base_score, score, perplexity."""

    def run(batches):
        for rows, raw, offs in tokens.text_chunks(batches):
            now, before, at = _pair_lists(raw, offs)
            logs, counts = model.log10(now, before)
            base = np.log10((counts + 1) / (model.total + model.kinds + 1))
            sums = [np.add.reduceat(x, at[:-1]) for x in (base, logs)]
            n = np.diff(at)
            yield pa.RecordBatch.from_arrays([
                rows.column(0), pa.array(n), pa.array(np.add.reduceat((counts > 0).astype(np.int64), at[:-1])),
                pa.array(np.full(len(n), model.total)), *map(pa.array, sums), pa.array(10.0 ** (-sums[1] / n))],
                names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])

    schema = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def _held_out() -> F.Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2


def op1_lm_scoring(spark, sf_dir: str) -> DataFrame:
    """All documents under the model of those that are not held out."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scored = score(documents, train(documents.where(~_held_out())))
    return scored.withColumn("held_out", _held_out()).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")
