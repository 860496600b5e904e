"""Removal of word windows that occur twice or more in the corpus, by FM-indexes over shards of repeated context.

Words are runs of characters other than ASCII white space, unchanged. Each of a text's windows of `window` words is routed by its
minimizer, the smallest hash among its eight-word runs (the leftmost of equals): equal windows have equal minimizers, wherever
they stand. Consecutive windows with their minimizer at one place make a context (their words, `window` - 7 windows at most).

1. One pass counts minimizers. A window whose minimizer is seen once cannot repeat; the others are live. Live minimizers go to a
   sorted store in the shared folder.
2. A second pass sends each live context, equal ones of a task folded to one with a count, to the shard of its minimizer's top
   bits. A minimizer whose contexts would fill an eighth of a shard (seen more than `hot` times) sends single windows to the
   shard of the window's own hash instead, so a passage that many documents share is spread over all shards.
3. Each shard builds an FM-index of its distinct contexts (wavelet matrix over the Burrows-Wheeler transform), and streams the
   contexts backward through it: matching statistics, with occurrences weighted by the counts, tell which windows repeat.
   The answer, one bit per window, is written to a sorted store.
4. A last pass looks up each context of each document, marks the words under repeated windows, and keeps the rest.

Tasks hold one piece of text or one shard (about `shard_words` words); no text is shuffled but live contexts.

Defined cases: null or empty text has no words; texts with fewer words than a window lose none; repeated rows are occurrences of
each other; an empty table gives an empty result; doc_id may be null or repeated; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from salescube.llm import tokens
from salescube.llm.fm_index import repeated_windows
from salescube.llm.store import SortedStore, new_path, shard_bits
from salescube.sources.scratch import stage

GRAM = 8
WINDOW = 35
SHARD_WORDS = 500_000
STORE_KEYS = 4_000_000
#: A minimizer that alone would fill this share of a shard is split.
HOT_SHARE = 1 / 8


class _Contexts:
    """The contexts of a piece of text: minimizer, first and last window start."""

    def __init__(self, raw: np.ndarray, offs: np.ndarray, window: int):
        self.starts, self.ends, self.first = tokens.word_spans(raw, offs)
        self.words = tokens.word_hashes(raw, self.starts, self.ends)
        counts = tokens.runs_inside(self.first, window)
        text = np.repeat(np.arange(len(counts)), counts)
        at = self.first[:-1][text] + tokens.ramp(counts)
        grams = least = tokens.run_hashes(self.words, GRAM)
        span, reach = window - GRAM + 1, 1
        while reach * 2 <= span:
            least = np.minimum(least[:-reach], least[reach:]) if len(least) > reach else least[:0]
            reach *= 2
        smallest = np.minimum(least[at], least[at + span - reach]) if len(at) else np.zeros(0, np.uint64)
        fresh = np.ones(len(at), bool)
        fresh[1:] = (text[1:] != text[:-1]) | (smallest[1:] != smallest[:-1])
        if len(at):
            fresh[1:] |= grams[at[:-1]] == smallest[:-1]  # the minimizer fell out on the left; an equal run follows
        begun = np.flatnonzero(fresh)
        self.minimizer, self.low = tokens.mix(smallest[begun]), at[begun]  # least hashes crowd at zero; scrambled they spread over shards
        self.high = at[np.r_[begun[1:], len(at)] - 1] if len(at) else at

    def live(self, store: SortedStore, bits: int, window: int, hot: int):
        """(key, low, high) of the live contexts; a key's top bits are its shard."""
        names, back = np.unique(self.minimizer, return_inverse=True)
        found, held = store.find(names)
        found, count = found[back], held["count"][back]
        cold, warm = np.flatnonzero(found & (count <= hot)), np.flatnonzero(found & (count > hot))
        spread = self.high[warm] - self.low[warm] + 1
        single = np.repeat(self.low[warm], spread) + tokens.ramp(spread)
        low, high = np.r_[self.low[cold], single], np.r_[self.high[cold], single]
        keys = tokens.span_hashes(self.words, low, high + window)
        shard = np.r_[self.minimizer[cold], tokens.mix(keys[len(cold):])]
        keep = np.uint64(64 - bits)
        return ((shard >> keep << keep) | (keys >> np.uint64(bits)) if bits else keys), low, high


def _minimizers(window: int):
    def run(batches):
        for _, raw, offs in tokens.text_chunks(batches):
            yield pa.RecordBatch.from_arrays([pa.array(tokens.signed(_Contexts(raw, offs, window).minimizer))], names=["minimizer"])
    return run


def _live_contexts(store: SortedStore, bits: int, window: int, hot: int, fold_bytes: int = 16 << 20):
    def folded(held: dict) -> pa.RecordBatch:
        keys = np.array(list(held), np.uint64)
        return pa.RecordBatch.from_arrays([
            pa.array((keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)), pa.array(tokens.signed(keys)),
            pa.array([n for n, _ in held.values()], pa.int64()), pa.array([w for _, w in held.values()], pa.binary())],
            names=["shard", "context", "n", "words"])

    def run(batches):
        held, size = {}, 0
        for _, raw, offs in tokens.text_chunks(batches):
            parts = _Contexts(raw, offs, window)
            keys, low, high = parts.live(store, bits, window, hot)
            for key, a, b in zip(keys.tolist(), low.tolist(), (high + window).tolist()):
                n, words = held.get(key, (0, None))
                if words is None:
                    words = parts.words[a:b].tobytes()
                    size += len(words)
                held[key] = n + 1, words
            if size > fold_bytes:
                yield folded(held)
                held, size = {}, 0
        if held:
            yield folded(held)
    return run


def _search_shard(answers: SortedStore, window: int):
    def run(table: pa.Table) -> pa.Table:
        keys = table.column("context").to_numpy().view(np.uint64)
        names, first, back = np.unique(keys, return_index=True, return_inverse=True)
        weights = np.bincount(back, table.column("n").to_numpy(), len(names)).astype(np.int64)
        words = table.column("words").take(pa.array(first)).combine_chunks()
        sizes = np.array([len(w) // 8 for w in words.to_pylist()], np.int64)
        contexts = np.frombuffer(b"".join(words.to_pylist()), np.uint64)
        masks = repeated_windows(contexts, np.r_[0, np.cumsum(sizes)], weights, window)
        hit = masks > 0
        shard = table.column("shard")[0].as_py()
        answers.write(shard, names[hit], mask=masks[hit])
        return pa.table({"shard": pa.array([shard], pa.int64()), "contexts": pa.array([len(names)], pa.int64()), "repeated": pa.array([int(hit.sum())], pa.int64())})
    return run


def _write_counts(store: SortedStore):
    def run(table: pa.Table) -> pa.Table:
        keys = table.column("minimizer").to_numpy().view(np.uint64)
        order = np.argsort(keys)
        shard = table.column("shard")[0].as_py()
        store.write(shard, keys[order], count=np.minimum(table.column("n").to_numpy()[order], 2**32 - 1))
        return pa.table({"shard": pa.array([shard], pa.int64())})
    return run


def _removal(live: SortedStore, answers: SortedStore, window: int, hot: int, texts: bool):
    def run(batches):
        for rows, raw, offs in tokens.text_chunks(batches):
            parts = _Contexts(raw, offs, window)
            keys, low, _ = parts.live(live, answers.bits, window, hot)
            names, back = np.unique(keys, return_inverse=True)
            mask = answers.find(names)[1]["mask"][back]
            change = np.zeros(len(parts.words) + 1, np.int64)
            for bit in range(window - GRAM + 1):
                begun = low[(mask >> np.uint32(bit)) & 1 == 1] + bit
                np.add.at(change, begun, 1)
                np.add.at(change, begun + window, -1)
            gone = np.cumsum(change[:-1]) > 0
            yield _rows(rows, raw, offs, parts, gone, texts)
    return run


def _rows(rows, raw, offs, parts: _Contexts, gone: np.ndarray, texts: bool) -> pa.RecordBatch:
    """Counts and kept words of every text: bytes of kept words, each but a text's last followed by one space."""
    kept = np.flatnonzero(~gone)
    bounds = np.searchsorted(kept, parts.first)
    followed = np.ones(len(kept), bool)
    followed[bounds[1:][bounds[1:] > bounds[:-1]] - 1] = False
    edges = np.zeros(len(raw) + 1, np.int8)
    edges[parts.starts[kept]] += 1
    np.add.at(edges, parts.ends[kept], -1)
    keep = np.cumsum(edges[:-1], dtype=np.int8) > 0
    spaced = raw.copy()
    gaps = parts.ends[kept[followed]]
    spaced[gaps] = 32
    keep[gaps] = True
    data = spaced[keep].tobytes()
    sizes = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(keep, out=sizes[1:])
    cuts = sizes[offs]
    out = [data[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
    removed = np.zeros(len(gone) + 1, np.int64)
    np.cumsum(gone, out=removed[1:])
    arrays = [rows.column(0), pa.array(np.diff(parts.first)), pa.array(np.diff(removed[parts.first])),
              pa.array([hashlib.sha256(x).hexdigest() for x in out], pa.string())]
    names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    if texts:
        arrays.append(pa.array(out, pa.binary()).cast(pa.string()))
        names.append("kept_text")
    return pa.RecordBatch.from_arrays(arrays, names=names)


def without_repeats(documents: DataFrame, window: int = WINDOW, texts: bool = False, hot: int | None = None, shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per document row: doc_id, n_words, n_removed, kept_sha256, and with `texts` kept_text (kept words and one space)."""
    if not GRAM <= window < GRAM + 32:
        raise ValueError(f"window must be {GRAM} to {GRAM + 31} words")
    hot = int(HOT_SHARE * shard_words / (window + 10)) if hot is None else hot
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    root = new_path(spark, "windows")
    seen = docs.mapInArrow(_minimizers(window), "minimizer long").groupBy("minimizer").agg(F.count("*").alias("n")).where("n > 1")
    seen = stage(seen, "minimizers")
    total, occurrences = seen.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    live = SortedStore(root, "live", shard_bits(total, STORE_KEYS), {"count": np.uint32})
    shards = F.shiftrightunsigned("minimizer", 64 - live.bits) if live.bits else F.lit(0).cast("long")
    seen.withColumn("shard", shards).groupBy("shard").applyInArrow(_write_counts(live), "shard long").collect()
    bits = shard_bits(occurrences * (window + 10), shard_words)
    answers = SortedStore(root, "answers", bits, {"mask": np.uint32})
    contexts = docs.mapInArrow(_live_contexts(live, bits, window, hot), "shard long, context long, n long, words binary")
    contexts.groupBy("shard").applyInArrow(_search_shard(answers, window), "shard long, contexts long, repeated long").collect()
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * texts
    return docs.mapInArrow(_removal(live, answers, window, hot, texts), schema)


def op6_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Words of all documents that stay when repeated windows of 35 words are removed."""
    return without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
