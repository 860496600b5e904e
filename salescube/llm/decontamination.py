"""Benchmark decontamination: short test items inside long documents.

Texts are lower-cased (A-Z) and split into words at ASCII punctuation and white space; a text's set is its distinct five-word
shingles, hashed to 64 bits (a text of one to four words has its whole sequence as one shingle). A document leaks an item if it
contains at least `threshold` of the item's set. Against items of n < 5 words a document also has its runs of n words, so that they
are found inside longer documents; this is done for those n that the benchmark has.

Search. Items are partitioned by set size. A partition whose largest set has u shingles keeps of every item the MinHash sketch
of its k = u - ceil(threshold * u) + 1 smallest hashes (all, if it has fewer). A document with a share of `threshold` of an
item misses at most k - 1 of its shingles, so it holds one of any k: the sketches propose every true pair. A document's shingle
hashes are streamed past the sorted sketches of all partitions; every item with a hit is verified on its whole set, in the same
task, so no document is shuffled.

Items come in blocks of at most `block_shingles` shingles, by a stable hash of the item, so that what a task holds is bounded
for any size of the benchmark; each block is one pass over the documents.

Defined cases: a null or empty document, or one without words, leaks nothing; null or wordless items are never leaked; of equal
containments the smallest item_id is named; repeated rows are judged one by one; an empty benchmark leaves all documents clean;
extra columns are ignored by `scan` and kept by `clean`, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from salescube.llm import tokens
from salescube.llm.store import get, new_path, put

WORDS = 5
THRESHOLD = 0.8
BLOCK_SHINGLES = 4_000_000
_SPACED = np.arange(256, dtype=np.uint8)
_SPACED[65:91] += 32
for _low, _high in ((0, 48), (58, 65), (91, 97), (123, 128)):
    _SPACED[_low:_high] = 32


def _words(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes, and the number of each text's first word."""
    raw = _SPACED[raw]
    starts, ends, first = tokens.word_spans(raw, offs)
    return tokens.word_hashes(raw, starts, ends), first


def shingles(raw: np.ndarray, offs: np.ndarray, short: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's shingles and of its runs of as many words as `short` has, and where each text's hashes start."""
    words, first = _words(raw, offs)
    hashes, at = tokens.shingle_lists(words, first, WORDS)
    if not short:
        return hashes, at
    lists = [(hashes, at), *(tokens.shingle_lists(words, first, n) for n in short)]
    texts = np.concatenate([np.repeat(np.arange(len(a) - 1), np.diff(a)) for _, a in lists])
    return np.concatenate([h for h, _ in lists])[np.argsort(texts, kind="stable")], np.sum([a for _, a in lists], axis=0)


def size_partition(size: int) -> int:
    """Sets of 2**(p-1) < size <= 2**p shingles are partition p."""
    return max(size - 1, 0).bit_length()


def sketch_size(partition: int, threshold: float) -> int:
    largest = 1 << partition
    return largest - math.ceil(threshold * largest - 1e-9) + 1


def _item_sets(batches):
    """Rows (item_id, words, hash): the shingles of every row, and the number of words in a shingle."""
    for rows, raw, offs in tokens.text_chunks(batches):
        words, first = _words(raw, offs)
        hashes, at = tokens.shingle_sets(words, first, WORDS)
        sizes = np.diff(at)
        ids = rows.column(0).take(pa.array(np.repeat(np.arange(len(sizes)), sizes)))
        lengths = np.repeat(np.minimum(np.diff(first), WORDS), sizes)
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(lengths), pa.array(tokens.signed(hashes))], names=["item_id", "words", "hash"])


class Block:
    """Sketches and whole sets of one block of items, in sorted arrays."""

    def __init__(self, uri: str, threshold: float):
        item, hashes = get(f"{uri}/item", np.int64), get(f"{uri}/hash", np.int64).view(np.uint64)
        self.short = tuple(n for n in np.unique(get(f"{uri}/words", np.int64)).tolist() if n < WORDS)
        order = np.lexsort((hashes, item))
        hashes, item = hashes[order], item[order]
        first = np.ones(len(item), bool)  # rows of one item may share shingles
        first[1:] = (item[1:] != item[:-1]) | (hashes[1:] != hashes[:-1])
        self.hash, item = hashes[first], item[first]
        fresh = np.flatnonzero(np.r_[True, item[1:] != item[:-1]]) if len(item) else np.zeros(0, np.int64)
        self.items, self.at, self.threshold = item[fresh], np.r_[fresh, len(item)], threshold
        sizes = np.diff(self.at)
        kept = np.minimum(sizes, [sketch_size(size_partition(int(n)), threshold) for n in sizes]) if len(sizes) else sizes
        owner = np.repeat(np.arange(len(fresh)), kept)
        sketch = self.hash[np.repeat(fresh, kept) + tokens.ramp(kept)]
        order = np.argsort(sketch, kind="stable")
        self.sketch, self.owner = sketch[order], owner[order]
        self.top = np.zeros(1 << 16, bool)
        self.top[(self.sketch >> np.uint64(48)).astype(np.int64)] = True

    def leaks(self, hashes: np.ndarray, at: np.ndarray):
        """(text, item, shared, size) of all verified pairs, for texts with the shingles hashes[at[text]:at[text + 1]]."""
        maybe = np.flatnonzero(self.top[(hashes >> np.uint64(48)).astype(np.int64)])
        probes = hashes[maybe]
        low, high = np.searchsorted(self.sketch, probes), np.searchsorted(self.sketch, probes, side="right")
        hit = high > low
        texts = np.searchsorted(at, maybe[hit], side="right") - 1
        counts = (high - low)[hit]
        owners = self.owner[np.repeat(low[hit], counts) + tokens.ramp(counts)]
        for text, item in sorted(set(zip(np.repeat(texts, counts).tolist(), owners.tolist()))):
            mine = self.hash[self.at[item]:self.at[item + 1]]
            shared = int(np.isin(mine, hashes[at[text]:at[text + 1]]).sum())
            if shared >= self.threshold * len(mine) - 1e-9:
                yield text, int(self.items[item]), shared, len(mine)


def _blocks(benchmark: DataFrame, threshold: float, block_shingles: int) -> list[str]:
    """Write each block's shingles to the shared folder; returns the blocks' folders."""
    spark = benchmark.sparkSession
    total = benchmark.select(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-(total // 2) // block_shingles))
    root = new_path(spark, "benchmark")
    sets = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null").dropDuplicates(
        ["item_id", "text"]).mapInArrow(_item_sets, "item_id long, words long, hash long")
    sets = sets.withColumn("block", F.expr(f"pmod(xxhash64(item_id), {count})"))

    def write(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py() if len(table) else 0
        for column in ("item_id", "words", "hash"):
            put(f"{root}/{block}/{column.removesuffix('_id')}", table.column(column).to_numpy())
        return pa.table({"block": pa.array([block], pa.int64())})

    return [f"{root}/{r.block}" for r in sets.groupBy("block").applyInArrow(write, "block long").collect()]


def _marked(documents: DataFrame, benchmark: DataFrame, threshold: float, block_shingles: int) -> tuple[DataFrame, str, str]:
    """The documents with two more columns, named so that they clash with none: the item most contained and its containment."""
    item, share = "leaked_item", "leaked_share"
    while {item, share} & {c.lower() for c in documents.columns}:
        item, share = item + "_", share + "_"
    width = len(documents.columns)
    out = documents.withColumns({item: F.lit(None).cast("long"), share: F.lit(None).cast("double")})

    def search(uri: str):
        def run(batches):
            block = Block(uri, threshold)
            for rows, raw, offs in tokens.text_chunks(batches):
                best = {i: (s, -n) for i, (n, s) in enumerate(zip(*(c.to_pylist() for c in rows.columns[width:]))) if s is not None}
                for text, item_id, shared, size in block.leaks(*shingles(raw, offs, block.short)):
                    best[text] = max(best.get(text, (-1.0, 0)), (shared / size, -item_id))
                found = [best.get(i) for i in range(rows.num_rows)]
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns[:width], pa.array([f and -f[1] for f in found], pa.int64()),
                     pa.array([f and f[0] for f in found], pa.float64())], schema=rows.schema)
        return run

    for uri in _blocks(benchmark, threshold, block_shingles):
        out = out.mapInArrow(search(uri), out.schema)
    return out, item, share


def scan(documents: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """One row per document row: doc_id, `item_id` (the item most contained in it, null if none), `containment`, `contaminated`.

    `documents` needs `doc_id` and `text`, `benchmark` needs `item_id` and `text`; rows of one item_id make up one item.
    """
    out, item, share = _marked(documents.select("doc_id", "text"), benchmark, threshold, block_shingles)
    return out.select("doc_id", F.col(item).alias("item_id"), F.col(share).alias("containment"), F.col(item).isNotNull().alias("contaminated"))


def clean(documents: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """The documents that leak no item, with the columns they had."""
    out, item, share = _marked(documents, benchmark, threshold, block_shingles)
    return out.where(F.col(item).isNull()).drop(item, share)


def op9_decontamination(spark, sf_dir: str) -> DataFrame:
    """Leaks of all benchmark items in all documents."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
