"""Removal of lines that many documents repeat, by levelled sorted runs of line hashes.

A text is split at newlines. A line's key is the line without ASCII white space at both ends, A-Z in lower case, named by two
64-bit hashes. Keys of at least `min_chars` code points found in at least `min_docs` documents lose all their lines except in the
largest doc_id that holds them; the other lines stay as they are, joined by newlines.

`LineRuns` is the memory of all lines seen. A run is a sorted array of entries (key, documents, largest doc_id), in shards by the
key's top bits, in the shared folder. Adding a batch:

1. One pass hashes the batch's lines; each task folds equal lines before anything moves, so a line that a third of all documents
   hold costs a task one entry.
2. Each shard merges the batch's entries and looks them up in every run (merge anti-join): an entry whose key the runs already
   hold `min_docs` times under a doc_id as large is settled and dropped. The others become the batch's own run, at level 0.
3. Whenever a level holds `fanout` runs, one task per shard merges them into one run of the next level, so a batch looks through
   a logarithmic number of runs and each entry is rewritten once per level.

`without_repeats` feeds a table in batches from the largest doc_ids down (so a key's keeper comes first and settled keys stay out
of later runs), draws the repeated keys out of the runs, and looks up the lines of every document in them.

Tasks hold one piece of text, or one shard of a batch; runs are mapped into memory. Files appear whole under their names and are
the same when a task is repeated, so lost executors leave right runs; merged runs go only after their successor stands.

Defined cases: null or empty text is one empty line; each row is a document of its own (a repeated row counts again, and all rows
of the largest doc_id keep their lines); a row without doc_id counts as smaller than all others, and if only such rows hold a key,
all keep it; an empty table gives an empty result; a text longer than a piece of 1 MB is a piece of its own; columns named like
results are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from salescube.llm import tokens
from salescube.llm.store import SortedStore, new_path, shard_bits

MIN_DOCS, MIN_CHARS = 5, 40
BATCHES, FANOUT = 8, 4
SHARD_ENTRIES = 1 << 19
_FOLD = 1 << 17
_NO_ID = np.iinfo(np.int64).min
_ENTRY = np.dtype([("key", "<u8"), ("check", "<u8"), ("docs", "<i8"), ("last", "<i8")])
_VALUES = {"check": np.uint64, "docs": np.int64, "last": np.int64}
_OTHER = np.random.default_rng(11).permutation(256).astype(np.uint8)


class _Lines:
    """The lines of a piece of text: their spans, which text each belongs to, and the names of those with long keys."""

    def __init__(self, raw: np.ndarray, offs: np.ndarray, min_chars: int):
        texts, breaks = len(offs) - 1, np.flatnonzero(raw == 10)
        owner = np.searchsorted(offs, breaks, side="right") - 1
        before = np.searchsorted(breaks, offs)
        self.first = np.arange(texts + 1) + before
        self.starts, self.ends = np.zeros(texts + len(breaks), np.int64), np.zeros(texts + len(breaks), np.int64)
        at = np.arange(len(breaks)) + owner
        self.starts[self.first[:-1]], self.ends[self.first[1:] - 1] = offs[:-1], offs[1:]
        self.starts[at + 1], self.ends[at] = breaks + 1, breaks
        ink = np.flatnonzero(~tokens._IS_SPACE[raw])
        a, b = np.searchsorted(ink, self.starts), np.searchsorted(ink, self.ends)
        points = np.zeros(len(raw) + 1, np.int64)
        np.cumsum((raw & 0xC0) != 0x80, out=points[1:])
        some = np.flatnonzero(b > a)
        low, high = ink[a[some]], ink[b[some] - 1] + 1
        long = points[high] - points[low] >= min_chars
        self.long, low, high = some[long], low[long], high[long]
        small = tokens.lower(raw)
        self.key, self.check = tokens.word_hashes(small, low, high), tokens.word_hashes(_OTHER[small], low, high)
        self.text = np.searchsorted(self.first, self.long, side="right") - 1


def _merged(entries: np.ndarray) -> np.ndarray:
    """Sorted by key and check, equal ones made one."""
    entries = entries[np.lexsort((entries["check"], entries["key"]))]
    if not len(entries):
        return entries
    begin = np.ones(len(entries), bool)
    begin[1:] = (entries["key"][1:] != entries["key"][:-1]) | (entries["check"][1:] != entries["check"][:-1])
    at = np.flatnonzero(begin)
    out = entries[at].copy()
    out["docs"], out["last"] = np.add.reduceat(entries["docs"], at), np.maximum.reduceat(entries["last"], at)
    return out


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index("doc_id"))
    return column.fill_null(int(_NO_ID)).to_numpy(zero_copy_only=False).astype(np.int64)


def _line_entries(bounds: list[int], bits: int, min_chars: int):
    """Folded entries of a task's lines, one block per batch (by the bounds of doc_id) and shard."""
    def blocks(held: list[np.ndarray], groups: list[np.ndarray]):
        entries, group = np.concatenate(held), np.concatenate(groups)
        for number in np.unique(group):
            folded = _merged(entries[group == number])
            shards = (folded["key"] >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(folded), np.int64)
            cuts = np.r_[0, np.flatnonzero(np.diff(shards)) + 1, len(folded)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(cuts) - 1, number, np.int64)), pa.array(shards[cuts[:-1]]), pa.array(np.diff(cuts)),
                 pa.array([folded[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:])], pa.binary())],
                names=["batch", "shard", "n", "entries"])

    def run(batches):
        held, groups, size = [], [], 0
        for rows, raw, offs in tokens.text_chunks(batches):
            lines, ids = _Lines(raw, offs, min_chars), _ids(rows)
            entries = np.zeros(len(lines.long), _ENTRY)
            entries["key"], entries["check"], entries["docs"], entries["last"] = lines.key, lines.check, 1, ids[lines.text]
            order = np.lexsort((lines.check, lines.key, lines.text))
            entries, text = entries[order], lines.text[order]
            fresh = np.ones(len(entries), bool)  # a text counts once for a key
            fresh[1:] = (text[1:] != text[:-1]) | (entries["key"][1:] != entries["key"][:-1]) | (entries["check"][1:] != entries["check"][:-1])
            entries = entries[fresh]
            held.append(entries)
            groups.append(len(bounds) - np.searchsorted(bounds, entries["last"], side="right"))
            size += len(entries)
            if size >= _FOLD:
                yield from blocks(held, groups)
                held, groups, size = [], [], 0
        if size:
            yield from blocks(held, groups)
    return run


def _read(run: SortedStore, shard: int) -> np.ndarray:
    out = np.zeros(len(run.array(shard, "key")), _ENTRY)
    for name in _ENTRY.names:
        out[name] = run.array(shard, name)
    return out


def _write(run: SortedStore, shard: int, entries: np.ndarray) -> None:
    run.write(shard, np.ascontiguousarray(entries["key"]), **{c: np.ascontiguousarray(entries[c]) for c in _VALUES})


def _find(run: SortedStore, shard: int, key: np.ndarray, check: np.ndarray) -> np.ndarray:
    """Place of each (key, check) in a run's shard, or -1; the run is sorted by both."""
    held, checks = run.array(shard, "key"), run.array(shard, "check")
    out = np.full(len(key), -1, np.int64)
    at, left = np.searchsorted(held, key), np.arange(len(key))
    while len(left):  # a second turn only where two lines share a 64-bit key
        left = left[at[left] < len(held)]
        left = left[np.asarray(held[at[left]]) == key[left]]
        same = np.asarray(checks[at[left]]) == check[left]
        out[left[same]] = at[left[same]]
        left = left[~same]
        at[left] += 1
    return out


def _add_shard(run: SortedStore, runs: list[SortedStore], min_docs: int):
    """Merge a shard of a batch, drop what the runs have settled, write the rest as the batch's own run."""
    def add(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        entries = _merged(np.concatenate([np.frombuffer(b, _ENTRY) for b in table.column("entries").to_pylist()]))
        docs, last = np.zeros(len(entries), np.int64), np.full(len(entries), _NO_ID)
        for old in runs:
            at = _find(old, shard, entries["key"], entries["check"])
            hit = np.flatnonzero(at >= 0)
            docs[hit] += old.array(shard, "docs")[at[hit]]
            last[hit] = np.maximum(last[hit], old.array(shard, "last")[at[hit]])
        fresh = (docs < min_docs) | (last < entries["last"])
        _write(run, shard, entries[fresh])
        return pa.table({"shard": [shard], "kept": [int(fresh.sum())], "settled": [int((~fresh).sum())]})
    return add


def _merge_shards(run: SortedStore, runs: list[SortedStore], widen: int = 0, min_docs: int = 1):
    """Merge the shards of several runs into one run of 2**widen times fewer shards; entries under min_docs go."""
    def merge(batches):
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                parts = [_read(old, s) for s in range(shard << widen, (shard + 1) << widen) for old in runs]
                entries = _merged(np.concatenate(parts))
                entries = entries[entries["docs"] >= min_docs]
                _write(run, shard, entries)
                yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([len(entries)], pa.int64())], names=["shard", "kept"])
    return merge


class LineRuns:
    """Levelled sorted runs of line hashes in a folder that all executors share.

    `levels[i]` lists the runs of level i as (folder name, entries); it and `bits` are all that another session needs to go on.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, bits: int = 0, levels: list | None = None,
                 min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, fanout: int = FANOUT):
        self.spark, self.path, self.bits = spark, path or new_path(spark, "lines"), bits
        self.levels: list[list[tuple[str, int]]] = levels or [[]]
        self.min_docs, self.min_chars, self.fanout, self.made = min_docs, min_chars, fanout, sum(map(len, self.levels))
        self.settled = 0

    def _store(self, name: str, bits: int | None = None) -> SortedStore:
        return SortedStore(f"{self.path}/{name}", "run", self.bits if bits is None else bits, _VALUES)

    def _new(self, level: int) -> str:
        self.made += 1
        return f"level{level}-{self.made:06d}"

    def runs(self) -> list[SortedStore]:
        return [self._store(name) for level in self.levels for name, _ in level]

    def add(self, documents: DataFrame) -> None:
        """Take in a batch of new documents (doc_id, text)."""
        docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        self._add_entries(docs.mapInArrow(_line_entries([], self.bits, self.min_chars), "batch long, shard long, n long, entries binary"))

    def _add_entries(self, entries: DataFrame) -> None:
        name = self._new(0)
        add = _add_shard(self._store(name), self.runs(), self.min_docs)
        done = entries.groupBy("shard").applyInArrow(add, "shard long, kept long, settled long")
        kept, settled = done.agg(F.coalesce(F.sum("kept"), F.lit(0)), F.coalesce(F.sum("settled"), F.lit(0))).first()
        self.settled += settled
        self.levels[0].append((name, kept))
        self._compact()

    def _shards(self, bits: int) -> DataFrame:
        return self.spark.range(0, 1 << bits, 1, min(1 << bits, 4096))

    def _compact(self) -> None:
        level = 0
        while level < len(self.levels):
            full = self.levels[level]
            if len(full) >= self.fanout:
                name = self._new(level + 1)
                merge = _merge_shards(self._store(name), [self._store(old) for old, _ in full])
                kept = self._shards(self.bits).mapInArrow(merge, "shard long, kept long").agg(F.sum("kept")).first()[0]
                if level + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[level + 1].append((name, kept))
                self.levels[level] = []
                for old, _ in full:
                    self._remove(old)
            level += 1

    def _remove(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def repeated(self) -> SortedStore:
        """The keys in `min_docs` documents or more, as a store for lookups with coarser shards."""
        widen = min(self.bits, 3)
        store = self._store(self._new(99), self.bits - widen)
        merge = _merge_shards(store, self.runs(), widen, self.min_docs)
        self._shards(store.bits).mapInArrow(merge, "shard long, kept long").agg(F.sum("kept")).first()
        return store


def _removal(repeated: SortedStore, min_chars: int, others: list[str]):
    def run(batches):
        for rows, raw, offs in tokens.text_chunks(batches):
            lines, ids = _Lines(raw, offs, min_chars), _ids(rows)
            order = np.argsort(lines.key)
            key, check, mine = lines.key[order], lines.check[order], ids[lines.text[order]]
            goes = np.zeros(len(key), bool)
            shards = repeated.shards_of(key)
            for shard in np.unique(shards):
                low, high = np.searchsorted(shards, [shard, shard + 1])
                at = _find(repeated, int(shard), key[low:high], check[low:high])
                hit = np.flatnonzero(at >= 0)
                goes[low + hit] = repeated.array(int(shard), "last")[at[hit]] != mine[low + hit]
            stays = np.ones(len(lines.starts), bool)
            stays[lines.long[order[goes]]] = False
            dropped = np.add.reduceat(~stays, lines.first[:-1], dtype=np.int64) if len(offs) > 1 else np.zeros(0, np.int64)
            text = rows.column(rows.schema.get_field_index("text"))
            if goes.any():
                texts = text.to_pylist()
                for i in np.flatnonzero(dropped).tolist():
                    left = [j for j in range(lines.first[i], lines.first[i + 1]) if stays[j]]
                    texts[i] = b"\n".join(raw[lines.starts[j]:lines.ends[j]].tobytes() for j in left).decode()
                text = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(rows.schema.get_field_index(c)) for c in others), text.cast(pa.string()).fill_null(""),
                 pa.array(np.diff(lines.first)), pa.array(dropped)], names=[*others, "text", "n_lines", "n_dropped"])
    return run


def without_repeats(documents: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, batches: int = BATCHES,
                    fanout: int = FANOUT, shard_entries: int = SHARD_ENTRIES) -> DataFrame:
    """The documents with their columns, `text` without its repeated lines, and n_lines (before), n_dropped."""
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    cuts = [i / batches for i in range(1, batches)]
    found, letters = docs.agg(F.percentile_approx("doc_id", cuts) if cuts else F.lit(None), F.sum(F.octet_length("text"))).first()
    bounds = sorted(set(found or []))
    bits = shard_bits((letters or 0) // (min_chars + 1) // 4, shard_entries)
    runs = LineRuns(spark, bits=bits, min_docs=min_docs, min_chars=min_chars, fanout=fanout)
    folded = f"{runs.path}/batches"
    entries = docs.mapInArrow(_line_entries(bounds, bits, min_chars), "batch long, shard long, n long, entries binary")
    entries.write.partitionBy("batch").parquet(folded)
    entries = spark.read.schema("shard long, n long, entries binary, batch long").parquet(folded)
    for batch in range(len(bounds) + 1):
        runs._add_entries(entries.where(F.col("batch") == batch))
    runs._remove("batches")
    repeated = runs.repeated()
    others = [c for c in documents.columns if c not in ("text", "n_lines", "n_dropped")]
    kinds = {f.name: f.dataType.simpleString() for f in documents.schema.fields}
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in others), "text string", "n_lines long", "n_dropped long"])
    return documents.select(*[F.col(f"`{c}`") for c in others], "text").mapInArrow(_removal(repeated, min_chars, others), schema)


def op11_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document without the lines of 40 letters or more that five documents share."""
    kept = without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))
