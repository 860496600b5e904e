"""Words of many texts at once: numpy over the bytes of Arrow string columns.

A word is a longest run of bytes other than space, tab, newline, vertical tab, form feed and carriage return. A word or a run
of words is named by a 64-bit hash: random values of its bytes (or words) times the powers of an odd base, summed and mixed.
Prefix sums give the hash of every run in a few passes over the bytes, with no Python work per word.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_RUN_BASE = 0xD6E8FEB86659FD93
_BYTE_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    both = []
    for factor in (base, pow(base, -1, 1 << 64)):
        out = np.ones(max(n, 1), np.uint64)
        size = 1
        while size < len(out):
            step = np.uint64(pow(factor, size, 1 << 64))
            more = min(size, len(out) - size)
            out[size:size + more] = out[:more] * step
            size += more
        both.append(out)
    return both[0], both[1]


_CACHE: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers_to(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    held = _CACHE.get(base)
    if held is None or len(held[0]) < n:
        held = _CACHE[base] = _powers(base, max(n, 1 << 16))
    return held[0][:n], held[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit values, so that any of their bits serve as a hash."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def signed(h: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return h.view(np.int64)


def text_chunks(batches: Iterable[pa.RecordBatch], column: str = "text", size: int = CHUNK_BYTES,
                ) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Whole texts in pieces of about `size` bytes: rows, their bytes, and where each text starts (one entry more than rows).

    A null text is an empty one. A longer text is a piece of its own, so memory follows the longest text.
    """
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        if texts.null_count:
            texts = texts.fill_null("")
        _, offsets, data = texts.buffers()
        width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
        offs = np.frombuffer(offsets, width)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        at = 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(offs, offs[at] + size, side="right")) - 1)
            yield batch.slice(at, to - at), raw[offs[at]:offs[to]], offs[at:to + 1] - offs[at]
            at = to


def lower(raw: np.ndarray) -> np.ndarray:
    """A-Z in lower case; other bytes as they are."""
    return _LOWER[raw]


def word_spans(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and for each text the number of its first word (one entry more than texts)."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    inside = ~_IS_SPACE[raw]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    finishes = inside.copy()
    finishes[:-1] &= ~inside[1:]
    cuts = offs[(offs > 0) & (offs < len(raw))]
    begins[cuts] = inside[cuts]
    finishes[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(finishes) + 1, np.searchsorted(starts, offs)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    powers, inverse = _powers_to(_BASE, len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[raw] * powers[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts])


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of the run of `length` words at each word; empty if there are fewer. Runs may cross texts: see `runs_inside`."""
    if len(words) < length:
        return np.zeros(0, np.uint64)
    powers, inverse = _powers_to(_RUN_BASE, len(words) + 1)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * powers[:-1], out=sums[1:])
    last = len(words) - length
    return mix((sums[length:] - sums[:last + 1]) * inverse[:last + 1] + np.uint64(length))


def span_hashes(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the words from each start to each end; equal to `run_hashes` for equal runs."""
    powers, inverse = _powers_to(_RUN_BASE, len(words) + 1)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * powers[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def runs_inside(first_words: np.ndarray, length: int) -> np.ndarray:
    """Number of runs of `length` words inside each text."""
    return np.maximum(np.diff(first_words) - length + 1, 0)


def ramp(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each count c, one after another."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    return np.arange(total, dtype=np.int64) - np.repeat(ends - counts, counts)


def shingle_lists(words: np.ndarray, first_words: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of each text in order, repeats included, end to end, and where each text's list starts.

    A text with fewer than `length` words has its whole sequence as one shingle, a text without words has none.
    """
    n_words = np.diff(first_words)
    counts = runs_inside(first_words, length)
    short = np.flatnonzero((n_words > 0) & (n_words < length))
    runs = run_hashes(words, length)
    listed = counts.copy()
    listed[short] = 1
    at = np.zeros(len(listed) + 1, np.int64)
    np.cumsum(listed, out=at[1:])
    hashes = np.zeros(at[-1], np.uint64)
    long = np.repeat(n_words >= length, listed)
    hashes[long] = runs[np.repeat(first_words[:-1], counts) + ramp(counts)]
    for n in range(1, length):
        texts = short[n_words[short] == n]
        if len(texts):
            hashes[at[texts]] = run_hashes(words, n)[first_words[texts]]
    return hashes, at


def shingle_sets(words: np.ndarray, first_words: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """`shingle_lists` without repeats, each text's shingles sorted."""
    hashes, at = shingle_lists(words, first_words, length)
    texts = np.repeat(np.arange(len(at) - 1), np.diff(at))
    order = np.argsort(hashes)
    order = order[np.argsort(texts[order].astype(np.uint16 if len(at) < 1 << 16 else np.int64), kind="stable")]
    texts, hashes = texts[order], hashes[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (texts[1:] != texts[:-1]) | (hashes[1:] != hashes[:-1])
    texts, hashes = texts[fresh], hashes[fresh]
    return hashes, np.searchsorted(texts, np.arange(len(at)))
