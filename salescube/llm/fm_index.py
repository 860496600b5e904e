"""An FM-index over integer symbols: bit-packed wavelet matrix, backward search for many patterns at once."""

from __future__ import annotations

import numpy as np


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of `text` in the order of their first `depth` symbols or more (prefix doubling)."""
    rank = text.astype(np.int64)
    reach = 1
    while True:
        after = np.zeros(len(rank), np.int64)
        after[:-reach] = rank[reach:] + 1
        keys = rank * (int(after.max(initial=0)) + 1) + after
        order = np.argsort(keys, kind="stable")
        held = keys[order]
        rank[order] = np.r_[0, np.cumsum(held[1:] != held[:-1])]
        reach *= 2
        if reach >= depth or rank[order[-1]] == len(rank) - 1 or reach >= len(rank):
            return order


class FMIndex:
    """`text` holds symbols 0..n-1; suffixes are told apart up to `depth` symbols, the longest pattern plus one."""

    def __init__(self, text: np.ndarray, symbols: int, depth: int):
        self.order = suffix_order(text, depth)
        self.first = np.zeros(symbols + 1, np.int64)
        np.cumsum(np.bincount(text, minlength=symbols), out=self.first[1:])
        sequence = text[self.order - 1].astype(np.int64)
        self.levels = []
        names = np.arange(symbols, dtype=np.int64)
        begins = np.zeros(symbols, np.int64)
        for level in range(max(symbols - 1, 1).bit_length() - 1, -1, -1):
            bits = ((sequence >> level) & 1).astype(bool)
            packed = np.zeros(len(bits) // 64 + 1, np.uint64)
            data = np.packbits(bits, bitorder="little")
            packed.view(np.uint8)[:len(data)] = data
            before = np.zeros(len(packed), np.int64)
            np.cumsum(np.bitwise_count(packed[:-1]), out=before[1:])
            zeros = len(bits) - int(bits.sum())
            self.levels.append((level, packed, before, zeros))
            ones = self._ones(packed, before, begins)
            begins = np.where((names >> level) & 1, zeros + ones, begins - ones)
            sequence = np.concatenate([sequence[~bits], sequence[bits]])
        self.base = self.first[:-1] - begins

    @staticmethod
    def _ones(packed: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Set bits before each position."""
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return before[word] + np.bitwise_count(packed[word] & low)

    def extend(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the patterns with one more symbol in front."""
        at = np.concatenate([low, high])
        both = np.concatenate([symbols, symbols])
        for level, packed, before, zeros in self.levels:
            ones = self._ones(packed, before, at)
            at = np.where((both >> level) & 1, zeros + ones, at - ones)
        at += self.base[both]
        return at[:len(symbols)], at[len(symbols):]


def repeated_windows(contexts: np.ndarray, at: np.ndarray, weights: np.ndarray, window: int) -> np.ndarray:
    """For each context (symbols contexts[at[i]:at[i + 1]], seen weights[i] times) a bit mask of its window starts whose `window`
    symbols occur twice or more in all contexts together.

    A context is read backward from its end for as long as what was read occurs twice: that is the matching statistic of the
    end. All windows inside the match repeat; the window reaching one symbol further is the next to read. If the match is
    shorter than a window, the next end is one symbol to the left.
    """
    lengths = np.diff(at)
    _, text = np.unique(contexts, return_inverse=True)
    kinds = int(text.max(initial=0)) + 2
    whole = np.zeros(len(contexts) + len(lengths), np.int64)
    places = np.arange(len(contexts)) + np.repeat(np.arange(len(lengths)), lengths)
    whole[places] = text + 1
    index = FMIndex(whole, kinds, int(lengths.max(initial=0)) + 1)
    each = np.zeros(len(whole), np.int64)
    each[places] = np.repeat(weights, lengths)
    counts = np.zeros(len(whole) + 1, np.int64)
    np.cumsum(each[index.order], out=counts[1:])

    begins = at[:-1] + np.arange(len(lengths))
    masks = np.zeros(len(lengths), np.uint32)
    who = np.flatnonzero(lengths >= window)
    end = lengths[who].copy()
    done = end.copy()
    low, high = np.zeros(len(who), np.int64), np.full(len(who), len(whole), np.int64)
    while len(who):
        symbols = whole[begins[who] + done - 1]
        fresh = done == end
        to_low, to_high = index.first[symbols], index.first[symbols + 1]
        going = np.flatnonzero(~fresh)
        if len(going):
            to_low[going], to_high[going] = index.extend(symbols[going], low[going], high[going])
        fits = counts[to_high] - counts[to_low] >= 2
        done = done - fits
        low, high = to_low, to_high
        over = ~fits | (done == 0)
        if over.any():
            starts, ends = done[over], end[over]
            long = ends - starts >= window
            bits = np.where(long, (np.uint64(1) << (ends - window + 1).clip(0).astype(np.uint64)) - (np.uint64(1) << starts.astype(np.uint64)), np.uint64(0))
            masks[who[over]] |= bits.astype(np.uint32)
            end[over] = done[over] = np.where(long, starts - 1 + window, ends - 1)
            left = end >= window
            who, end, done, low, high = who[left], end[left], done[left], low[left], high[left]
    return masks
