"""A compressed full-text index over strings of symbols: a Burrows-Wheeler transform in a wavelet matrix.

Symbols are small integers; 0 ends a string. The transform's order is by the first `DEPTH` symbols, so patterns of up to that
many symbols are counted rightly. Bits are packed in 64-bit words with one running count for each word, and all
searches of a batch go through the matrix side by side.
"""

from __future__ import annotations

import numpy as np

DEPTH = 64


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Places of the rotations of `symbols` in the order of their first DEPTH symbols, by prefix doubling."""
    rank, n = symbols.astype(np.int64), len(symbols)
    length = 1
    while True:
        key = rank * (int(rank.max(initial=0)) + 1) + np.roll(rank, -length)
        order = np.argsort(key, kind="stable")
        key = key[order]
        place = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        rank = np.empty(n, dtype=np.int64)
        rank[order] = place
        length *= 2
        if length >= DEPTH or place[-1] == n - 1:
            return order


class Index:
    """Counts of patterns in a string of symbols by backward search."""

    def __init__(self, symbols: np.ndarray):
        self.n = len(symbols)
        last = symbols[suffix_order(symbols) - 1]
        size = int(symbols.max(initial=0)) + 1
        self.levels = []
        for bit in reversed(range(max(1, (size - 1).bit_length()))):
            ones = (last >> bit & 1).astype(bool)
            packed = np.packbits(ones, bitorder="little")
            words = np.concatenate([packed, np.zeros(-len(packed) % 8 + 8, dtype=np.uint8)]).view(np.uint64)
            counts = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
            self.levels.append((bit, words, counts, int(self.n - ones.sum())))
            last = np.concatenate([last[~ones], last[ones]])
        held = np.bincount(symbols, minlength=size)
        below = np.cumsum(held) - held
        symbol, first = np.unique(last, return_index=True)
        self.shift = np.zeros(size, dtype=np.int64)  # from a symbol's place in the lowest level to its place in the order
        self.shift[symbol] = below[symbol] - first

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ranges of patterns with one more symbol at the left."""
        at, both = np.concatenate([low, high]), np.concatenate([symbol, symbol])
        for bit, words, counts, zeros in self.levels:
            word = at >> 6
            ones = counts[word] + np.bitwise_count(words[word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)))
            at = np.where(both >> bit & 1, zeros + ones, at - ones)
        at = at + self.shift[both]
        return at[: len(symbol)], at[len(symbol) :]

    def matching(self, rows: np.ndarray, row: np.ndarray, end: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """For each query, the length of the longest string that ends at `end` in rows[row], begins at `floor` or later, and stands in the index twice at least."""
        length = np.zeros(len(row), dtype=np.int64)
        open_ = np.flatnonzero(end >= floor)
        low, high = np.zeros(len(open_), dtype=np.int64), np.full(len(open_), self.n, dtype=np.int64)
        while len(open_):
            low, high = self.step(rows[row[open_], end[open_] - length[open_]], low, high)
            on = high - low >= 2
            open_, low, high = open_[on], low[on], high[on]
            length[open_] += 1
            on = end[open_] - length[open_] >= floor[open_]
            open_, low, high = open_[on], low[on], high[on]
        return length


def repeated_windows(index: Index, rows: np.ndarray, n: np.ndarray, width: int) -> np.ndarray:
    """A bit mask for each row: bit k says that the window of `width` symbols from k stands in the index twice at least.

    Row r has n[r] windows. Searches from the last open window's end go as far left as they match and settle every window they cover; a
    search from the first open window's end that stops settles all windows that hold the place where it stopped.
    """
    mask = np.zeros(len(rows), dtype=np.int64)
    low, high = np.zeros(len(rows), dtype=np.int64), n.astype(np.int64) - 1
    span = lambda a, b: (np.int64(1) << (b + 1)) - (np.int64(1) << a)  # noqa: E731  (bits a to b)
    while len(row := np.flatnonzero(low <= high)):
        length = index.matching(rows, row, high[row] + width - 1, low[row])
        first = high[row] + width - length  # where the match begins
        hit = length >= width
        mask[row[hit]] |= span(first[hit], high[row[hit]])
        high[row] = np.where(hit, first, high[row]) - 1
        row = row[low[row] <= high[row]]
        if not len(row):
            break
        length = index.matching(rows, row, low[row] + width - 1, low[row])
        hit = length >= width
        mask[row[hit]] |= np.int64(1) << low[row[hit]]
        low[row] = np.where(hit, low[row] + 1, low[row] + width - length)
    return mask
