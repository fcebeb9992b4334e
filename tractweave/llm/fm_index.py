"""FM-index of a sequence of whole numbers: Burrows-Wheeler transform, wavelet-matrix ranks and sampled positions.

Symbol 0 ends a run: every 0 counts as a symbol of its own, so no match reaches over it and suffixes are sorted no deeper
than their run. All queries take arrays and answer many patterns at once.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 16


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in their order, by doubling the compared length among those still tied."""
    n = len(symbols)
    if not n:
        return np.zeros(0, np.int64)
    ends = symbols == 0
    key = symbols.astype(np.int64) + np.int64(n)
    key[ends] = np.arange(int(ends.sum()))
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    fresh = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])
    place = np.empty(n + 1, np.int64)  # first row of the suffix's group; past the end comes before all
    place[n] = -1
    place[order] = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    step = 1
    while True:
        single = fresh & np.concatenate([fresh[1:], [True]])
        rows = np.flatnonzero(~single)
        if not len(rows):
            return order
        at = order[rows]
        group, second = place[at], place[np.minimum(at + step, n)]
        by = np.argsort(group * np.int64(n + 2) + second + 1, kind="stable")
        at, group, second = at[by], group[by], second[by]
        order[rows] = at
        fresh[rows] = np.concatenate([[True], (group[1:] != group[:-1]) | (second[1:] != second[:-1])])
        place[at] = rows[fresh[rows]][np.cumsum(fresh[rows]) - 1]
        step *= 2


class WaveletMatrix:
    """Counts of a symbol before any place, one bit of the symbol a level."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.n, self.bits = len(symbols), bits
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        current = symbols
        for level in reversed(range(bits)):
            bit = (current >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit, dtype=np.int32)]).astype(np.int32))
            high = bit.astype(bool)
            self.zeros.append(int(len(current) - self.ones[-1][-1]))
            current = np.concatenate([current[~high], current[high]])

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its place."""
        first, last = np.zeros(len(place), np.int64), place.astype(np.int64)
        for level, ones, zeros in zip(reversed(range(self.bits)), self.ones, self.zeros, strict=True):
            high = ((symbol >> level) & 1).astype(bool)
            a, b = ones[first], ones[last]
            first, last = np.where(high, zeros + a, first - a), np.where(high, zeros + b, last - b)
        return last - first

    def access(self, place: np.ndarray) -> np.ndarray:
        symbol, at = np.zeros(len(place), np.int64), place.astype(np.int64)
        for ones, zeros in zip(self.ones, self.zeros, strict=True):
            before = ones[at].astype(np.int64)
            bit = ones[at + 1] - before
            symbol = symbol * 2 + bit
            at = np.where(bit == 1, zeros + before, at - before)
        return symbol


class FMIndex:
    def __init__(self, symbols: np.ndarray, alphabet: int, sample: int = SAMPLE):
        """``symbols`` are below ``alphabet``; the index is circular, so the sequence has to end with 0."""
        order = suffix_order(symbols)
        self.n = len(symbols)
        previous = symbols[order - 1]
        self.tree = WaveletMatrix(previous, max(1, int(alphabet - 1).bit_length()))
        counts = np.bincount(symbols, minlength=alphabet)
        self.first = np.concatenate([[0], np.cumsum(counts)])[:-1]
        # a walk ends at a kept position: every ``sample``-th, and each start of a run, before which 0 stands
        kept = (order % sample == 0) | (previous == 0)
        self.kept = kept
        self.kept_before = np.concatenate([[0], np.cumsum(kept)])
        self.positions = order[kept]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of the suffixes that begin with each pattern (one a line), by backward search."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        alive = np.arange(len(patterns))
        for k in reversed(range(patterns.shape[1])):
            symbol = patterns[alive, k]
            low[alive] = self.first[symbol] + self.tree.rank(symbol, low[alive])
            high[alive] = self.first[symbol] + self.tree.rank(symbol, high[alive])
            alive = alive[low[alive] < high[alive]]
            if not len(alive):
                break
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row: walk back to a kept position and count the steps."""
        at, steps = rows.astype(np.int64), np.zeros(len(rows), np.int64)
        going = np.flatnonzero(~self.kept[at])
        while len(going):
            symbol = self.tree.access(at[going])
            at[going] = self.first[symbol] + self.tree.rank(symbol, at[going])
            steps[going] += 1
            going = going[~self.kept[at[going]]]
        return self.positions[self.kept_before[at]] + steps
