"""An FM-index over an array of word numbers: wavelet-tree ranks and sampled suffix positions."""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order, by doubling the compared length."""
    n = symbols.size
    order = np.argsort(symbols, kind="stable")
    rank = np.empty(n, np.int64)
    rank[order] = np.cumsum(np.diff(symbols[order], prepend=symbols[order[:1]]) != 0)
    step = 1
    while n and rank[order[-1]] < n - 1:
        following = np.zeros(n, np.int64)
        following[: max(n - step, 0)] = rank[step:] + 1
        key = rank * (n + 1) + following
        order = np.argsort(key, kind="stable")
        rank[order] = np.cumsum(np.diff(key[order], prepend=key[order[:1]]) != 0)
        step *= 2
    return order


class WaveletTree:
    """Ranks of symbols in an array: one bit vector per level, zeros before ones."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels = []
        for level in range(bits - 1, -1, -1):
            ones = (symbols >> level) & 1
            before = np.concatenate([[0], np.cumsum(ones)])  # ones before each place
            self.levels.append((level, before, symbols.size - int(before[-1])))
            symbols = np.concatenate([symbols[ones == 0], symbols[ones == 1]])

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before ``place``."""
        start = np.zeros_like(place)
        for level, before, zeros in self.levels:
            one = ((symbol >> level) & 1) == 1
            place = np.where(one, zeros + before[place], place - before[place])
            start = np.where(one, zeros + before[start], start - before[start])
        return place - start

    def at(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at ``place`` and how often it stands before."""
        symbol, start = np.zeros_like(place), np.zeros_like(place)
        for level, before, zeros in self.levels:
            one = before[place + 1] > before[place]
            symbol |= one.astype(np.int64) << level
            place = np.where(one, zeros + before[place], place - before[place])
            start = np.where(one, zeros + before[start], start - before[start])
        return symbol, place - start


class FMIndex:
    """Counts and locates phrases in runs of word numbers (from 1) set apart by zeros.

    ``runs`` starts and ends with zero. Suffix positions are kept at every
    ``sample``-th place of a run and at its start, so a walk back never leaves its run.
    """

    def __init__(self, runs: np.ndarray, largest: int, sample: int = 8):
        order = suffix_array(runs)
        self.tree = WaveletTree(runs[order - 1].astype(np.int64), max(int(largest).bit_length(), 1))
        self.first = np.concatenate([[0], np.cumsum(np.bincount(runs, minlength=largest + 1))])
        starts = np.flatnonzero(runs == 0) + 1
        place = np.arange(runs.size)
        since = place - starts[np.maximum(np.searchsorted(starts, place, side="right") - 1, 0)]
        sampled = (since % sample == 0)[order]
        self.sampled = np.concatenate([[0], np.cumsum(sampled)])
        self.positions = order[sampled]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of phrases, each given in reverse and filled up to the same width."""
        low = np.zeros(lengths.size, np.int64)
        high = np.full(lengths.size, self.first[-1], np.int64)
        for i in range(phrases.shape[1]):
            live = np.flatnonzero((lengths > i) & (low < high))
            word = phrases[live, i]
            low[live] = self.first[word] + self.tree.rank(word, low[live])
            high[live] = self.first[word] + self.tree.rank(word, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places of the suffixes in ``rows``."""
        places = np.zeros(rows.size, np.int64)
        steps = np.zeros(rows.size, np.int64)
        open_ = np.arange(rows.size)
        while open_.size:
            row = rows[open_]
            hit = self.sampled[row + 1] > self.sampled[row]
            done = open_[hit]
            places[done] = self.positions[self.sampled[rows[done]]] + steps[done]
            open_ = open_[~hit]
            word, before = self.tree.at(rows[open_])
            rows = rows.copy()
            rows[open_] = self.first[word] + before
            steps[open_] += 1
        return places
