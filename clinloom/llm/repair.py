"""Re-Pair grammars of token ids: rules for frequent pairs, and what each symbol expands to.

Ids stay as they are; rule r is the symbol ``ids + r`` and stands for the pair
(left[r], right[r]) of earlier symbols. ``lengths`` holds how many ids every rule
expands to, so any stretch of ids can be found in the symbols and decoded alone.
"""

from __future__ import annotations

import struct

import numpy as np

LEAST = 4  # a pair that would be replaced fewer times gets no rule
GAIN = 0.02  # rounds end when one shortens the symbols by less than this share
_MAGIC = b"RPG1"
_HEAD = "<4sBIIIQ"  # magic, bytes a symbol, ids, rules, symbols, expanded ids


def _chosen(pairs: np.ndarray) -> np.ndarray:
    """Places of the pairs to replace at once, none overlapping another.

    Where two frequent pairs overlap the more frequent one goes first; the other is
    left to later rounds. Of a run of one pair every other place is taken. Frequencies are
    counted by hash, which only decides between pairs, never what a rule stands for.
    """
    bits = min(max(int(pairs.size).bit_length(), 8), 24)
    cell = ((pairs ^ (pairs >> 29)).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).view(np.int64)
    counts = np.bincount(cell, minlength=1 << bits)
    counts[counts < LEAST] = 0
    weight = np.zeros(pairs.size + 2, np.int64)  # nothing stands before and after
    weight[1:-1] = counts[cell] << bits
    weight[1:-1] |= cell
    weight[weight < 1 << bits] = 0
    here, before, after = weight[1:-1], weight[:-2], weight[2:]
    at = np.flatnonzero((here > before) & (here > after))
    again = np.flatnonzero((here == after) & (here > 0))
    if again.size:  # a run of equal pairs wins as a whole against what stands beside it
        cuts = np.flatnonzero(np.diff(again) > 1) + 1
        first, last = again[np.concatenate([[0], cuts])], again[np.concatenate([cuts - 1, [-1]])] + 1
        wins = (here[first] > before[first]) & (here[last] > after[last])
        first, sizes = first[wins], (last[wins] - first[wins]) // 2 + 1
        step = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        at = np.sort(np.concatenate([at, np.repeat(first, sizes) + 2 * step]))
    return at


def compress(ids: np.ndarray, n_ids: int) -> bytes:
    """The grammar of ``ids``, all below ``n_ids``, as one string of bytes."""
    symbols = ids.astype(np.int64)
    left: list[np.ndarray] = []
    right: list[np.ndarray] = []
    lengths = np.ones(n_ids, np.int64)
    while symbols.size > LEAST:
        pairs = symbols[:-1] << 32 | symbols[1:]
        at = _chosen(pairs)
        new, number, used = np.unique(pairs[at], return_inverse=True, return_counts=True)
        often = used >= LEAST
        at = at[often[number]]
        if at.size == 0 or at.size < GAIN * symbols.size:
            break
        number = (np.cumsum(often) - 1)[number[often[number]]]
        new = new[often]
        left.append(new >> 32)
        right.append(new & 0xFFFFFFFF)
        symbols[at] = lengths.size + number
        lengths = np.concatenate([lengths, lengths[left[-1]] + lengths[right[-1]]])
        keep = np.ones(symbols.size, bool)
        keep[at + 1] = False
        symbols = symbols[keep]
    rules = lengths.size - n_ids
    width = "<u2" if lengths.size <= 1 << 16 else "<u4"
    parts = [np.concatenate(x or [np.empty(0, np.int64)]).astype(width).tobytes() for x in (left, right)]
    head = struct.pack(_HEAD, _MAGIC, int(width[-1]), n_ids, rules, symbols.size, ids.size)
    return b"".join([head, *parts, lengths[n_ids:].astype("<u4").tobytes(), symbols.astype(width).tobytes()])


class Grammar:
    """A grammar read back; ``expand`` gives any stretch of its ids."""

    def __init__(self, data: bytes):
        magic, width, self.n_ids, rules, size, self.size = struct.unpack_from(_HEAD, data)
        if magic != _MAGIC:
            raise ValueError("not a grammar of token ids")
        kind, at = f"<u{width}", struct.calcsize(_HEAD)
        self.left = np.frombuffer(data, kind, rules, at).astype(np.int64)
        self.right = np.frombuffer(data, kind, rules, at + rules * width).astype(np.int64)
        at += 2 * rules * width
        lengths = np.frombuffer(data, "<u4", rules, at).astype(np.int64)
        self.lengths = np.concatenate([np.ones(self.n_ids, np.int64), lengths])
        self.symbols = np.frombuffer(data, kind, size, at + 4 * rules).astype(np.int64)

    def _opened(self, symbols: np.ndarray) -> np.ndarray | None:
        """``symbols`` with every rule replaced by its pair; None without rules."""
        at = np.flatnonzero(symbols >= self.n_ids)
        if not at.size:
            return None
        rules = symbols[at] - self.n_ids
        following = np.insert(symbols, at + 1, self.right[rules])
        following[at + np.arange(at.size)] = self.left[rules]
        return following

    def expand(self, start: int = 0, length: int | None = None) -> np.ndarray:
        """Ids ``start`` to ``start + length``: opens only the rules that reach into them."""
        stop = self.size if length is None else start + length
        if start >= stop:
            return np.empty(0, np.int64)
        if stop - start == self.size:
            symbols = self.symbols
            while (following := self._opened(symbols)) is not None:
                symbols = following
            return symbols
        ends = np.cumsum(self.lengths[self.symbols])
        symbols, skip, wanted = self.symbols, start, stop - start
        while True:
            a, b = np.searchsorted(ends, skip, "right"), np.searchsorted(ends, skip + wanted, "left") + 1
            skip -= int(ends[a - 1]) if a else 0
            following = self._opened(symbols[a:b])
            if following is None:
                return symbols[a:b][skip : skip + wanted]
            symbols, ends = following, np.cumsum(self.lengths[following])
