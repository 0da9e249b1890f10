"""Burrows-Wheeler transforms of shards, merged by refining their interleaving.

Texts are joined to one cyclic string per shard with a zero before each. The merge
never sorts suffixes of different shards against each other: it starts with the
shards one after another and, by the symbols that precede the suffixes in each
transform, refines the interleaving to longer and longer common prefixes. A symbol
here is a run of ``STRIDE`` bytes, so each round lengthens the prefixes by as many.
"""

from __future__ import annotations

import numpy as np

STRIDE = 16


def _shard(texts: list[bytes]) -> np.ndarray:
    """The texts one after another, a zero before each; bytes go up by one (UTF-8 has no 0xFF)."""
    whole = np.frombuffer(b"\xff" + b"\xff".join(texts), np.uint8)
    return whole + np.uint8(1)


def _eights(string: np.ndarray) -> np.ndarray:
    """The eight symbols from each place on, cyclically, as a number that sorts like them."""
    around = np.resize(string, string.size + 7).astype(np.uint64)
    value = np.zeros(string.size, np.uint64)
    for i in range(8):
        value = (value << np.uint64(8)) | around[i : i + string.size]
    return value


def _ranks(strings: list[np.ndarray], stride: int) -> list[np.ndarray]:
    """For each place of each shard the rank of its next ``stride`` symbols among those of all shards."""
    flat = np.concatenate([_eights(s) for s in strings])
    edges = np.cumsum([0, *[s.size for s in strings]])
    rank = np.unique(flat, return_inverse=True)[1]
    step = 8
    while step < stride:
        after = np.concatenate([np.roll(rank[a:b], -step) for a, b in zip(edges, edges[1:])])
        rank = np.unique(rank * flat.size + after, return_inverse=True)[1]
        step *= 2
    return [rank[a:b] for a, b in zip(edges, edges[1:])]


def _order(string: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of one shard in the order of their first ``depth`` symbols at least."""
    return np.argsort(_ranks([string], depth)[0], kind="stable")


def repeated_starts(texts: list[bytes], depth: int, shards: int = 2) -> list[np.ndarray]:
    """For each text, which of its ``depth``-byte substrings also start anywhere else in the texts.

    ``depth`` is a multiple of ``STRIDE``.
    """
    dealt = [texts[i::shards] for i in range(min(shards, len(texts)))]
    strings = [_shard(some) for some in dealt]
    orders = [_order(s, depth) for s in strings]
    # The transform: what stands before each suffix, in the order of the suffixes.
    transforms = [np.roll(rank, STRIDE)[order] for rank, order in zip(_ranks(strings, STRIDE), orders)]
    kind = np.uint16 if max(int(t.max()) for t in transforms) < 1 << 16 else np.int64
    transforms = [t.astype(kind) for t in transforms]
    source = np.repeat(np.arange(len(strings), dtype=np.uint8), [s.size for s in strings])
    prefix = np.zeros(source.size, np.int32)  # the class of suffixes with the same first symbols
    before = np.empty(source.size, kind)
    for _ in range(depth // STRIDE):
        for number, transform in enumerate(transforms):
            before[source == number] = transform
        place = np.argsort(before, kind="stable")
        symbol, longer = before[place], prefix[place]
        fresh = np.empty(source.size, bool)
        fresh[0] = False
        fresh[1:] = (symbol[1:] != symbol[:-1]) | (longer[1:] != longer[:-1])
        source, prefix = source[place], np.cumsum(fresh, dtype=np.int32)
    shared = np.bincount(prefix)[prefix] > 1  # common prefixes of the whole depth: repeated intervals
    found: list[np.ndarray] = [np.zeros(0, bool)] * len(texts)
    for number, (some, string, order) in enumerate(zip(dealt, strings, orders)):
        flags = np.zeros(string.size, bool)
        flags[order] = shared[source == number]
        at = 1
        for i, text in enumerate(some):
            found[number + i * len(dealt)] = flags[at : at + max(len(text) - depth + 1, 0)]
            at += len(text) + 1
    return found
