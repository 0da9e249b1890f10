"""Spelling variants: words one insertion, deletion or replacement apart, by a frequency-vector trie.

A word's vector counts its letters by group. One edit changes the vector by one surplus and one
deficit at most, so the words near another lie in a trie of vectors, level by level
one group, within a budget of one each. The upper levels decide which task holds a
word; a search enters every upper node within its budget and goes on depth-first inside.
Leaf words are verified letter by letter.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.llm.common import map_rows, remove, utf8, written

LEAST_LETTERS = 5
LEAST_COUNT = 3
NOISE = 97  # one in so many (document, word) pairs loses a letter
RATIO = 2  # a form is at least so many times as frequent
# Groups of letters, one level of the trie each; all other letters are the last group.
GROUPS = ["e", "a", "in", "t", "or", "s", "l", "nd", "i", "ru", "cm", "gpbh", "fvwkyjxqz"]
UPPER = 5  # levels that decide on the task
SUBTRIE = 20_000  # words; more below one upper node are dealt over several subtries
_WORDS_HELD = 1_000_000  # of memory only: words a task counts before it gives them on
_PROBES_AT_ONCE = 20_000  # of memory only
_STATES_AT_ONCE = 1 << 19  # of memory only: states of the search that are opened together
_MATRIX = 48  # longer words are compared one by one

_LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256)
)  # of Latin-1: lower-cased A-Z, other letters as they are, all else a space
_GROUP = np.full(256, len(GROUPS), np.int64)
for _i, _letters in enumerate(GROUPS):
    for _c in _letters.encode():
        _GROUP[_c] = _i
_LEVELS = len(GROUPS) + 1


def _runs(text: str | None) -> list[bytes]:
    """The lower-cased runs of letters of a text in Latin-1, but those too short for any result."""
    if not text:
        return []
    found = text.encode("latin-1", "replace").translate(_LETTERS).split()
    return [w for w in found if len(w) >= LEAST_LETTERS]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) of a task's documents, with the letters lost."""
    held: Counter = Counter()

    def given() -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in held], pa.string())
        out = pa.RecordBatch.from_arrays([words, pa.array(list(held.values()), pa.int64())], ["word", "n"])
        held.clear()
        return out

    crc = zlib.crc32
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            runs = _runs(text.as_py())
            if not runs:
                continue
            held.update(runs)
            start = crc(b"" if doc is None else b"%d" % doc)
            start = crc(b":", start)
            for word in [
                w for w in set(runs) if not crc(w if w.isascii() else utf8(w.decode("latin-1")), start) % NOISE
            ]:
                at = crc(utf8(word.decode("latin-1")), start) % len(word)
                times = runs.count(word)
                held[word] -= times
                if held[word] == 0:
                    del held[word]
                if len(word) > LEAST_LETTERS:
                    held[word[:at] + word[at + 1 :]] += times
            if len(held) > _WORDS_HELD:
                yield given()
    if held:
        yield given()


def words(documents: DataFrame) -> DataFrame:
    """(word, n): the words of all texts of ``documents`` (doc_id, text) and how often they are there.

    Words are the runs of Latin letters with A-Z lower-cased, some of them less a letter as
    the crc32 of ``<doc_id>:<run>`` says; of ``LEAST_LETTERS`` letters and ``LEAST_COUNT`` times at least.
    A null doc_id reads as nothing, null text has no words; further columns are not read.
    """
    counted = map_rows(documents, ["doc_id", "text"], "word string, n long", _counted)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _vectors(spelled: list[bytes]) -> np.ndarray:
    """Letters by group of each word, a row each."""
    sizes = np.array([len(w) for w in spelled], np.int64)
    owner = np.repeat(np.arange(sizes.size), sizes)
    cell = owner * _LEVELS + _GROUP[np.frombuffer(b"".join(spelled), np.uint8)]
    return np.bincount(cell, minlength=sizes.size * _LEVELS).reshape(-1, _LEVELS)


# What of the budget is spent. A pair of words of one length is found from the side that spends
# the surplus first, a shorter word from the longer one.
_NONE, _SURPLUS, _DEFICIT, _BOTH = range(4)
_STEPS = [  # state, change of the count, next state
    (_NONE, 0, _NONE), (_NONE, 1, _SURPLUS), (_NONE, -1, _DEFICIT),
    (_SURPLUS, 0, _SURPLUS), (_SURPLUS, -1, _BOTH), (_DEFICIT, 0, _DEFICIT), (_BOTH, 0, _BOTH),
]


def _entries() -> list[tuple[list[int], int]]:
    """Changes of the upper levels' counts within the budget, with the state they lead to."""
    out = [([], _NONE)]
    for _ in range(UPPER):
        out = [(changes + [d], b) for changes, state in out for a, d, b in _STEPS if a == state]
    return out


_ENTRIES = _entries()
_CHANGES = np.array([c for c, _ in _ENTRIES], np.int64)
_STATES = np.array([s for _, s in _ENTRIES], np.int64)
_WEIGHTS = np.array([0x9E3779B97F4A7C15 ** (i + 1) % (1 << 63) | 1 for i in range(UPPER)], np.uint64)


def _node(upper: np.ndarray) -> np.ndarray:
    """A number for each upper node; should two share one, verification tells them apart."""
    return (upper.astype(np.uint64) * _WEIGHTS).sum(axis=-1, dtype=np.uint64).view(np.int64)


def _stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, word, n): each word at its upper node."""
    for batch in batches:
        vectors = _vectors([w.encode("latin-1") for w in batch.column(0).to_pylist()])
        yield pa.RecordBatch.from_arrays(
            [pa.array(_node(vectors[:, :UPPER])), batch.column(0), batch.column(1)], ["node", "word", "n"]
        )


def _sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, word, n, state): each word at every upper node its search enters."""
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            upper = _vectors([w.encode("latin-1") for w in part.column(0).to_pylist()])[:, :UPPER]
            entered = upper[:, None, :] + _CHANGES[None]
            row, entry = np.nonzero((entered >= 0).all(axis=2))
            rows = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(_node(entered[row, entry])), part.column(0).take(rows), part.column(1).take(rows),
                 pa.array(_STATES[entry].astype(np.int32))],
                ["node", "word", "n", "state"],
            )


class _Trie:
    """The lower levels of the words of some subtries, a level one group of letters."""

    def __init__(self, roots: np.ndarray, spelled: list[bytes], counts: np.ndarray):
        vectors = _vectors(spelled)
        self.base = int(vectors.max(initial=0)) + 3
        nodes = np.searchsorted(np.unique(roots), roots)
        self.roots = np.unique(roots)
        self.children = []  # by level: sorted node * base + count, whose place is the child
        for level in range(UPPER, _LEVELS):
            key = nodes * self.base + vectors[:, level]
            known = np.unique(key)
            self.children.append(known)
            nodes = np.searchsorted(known, key)
        self.order = np.argsort(nodes, kind="stable")
        self.starts = np.searchsorted(nodes[self.order], np.arange(int(nodes.max(initial=-1)) + 2))
        self.spelled, self.counts = spelled, counts

    def near(self, roots: np.ndarray, spelled: list[bytes], states: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(stored word, searched word) places of pairs of which one is near the other."""
        vectors = _vectors(spelled)
        at = np.minimum(np.searchsorted(self.roots, roots), self.roots.size - 1)
        query = np.flatnonzero(self.roots[at] == roots)
        stack = [(0, at[query], query, states[query])]
        while stack:
            level, node, query, state = stack.pop()
            if node.size > _STATES_AT_ONCE:
                half = node.size // 2
                stack += [(level, node[half:], query[half:], state[half:]), (level, node[:half], query[:half], state[:half])]
                continue
            if level == len(self.children):
                yield self._verified(node, query, state, spelled)
                continue
            known, wanted = self.children[level], vectors[query, UPPER + level]
            reached = []
            for before, change, after in _STEPS:
                some = np.flatnonzero((state == before) & (wanted + change >= 0))
                key = node[some] * self.base + np.minimum(wanted[some] + change, self.base - 1)
                child = np.minimum(np.searchsorted(known, key), known.size - 1)
                hit = known[child] == key
                some = some[hit]
                reached.append((child[hit], query[some], np.full(some.size, after)))
            node, query, state = (np.concatenate(c) for c in zip(*reached))
            if node.size:
                stack.append((level + 1, node, query, state))

    def _verified(self, leaf: np.ndarray, query: np.ndarray, state: np.ndarray, spelled: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        done = state != _SURPLUS
        leaf, query, twice = leaf[done], query[done], state[done] == _NONE
        sizes = self.starts[leaf + 1] - self.starts[leaf]
        query, twice = np.repeat(query, sizes), np.repeat(twice, sizes)
        offsets = np.arange(query.size) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        word = self.order[np.repeat(self.starts[leaf], sizes) + offsets]
        ok = np.zeros(query.size, bool)
        mine, theirs = _Letters(self.spelled), _Letters(spelled)
        for a in range(0, query.size, 1 << 16):
            some = slice(a, a + (1 << 16))
            ok[some] = _one_edit(mine, word[some], theirs, query[some])
        # Words of equal vectors find each other: the pair counts from one side.
        for k in np.flatnonzero(ok & twice).tolist():
            ok[k] = self.spelled[word[k]] < spelled[query[k]]
        return word[ok], query[ok]


class _Letters:
    """Words as rows of a matrix, as wide as short words are."""

    def __init__(self, spelled: list[bytes]):
        self.spelled = spelled
        self.sizes = np.array([len(w) for w in spelled], np.int64)
        self.matrix = np.array([w[:_MATRIX] for w in spelled], f"S{_MATRIX}").view(np.uint8).reshape(-1, _MATRIX)


def _one_edit(a: _Letters, i: np.ndarray, b: _Letters, j: np.ndarray) -> np.ndarray:
    """Whether words a[i] are one edit from words b[j], which are as long or one letter longer."""
    x, y, short = a.matrix[i], b.matrix[j], a.sizes[i]
    same_size = short == b.sizes[j]
    differing = x != y
    replaced = same_size & (differing.sum(axis=1) == 1)
    # Letters up to the first difference and those after it, one place on in the longer word.
    first = np.where(differing.any(axis=1), differing.argmax(axis=1), _MATRIX)
    shifted = (x[:, :-1] != y[:, 1:]) & (np.arange(_MATRIX - 1) < short[:, None])
    last = np.where(shifted.any(axis=1), _MATRIX - 1 - shifted[:, ::-1].argmax(axis=1), 0)
    found = replaced | ((short + 1 == b.sizes[j]) & (first >= last))
    for k in np.flatnonzero(b.sizes[j] > _MATRIX).tolist():
        found[k] = _near(a.spelled[i[k]], b.spelled[j[k]])
    return found


def _near(a: bytes, b: bytes) -> bool:
    """One edit, for words of any length of which ``b`` is as long or one letter longer."""
    if not 0 <= len(b) - len(a) <= 1:
        return False
    low, high = 0, len(a)  # the length of the common start, by halves
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle - 1)
    return (a != b) and a[low + (len(a) == len(b)) :] == b[low + 1 :]


_PAIR = "word string, n long, other string, other_n long"


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs among rows (root, state, word, n) sorted by root, its words (state below 0) before its searches."""
    stored: list[tuple] = []
    searches: list[tuple] = []
    trie, held, waiting, searching = None, 0, 0, False

    def joined(parts: list[tuple]) -> list:
        roots, states, counts = (np.concatenate(c) for c in list(zip(*parts))[:3])
        return [roots, states, counts, [w for p in parts for w in p[3]]]

    def found() -> Iterator[pa.RecordBatch]:
        nonlocal trie, waiting
        if searches and stored:
            if trie is None:
                roots, _, counts, spelled = joined(stored)
                trie = _Trie(roots, spelled, counts)
            roots, states, counts, spelled = joined(searches)
            for i, j in trie.near(roots, spelled, states):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([trie.spelled[k].decode("latin-1") for k in i], pa.string()), pa.array(trie.counts[i]),
                     pa.array([spelled[k].decode("latin-1") for k in j], pa.string()), pa.array(counts[j])],
                    ["word", "n", "other", "other_n"],
                )
        searches.clear()
        waiting = 0

    for batch in batches:
        roots, states, counts = (batch.column(c).to_numpy() for c in ("root", "state", "n"))
        spelled = [w.encode("latin-1") for w in batch.column("word").to_pylist()]
        kind = states < 0
        cuts = [0, *(np.flatnonzero(np.diff(kind)) + 1).tolist(), kind.size]
        for a, b in zip(cuts, cuts[1:]):
            part = roots[a:b], states[a:b].astype(np.int64), counts[a:b], spelled[a:b]
            if a < b and kind[a]:
                # A batch may end among a root's words: only words after searches are another root's.
                if searching and held >= SUBTRIE:
                    yield from found()
                    stored.clear()
                    held = 0
                stored.append(part)
                held, trie, searching = held + b - a, None, False
            elif a < b:
                searches.append(part)
                waiting, searching = waiting + b - a, True
                if waiting >= _PROBES_AT_ONCE:
                    yield from found()
    yield from found()


def near_pairs(counted: DataFrame) -> DataFrame:
    """(word, n, other, other_n) of every two words of ``counted`` (word, n) one edit apart, once each.

    The words are different, of Latin-1 letters other than zero. An upper node with over
    ``SUBTRIE`` words is dealt over subtries by hash, each of which its searches enter.
    """
    stored = map_rows(counted, ["word", "n"], "node long, word string, n long", _stored)
    sent = map_rows(counted, ["word", "n"], "node long, word string, n long, state int", _sent)
    nodes = stored.groupBy("node").agg((F.floor((F.count("*") - 1) / SUBTRIE) + 1).alias("slices"))
    dealt = stored.join(nodes, "node").select(
        F.xxhash64("node", F.pmod(F.xxhash64("word"), "slices")).alias("root"), F.lit(-1).alias("state"), "word", "n"
    )
    entered = sent.join(nodes, "node").select(
        "node", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice"), "state", "word", "n"
    ).select(F.xxhash64("node", "slice").alias("root"), "state", "word", "n")
    rows = dealt.union(entered).repartition("root").sortWithinPartitions("root", "state")
    return rows.mapInArrow(_searched, _PAIR)


def variants(counted: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``counted`` (word, n).

    Near words are one inserted, deleted or replaced letter apart; ``n_near`` counts them. The form is
    the near word of largest n, ties to the first in code-point order, if it is at least
    ``RATIO`` times as frequent, else null; the root is where following forms ends, the
    word itself without one. Words without near words stay; an empty table gives no rows.
    """
    counted = written(counted)
    pairs = written(near_pairs(counted))
    both = pairs.union(pairs.select("other", "other_n", "word", "n"))
    best = both.groupBy("word", "n").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")
    )
    enough = -F.col("best.less") >= RATIO * F.col("n")
    formed = written(best.select(
        "word", "n_near", F.when(enough, F.col("best.other")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n")
    ))
    # Every step at least doubles n, so the chains are short; each round halves what is left of them.
    roots = written(formed.where("form is not null").select("word", F.col("form").alias("root")))
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        following = written(
            roots.join(onward, "root", "left")
            .select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        )
        remove(roots)
        roots = following.drop("moved")
        if following.where("moved").isEmpty():
            break
    return counted.join(formed, "word", "left").join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "form_n"
    )
