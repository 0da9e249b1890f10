"""Benchmark decontamination: test phrases searched in an FM-index of each training shard."""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinloom.llm.common import extend, fresh_name, utf8
from clinloom.llm.fm_index import FMIndex

WINDOW = 10
BLOCK_BYTES = 16 << 20  # of test texts broadcast at a time; more are searched block after block
_FILTER_BITS = 22
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")  # before lower-casing
# Bytes of words as they are, A-Z in lower case, all others a space.
_WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def words(text: str | None) -> list[bytes]:
    return utf8(text).translate(_WORD_BYTES).split()


def _pair_slot(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    mixed = (left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)


class Phrases:
    """The windows of test items as arrays of word numbers."""

    def __init__(self, items: list[tuple[str, str | None]], width: int):
        self.number: dict[bytes, int] = {}
        windows: dict[tuple, set[str]] = {}
        for item, text in items:
            ids = [self.number.setdefault(w, len(self.number) + 1) for w in words(text)]
            for i in range(max(len(ids) - width, 0) + 1 if ids else 0):
                windows.setdefault(tuple(ids[i : i + width]), set()).add(item)
        self.items = [sorted(names) for names in windows.values()]
        self.lengths = np.array([len(w) for w in windows], np.int64)
        self.reversed = np.zeros((len(windows), width), np.int64)
        for row, window in enumerate(windows):
            self.reversed[row, : len(window)] = window[::-1]
        self.shortest = int(self.lengths.min(initial=width))
        # Two words in a row that stand in no window can't be part of an occurrence.
        self.pairs = np.zeros(1 << _FILTER_BITS, bool)
        for window in windows:
            ids = np.array(window, np.int64)
            self.pairs[_pair_slot(ids[:-1], ids[1:])] = True

    def occurrences(self, ids: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, place) of every occurrence in ``ids``, the word numbers of documents one after another."""
        none = np.zeros(0, np.int64)
        if not self.lengths.size or not ids.size:
            return none, none
        linked = np.zeros(ids.size, bool)  # to the word before
        linked[1:] = (
            (ids[1:] > 0) & (ids[:-1] > 0) & (owner[1:] == owner[:-1]) & self.pairs[_pair_slot(ids[:-1], ids[1:])]
        )
        run = np.cumsum(~linked) - 1
        kept = np.flatnonzero((np.bincount(run)[run] >= self.shortest) & (ids > 0))
        if not kept.size:
            return none, none
        # A zero stands before each run that is left and after the last.
        shift = np.cumsum(np.diff(run[kept], prepend=-1) != 0)
        runs = np.zeros(kept.size + shift[-1] + 1, np.int64)
        origin = np.zeros(runs.size, np.int64)
        runs[np.arange(kept.size) + shift] = ids[kept]
        origin[np.arange(kept.size) + shift] = kept
        index = FMIndex(runs, len(self.number))
        low, high = index.search(self.reversed, self.lengths)
        counts = high - low
        window = np.repeat(np.arange(counts.size), counts)
        rows = np.arange(window.size) - np.repeat(np.cumsum(counts) - counts, counts) + low[window]
        return window, origin[index.locate(rows)]


def _merged(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    spans: list[list[int]] = []
    for start, end in sorted(zip(starts.tolist(), ends.tolist())):
        if spans and start <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], end)
        else:
            spans.append([start, end])
    return [tuple(s) for s in spans]


_FOUND = "struct<n_words: long, spans: array<struct<first: long, last: long, start: long, end: long>>, items: array<string>>"
_FOUND_ARROW = pa.struct([
    ("n_words", pa.int64()),
    ("spans", pa.list_(pa.struct([(c, pa.int64()) for c in ("first", "last", "start", "end")]))),
    ("items", pa.list_(pa.string())),
])


def _search(load: Callable[[], Phrases]) -> Callable[[list[str | None]], list[pa.Array]]:
    """Word count, merged spans of hit words (first, last, and their characters) and items of each text."""
    held: list[Phrases] = []

    def search(texts: list[str | None]) -> list[pa.Array]:
        if not held:
            held.append(load())
        wanted = held[0]
        get = wanted.number.get
        numbers = [np.array([get(w, 0) for w in words(t)], np.int64) for t in texts]
        sizes = np.array([n.size for n in numbers], np.int64)
        owner = np.repeat(np.arange(sizes.size), sizes)
        begin = np.cumsum(sizes) - sizes
        window, place = wanted.occurrences(np.concatenate(numbers), owner)
        order = np.argsort(place, kind="stable")
        window, place = window[order], place[order]
        out = [{"n_words": n, "spans": [], "items": []} for n in sizes.tolist()]
        cuts = np.flatnonzero(np.diff(owner[place], prepend=-1)).tolist()
        for at, end in zip(cuts, [*cuts[1:], place.size]):
            doc = int(owner[place[at]])
            starts = place[at:end] - begin[doc]
            spans = _merged(starts, starts + wanted.lengths[window[at:end]])
            found = list(_WORD.finditer(texts[doc]))
            out[doc]["spans"] = [
                {"first": a, "last": b, "start": found[a].start(), "end": found[b - 1].end()} for a, b in spans
            ]
            out[doc]["items"] = sorted({name for w in set(window[at:end].tolist()) for name in wanted.items[w]})
        return [pa.array(out, _FOUND_ARROW)]

    return search


# Spans of several blocks: sorted, and those that meet joined.
_JOIN_SPANS = """
    aggregate(array_sort(flatten({all})), cast(array() as array<struct<first: long, last: long, start: long, end: long>>),
        (done, s) -> if(size(done) > 0 and s.first <= element_at(done, -1).last,
            concat(slice(done, 1, size(done) - 1), array(named_struct(
                'first', element_at(done, -1).first, 'last', greatest(s.last, element_at(done, -1).last),
                'start', element_at(done, -1).start, 'end', greatest(s.end, element_at(done, -1).end)))),
            concat(done, array(s))))
"""


def contamination(documents: DataFrame, benchmark: DataFrame, keep: list[str], found: str, width: int = WINDOW) -> DataFrame:
    """The ``keep`` columns of ``documents`` and a struct ``found``: n_words, spans, items.

    A window is ``width`` consecutive words of a ``benchmark`` (item_id, text) item, or a
    shorter item whole. ``spans`` are the maximal runs of document words inside any
    occurrence of a window: words first to last (exclusive) and characters start to
    end. ``items`` are the ids, as sorted strings, whose windows occur. Null texts have
    no words, items without words no windows; a null item_id reads as an empty string;
    repeated items and rows do no harm. Test texts are broadcast in blocks of about
    16 MB; an empty benchmark finds nothing, empty documents give no rows.
    """
    context = documents.sparkSession.sparkContext
    # Each item once: copies of one would share a block, and no block may outgrow its size.
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + size // BLOCK_BYTES
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    result, names = documents, []
    for number in range(blocks):
        shared = context.broadcast([tuple(r) for r in items.where(block == number).collect()])
        names.append(found if blocks == 1 else fresh_name(result, f"__{found}{number}"))
        columns = keep if number == blocks - 1 else [*keep, *({"text"} - set(keep))]
        result = extend(
            result, "text", [*columns, *names[:-1]], f"`{names[-1]}` {_FOUND}",
            _search(lambda shared=shared: Phrases(shared.value, width)),
        )
    if blocks == 1:
        return result
    spans = _JOIN_SPANS.format(all="array(" + ", ".join(f"`{n}`.spans" for n in names) + ")")
    joined = F.struct(
        F.col(f"`{names[0]}`.n_words").alias("n_words"),
        F.expr(spans).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.array(*[F.col(f"`{n}`.items") for n in names])))).alias("items"),
    )
    return result.select(*[F.col(f"`{c}`") for c in keep], joined.alias(found))


def without_spans(text: str, found: str) -> Column:
    """The text in column ``text`` less the spans in ``found``; where nothing is found, as it is."""
    spans = f"`{found}`.spans"
    gaps = f"""
        array_join(transform(sequence(0, size({spans})), i -> substring(`{text}`,
            cast(if(i = 0, 0, {spans}[i - 1].end) as int) + 1,
            cast(if(i = size({spans}), char_length(`{text}`), {spans}[i].start) - if(i = 0, 0, {spans}[i - 1].end) as int))), '')
    """
    return F.expr(f"if(size({spans}) = 0, `{text}`, {gaps})")
