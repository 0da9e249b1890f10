"""Removal of every byte covered by a long string that also starts anywhere else.

Whole suffix orders of all shards would have to be merged over the network byte by
byte. Instead, every window of ``LENGTH`` bytes names an anchor inside it, the
64-byte string of least hash, so equal windows name equal anchors. Windows of one
anchor within ``BLOCK`` places share a core of ``LENGTH - BLOCK + 1`` bytes; only
stretches whose core occurs more than once can hold repeats, and all windows equal
to theirs are in stretches of the same core. The Burrows-Wheeler transforms of
such stretches are merged core by core, which tells each repeated window exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.llm.bwt_merge import repeated_starts
from clinloom.llm.common import _by_size, map_rows, utf8, written

LENGTH = 400
ANCHOR = 64
BLOCK = 128
SLICE = 16
CROWD = 100  # texts of one core beyond which its windows are compared apart, each under its own hash
_TEXTS_AT_ONCE = 48_000  # bytes, of speed only: what keeps the merge in a core's cache
_BYTES_HASHED = 1 << 20  # of memory only: each byte hashed takes about a hundred
_PLACE_BITS = 28  # of a slice of texts; a single text may have 256 MB
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_BYTE = np.random.default_rng(400).integers(1, 1 << 63, 256, dtype=np.uint64)


def _mixed(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(31))) * _ODD
    return value ^ (value >> np.uint64(29))


def _hashes(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the 64 and of the 256 bytes from each place on."""
    value, power, short = _BYTE[flat], int(_BASE), None
    for level in range(8):
        step = 1 << level
        value = value[:-step] * np.uint64(power) + value[step:]
        power = power * power % (1 << 64)
        if step * 2 == ANCHOR:
            short = value
    return short, value


def _least(value: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row."""
    count = value.size - width + 1
    padded = np.full(-(-value.size // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: value.size] = value
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).reshape(-1)
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:count], ahead[width - 1 : width - 1 + count])


def _together(long: np.ndarray, *places: np.ndarray) -> np.ndarray:
    value = np.zeros(places[0].size, np.uint64)
    for place in places:
        value = _mixed(value * _BASE + long[place])
    return value


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(core, content, doc, text, start, windows, ahead) of all stretches of the rows (doc, text hash, text).

    ``ahead`` tells how many places before its core a stretch starts.
    """
    names = ["core", "content", "doc", "hash", "start", "windows", "ahead"]
    for batch in batches:
        for part in _by_size(batch, 2, _BYTES_HASHED):
            texts = [utf8(t) for t in part.column(2).to_pylist()]
            sizes = np.array([len(t) for t in texts], np.int64)
            use = np.flatnonzero(sizes >= LENGTH)
            if not use.size:
                continue
            flat = np.frombuffer(b"".join(texts[i] for i in use), np.uint8)
            ends = np.cumsum(sizes[use])
            short, long = _hashes(flat)
            place = np.arange(short.size, dtype=np.uint64)
            keyed = (_mixed(short) >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS)) | place
            anchor = (_least(keyed, LENGTH - ANCHOR + 1) & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
            start = np.arange(anchor.size)
            owner = np.searchsorted(ends, start, side="right")
            inside = start + LENGTH <= ends[owner]
            start, owner, anchor = start[inside], owner[inside], anchor[inside]
            center = anchor - (anchor - start) // BLOCK * BLOCK  # where the core begins
            first = np.flatnonzero((np.diff(center, prepend=-1) != 0) | (np.diff(owner, prepend=-1) != 0))
            windows = np.diff(np.append(first, start.size))
            start, owner, center = start[first], owner[first], center[first]
            last, width = start + windows - 1, long.size - 1
            reach = LENGTH - BLOCK + 1 - 256
            core = _together(long, center, center + reach)
            tail = LENGTH - 256
            content = _together(long, start, np.minimum(start + tail, width), last, last + tail)
            content = _mixed(content ^ (center - start).astype(np.uint64) ^ (windows.astype(np.uint64) << np.uint64(32)))
            begin = (ends - sizes[use])[owner]
            row = pa.array(use[owner])
            yield pa.RecordBatch.from_arrays(
                [pa.array(core.view(np.int64)), pa.array(content.view(np.int64)), part.column(0).take(row),
                 part.column(1).take(row), pa.array(start - begin), pa.array(windows.astype(np.int32)),
                 pa.array((center - start).astype(np.int32))],
                names,
            )


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of each wanted stretch (core, content, start, windows, ahead) of a text."""
    for batch in batches:
        for part in _by_size(batch, 0):
            core, content, ahead, kept = [], [], [], []
            for text, wanted in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                text = utf8(text)
                for w in wanted:
                    core.append(w["core"])
                    content.append(w["content"])
                    ahead.append(w["ahead"])
                    kept.append(text[w["start"] : w["start"] + w["windows"] - 1 + LENGTH])
            yield pa.RecordBatch.from_arrays(
                [pa.array(core, pa.int64()), pa.array(content, pa.int64()), pa.array(ahead, pa.int32()), pa.array(kept, pa.binary())],
                ["core", "content", "ahead", "bytes"],
            )


def _runs(flags: np.ndarray) -> list[dict]:
    """Runs of set flags as first and last (exclusive)."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [{"first": int(a), "last": int(b)} for a, b in zip(edges[::2], edges[1::2])]


_RUNS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))


def _merge_cores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated windows of stretches (core, content, bytes) that come sorted by core."""
    waiting: list[tuple[int, int, bytes]] = []
    size = 0

    def settle(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        flags = repeated_starts([r[2] for r in rows], LENGTH)
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
             pa.array([_runs(f) for f in flags], _RUNS)],
            ["core", "content", "runs"],
        )

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if size > _TEXTS_AT_ONCE and row[0] != waiting[-1][0]:
                yield settle(waiting)
                waiting, size = [], 0
            waiting.append(row)
            size += len(row[2])
    if waiting:
        yield settle(waiting)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(core, content, slice, shared, first, windows): a stretch in slices of ``SLICE`` windows.

    ``shared`` is a hash of the bytes common to all windows of a slice, ``windows`` has
    one of each. Slices are counted from the core, so equal windows are in equal slices.
    """
    names = ["core", "content", "slice", "shared", "first", "windows"]
    for batch in batches:
        columns: list[list] = [[] for _ in names]
        for core, content, ahead, text in zip(*(c.to_pylist() for c in batch.columns)):
            _, long = _hashes(np.frombuffer(text, np.uint8))
            at = np.arange(len(text) - LENGTH + 1)
            window = _together(long, at, at + LENGTH - 256).view(np.int64)
            number = (ahead - at) // SLICE
            firsts = np.flatnonzero(np.diff(number, prepend=-1))
            begin = ahead - number[firsts] * SLICE
            shared = _together(long, begin, begin + LENGTH - SLICE + 1 - 256).view(np.int64)
            for i, (first, last) in enumerate(zip(firsts.tolist(), [*firsts[1:].tolist(), at.size])):
                row = (core, content, int(number[first]), int(shared[i]), first, window[first:last])
                for column, value in zip(columns, row):
                    column.append(value)
        kinds = [pa.int64()] * 5 + [pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
    for batch in batches:
        for part in _by_size(batch, 1):
            sizes, removed, spans, kept = [], [], [], []
            for text, found in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                text = utf8(text)
                merged: list[list[int]] = []
                for first, last in sorted((f["first"], f["last"]) for f in found or []):
                    if merged and first <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], last)
                    else:
                        merged.append([first, last])
                edges = [0, *[x for span in merged for x in span], len(text)]
                rest = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                sizes.append(len(text))
                removed.append(len(text) - len(rest))
                spans.append(len(merged))
                kept.append(rest)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *[pa.array(x, pa.int64()) for x in (sizes, removed, spans)], pa.array(kept, pa.binary())], names
            )


def without_repeats(documents: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept binary) of every row's whole text.

    A byte goes if a 400-byte string that covers it also starts at another place of any
    text; ``n_spans`` counts the maximal runs that went, ``kept`` holds the rest, which
    need not be UTF-8. Null text is empty; texts under 400 bytes stay whole; repeated
    rows, null ids too, are copies of each other and each lose all they share. Further
    columns are not read; an empty table gives no rows. Equal stretches are known by two
    64-bit hashes before they are merged.
    """
    texts = documents.select(
        "doc_id", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc"), F.xxhash64("text").alias("hash"), "text"
    )
    stretches = written(
        map_rows(
            texts, ["doc", "hash", "text"],
            "core long, content long, doc long, hash long, start long, windows int, ahead int", _stretches,
        )
    )
    # Counts are written before they are joined: a join straight on an aggregate keeps
    # its partitions, and Spark could not split those of a common core.
    shared = written(stretches.groupBy("core").agg(F.count("*").alias("n")).where("n > 1").select("core"))
    members = written(stretches.join(shared, "core"))
    contents = written(
        members.groupBy("core", "content").agg(
            F.count("*").alias("n"), F.min(F.struct("doc", "hash", "start", "windows", "ahead")).alias("one")
        )
    )
    crowds = written(contents.groupBy("core").agg(F.count("*").alias("contents")).where("contents > 1"))
    # Texts are fetched for cores with different contents only, one of each.
    wanted = (
        contents.join(crowds, "core").select("core", "content", "contents", "one.*")
        .groupBy("doc", "hash").agg(F.collect_list(F.struct("core", "content", "start", "windows", "ahead")).alias("wanted"))
    )
    pieces = written(
        texts.dropDuplicates(["doc", "hash"]).join(wanted, ["doc", "hash"]).select("text", "wanted")
        .mapInArrow(_texts, "core long, content long, ahead int, bytes binary").join(crowds, "core")
    )
    few = pieces.where(F.col("contents") <= CROWD).select("core", "content", "bytes")
    merged = (
        few.repartition("core").sortWithinPartitions("core")
        .mapInArrow(_merge_cores, "core long, content long, runs array<struct<first: long, last: long>>")
    )
    # Crowds: slices whose common bytes occur once hold no repeats, so few windows are left to compare.
    slices = written(
        pieces.where(F.col("contents") > CROWD).select("core", "content", "ahead", "bytes")
        .mapInArrow(_slices, "core long, content long, slice long, shared long, first long, windows array<long>")
    )
    alike = ["core", "slice", "shared"]
    candidates = written(slices.groupBy(*alike).agg(F.count("*").alias("n")).where("n > 1").select(*alike))
    windows = slices.join(candidates, alike).select(
        "core", "content", "first", F.posexplode("windows").alias("at", "window")
    )
    twice = written(windows.groupBy("core", "window").agg(F.count("*").alias("n")).where("n > 1").select("core", "window"))
    at = F.col("first") + F.col("at")
    crowded = windows.join(twice, ["core", "window"]).groupBy("core", "content").agg(
        F.collect_list(F.struct(at.alias("first"), (at + 1).alias("last"))).alias("runs")
    )
    # A content that occurs twice is a repeat as a whole.
    copies = contents.where("n > 1").select(
        "core", "content", F.array(F.struct(F.lit(0).cast("long").alias("first"), F.col("one.windows").cast("long").alias("last"))).alias("runs")
    )
    runs = written(copies.union(merged).union(crowded).where(F.size("runs") > 0))
    found = (
        members.join(runs, ["core", "content"])
        .groupBy("doc", "hash")
        .agg(
            F.flatten(
                F.collect_list(
                    F.transform(
                        "runs",
                        lambda r: F.struct(
                            (F.col("start") + r["first"]).alias("first"), (F.col("start") + r["last"] - 1 + LENGTH).alias("last")
                        ),
                    )
                )
            ).alias("found")
        )
    )
    return (
        texts.join(found, ["doc", "hash"], "left").select("doc_id", "text", "found")
        .mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
    )
