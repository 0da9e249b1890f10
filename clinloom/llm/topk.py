"""Exact top-k search by distributed histogram selection.

Vectors and queries are packed into blocks; a task scores one block of queries
against one of vectors. Rounds of histograms over all scores narrow, for every
query, the bin that holds its k-th best score down to that score itself. A last
pass keeps the scores at or above it and breaks ties by the smaller id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinloom.llm.common import map_rows, remove, written

SCALE = 64
BINS = 256
QUERY_BLOCK = 512
VECTOR_BLOCK = 1024
_BLOCKS_HELD = 64  # of memory only: histograms of 1 MB each
_EXACT = float(1 << 53)
_LONG = float((1 << 63) - 1024)
_MOST = 4_500_000_000_000_000_000


def _integers(vectors: list, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """floor(scale * x) as longs, by rows of one length, and which rows take part."""
    good = [i for i, v in enumerate(vectors) if v is not None and None not in v and np.isfinite(v).all()]
    width = len(vectors[good[0]]) if good else 0
    values = np.array([vectors[i] for i in good], np.float64).reshape(len(good), width)
    return np.clip(np.floor(scale * values), -_LONG, _LONG).astype(np.int64), np.array(good, np.int64)


def _pack(block: int, scale: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (id, vector) to blocks (width, ids, values, bound) of one vector length each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list] = {}

        def flush(rows: list) -> Iterator[pa.RecordBatch]:
            values, good = _integers([v for _, v in rows], scale)
            if good.size:
                ids = np.array([rows[i][0] for i in good], np.int64)
                bound = float(np.sqrt((values.astype(np.float64) ** 2).sum(axis=1).max()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([values.shape[1]], pa.int32()), pa.array([ids.tobytes()], pa.binary()),
                     pa.array([values.tobytes()], pa.binary()), pa.array([bound])],
                    ["width", "ids", "data", "bound"],
                )

        for batch in batches:
            for key, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key is None or vector is None:
                    continue
                rows = waiting.setdefault(len(vector), [])
                rows.append((key, vector))
                if len(rows) == block:
                    yield from flush(rows)
                    rows.clear()
        for rows in waiting.values():
            yield from flush(rows)

    return run


def _scores(row: dict, query_ids: np.ndarray, ids: np.ndarray) -> np.ndarray:
    width = row["width"]
    q = np.frombuffer(row["q_data"], np.int64).reshape(query_ids.size, width)
    v = np.frombuffer(row["data"], np.int64).reshape(ids.size, width)
    reach = float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * max(width, 1)
    if reach < _EXACT:  # whole numbers in doubles are exact, and far faster
        return (q.astype(np.float64) @ v.T.astype(np.float64)).astype(np.int64)
    return np.clip(q.astype(object) @ v.T.astype(object), -_MOST, _MOST).astype(np.int64)


def _own(query_ids: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of scores of a query against its own row."""
    order = np.argsort(query_ids, kind="stable")
    ranked = query_ids[order]
    first, last = np.searchsorted(ranked, ids, "left"), np.searchsorted(ranked, ids, "right")
    columns = np.repeat(np.arange(ids.size), last - first)
    rows = order[np.concatenate([np.arange(a, b) for a, b in zip(first, last)] or [np.empty(0, np.int64)]).astype(np.int64)]
    return rows, columns


def _histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of scores by (query, bin) inside each query's current bounds, summed over a task's blocks."""
    held: dict[int, np.ndarray] = {}

    def counted() -> Iterator[pa.RecordBatch]:
        for block, counts in held.items():
            cell = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(cell.size, block)), pa.array(cell // BINS), pa.array(cell % BINS), pa.array(counts[cell])],
                ["q_block", "slot", "bin", "n"],
            )
        held.clear()

    for batch in batches:
        for row in batch.to_pylist():
            query_ids, ids = np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["ids"], np.int64)
            low, high, step = (np.frombuffer(row[c], np.int64) for c in ("low", "high", "step"))
            scores = _scores(row, query_ids, ids)
            inside = (scores >= low[:, None]) & (scores < high[:, None])
            inside[_own(query_ids, ids)] = False
            q, v = np.nonzero(inside)
            cell = q * BINS + (scores[q, v] - low[q]) // step[q]
            counts = np.bincount(cell, minlength=query_ids.size * BINS)
            if row["q_block"] in held:
                held[row["q_block"]] += counts
            else:
                held[row["q_block"]] = counts
            if len(held) > _BLOCKS_HELD:
                yield from counted()
    yield from counted()


def _candidates(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Scores at or above each query's k-th best; of those of one block, no more than k can matter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                query_ids, ids = np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["ids"], np.int64)
                scores = _scores(row, query_ids, ids)
                keep = scores >= np.frombuffer(row["low"], np.int64)[:, None]
                keep[_own(query_ids, ids)] = False
                q, v = np.nonzero(keep)
                order = np.lexsort((ids[v], -scores[q, v], q))
                q, v = q[order], v[order]
                starts = np.flatnonzero(np.diff(q, prepend=-1))
                place = np.arange(q.size) - np.repeat(starts, np.diff(np.append(starts, q.size)))
                q, v = q[place < k], v[place < k]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query_ids[q]), pa.array(np.full(q.size, row["q_block"])), pa.array(q),
                     pa.array(ids[v]), pa.array(scores[q, v])],
                    ["query_id", "q_block", "slot", "vec_id", "score"],
                )

    return run


def _state(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bounds of a block's queries from (slot, low, high, step) lists, in the order of the slots."""
    for batch in batches:
        for row in batch.to_pylist():
            found = sorted((s["slot"], s["low"], s["high"], s["step"]) for s in row["slots"])
            columns = [pa.array([np.array(x, np.int64).tobytes()], pa.binary()) for x in list(zip(*found))[1:]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["q_block"]], pa.int64()), *columns], ["q_block", "low", "high", "step"]
            )


def top_k(vectors: DataFrame, queries: DataFrame, k: int, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of ``vectors`` for each row of ``queries``.

    Both have (vec_id long, embedding). Components become floor(scale * x); the score
    is the integer inner product, held within 4.5e18 on either side. A query's own id is no candidate; ties go
    to the smaller vec_id; repeated rows are rows of their own. Rows whose id or vector
    is null or whose vector holds a null or non-finite component take no part, vectors
    of another length meet only those of theirs. Fewer than k candidates are all
    given, an empty table gives no rows, further columns are not read.
    """
    pack = "width int, ids binary, data binary, bound double"
    columns = ["vec_id", "embedding"]
    numbered = F.monotonically_increasing_id()
    blocks = written(map_rows(vectors, columns, pack, _pack(VECTOR_BLOCK, scale)).withColumn("v_block", numbered))
    asked = written(
        map_rows(queries, columns, pack, _pack(QUERY_BLOCK, scale))
        .select("width", F.col("ids").alias("q_ids"), F.col("data").alias("q_data"), F.col("bound").alias("q_bound"))
        .withColumn("q_block", numbered)
    )
    extent = blocks.groupBy("width").agg(F.max("bound").alias("bound"))
    # Every score lies within the product of the largest norms.
    slots = asked.join(extent, "width").select(
        "q_block",
        F.expr(f"cast(least(bound * q_bound * 1.000001D + 2D, {_MOST}D) as long)").alias("reach"),
        F.expr("explode(sequence(0L, octet_length(q_ids) div 8 - 1))").alias("slot"),
    )
    # need: how many of the best within the bounds are still to be found.
    state = written(
        slots.select(
            "q_block", "slot", (-F.col("reach")).alias("low"), (F.col("reach") + 1).alias("high"),
            F.expr(f"(2 * reach + 1) div {BINS} + 1").alias("step"), F.lit(k).cast("long").alias("need"),
        )
    )
    keys = blocks.select("v_block", "width").join(asked.select("q_block", "width"), "width").select("v_block", "q_block")

    def pairs(state: DataFrame) -> DataFrame:
        """A row for each block of queries and each of vectors, with the queries' bounds."""
        bounds = (
            state.groupBy("q_block").agg(F.collect_list(F.struct("slot", "low", "high", "step")).alias("slots"))
            .mapInArrow(_state, "q_block long, low binary, high binary, step binary")
        )
        return (
            keys.join(asked.drop("width", "q_bound"), "q_block").join(bounds, "q_block")
            .join(blocks.drop("bound"), "v_block")
        )

    while True:
        widest = state.agg(F.max("step")).first()[0]
        if widest is None:
            break
        histograms = (
            pairs(state).mapInArrow(_histograms, "q_block long, slot long, bin long, n long")
            .groupBy("q_block", "slot", "bin").agg(F.sum("n").alias("n"))
        )
        above = F.sum("n").over(Window.partitionBy("q_block", "slot").orderBy(F.desc("bin")))
        reached = (
            histograms.withColumn("above", above)
            .groupBy("q_block", "slot").agg(F.collect_list(F.struct("above", "n", "bin")).alias("bins"))
        )
        # The bin in which the count from the top reaches what is needed; without
        # one there are fewer candidates than k: all of them count, and nothing is left to narrow.
        following = state.join(reached, ["q_block", "slot"], "left").select(
            "q_block", "slot", "low", "high", "step", "need",
            F.expr("array_min(filter(bins, b -> b.above >= need))").alias("hit"),
        )
        state, before = written(
            following.select(
                "q_block", "slot",
                F.expr("if(hit is null, low, low + hit.bin * step)").alias("low"),
                F.expr("if(hit is null, low, least(high, low + (hit.bin + 1) * step))").alias("high"),
                F.expr(f"if(hit is null, 1, (step - 1) div {BINS} + 1)").alias("step"),
                F.expr("if(hit is null, need, need - (hit.above - hit.n))").alias("need"),
            )
        ), state
        remove(before)
        if widest == 1:
            break
    best = Window.partitionBy("q_block", "slot").orderBy(F.desc("score"), "vec_id")
    return (
        pairs(state).mapInArrow(_candidates(k), "query_id long, q_block long, slot long, vec_id long, score long")
        .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
