"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.llm.common import remove, written


_EDGES_AT_ONCE = 1 << 20  # of memory only: what a task contracts in one go


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of each node to the smallest node these edges connect it with."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = place[: a.size], place[a.size :]
    label = np.arange(nodes.size)
    while (apart := label[a] != label[b]).any():
        ends = np.sort([label[a][apart], label[b][apart]], axis=0)
        np.minimum.at(label, ends[1], ends[0])
        while (further := label[label]).tobytes() != label.tobytes():
            label = further
    moved = np.flatnonzero(label != np.arange(nodes.size))
    return nodes[moved], nodes[label[moved]]


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of a task as stars, so that fewer rounds are left for all tasks together."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def settle() -> pa.RecordBatch:
        u, v = _stars(*(np.concatenate(x) for x in zip(*held)))
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    for batch in batches:
        held.append(tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns))
        size += batch.num_rows
        if size >= _EDGES_AT_ONCE:
            yield settle()
            size = 0
    if held:
        yield settle()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node points to the node's smallest neighbour."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours point to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least).distinct()


def _digest(edges: DataFrame) -> tuple:
    hashed = F.xxhash64("u", "v").cast("decimal(20,0)")
    return tuple(edges.agg(F.count("*"), F.sum(hashed)).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a long, b long) but the roots.

    The root is the smallest node of its component. Each round is written to the
    shared checkpoint folder; the number of rounds grows with the logarithm of a
    component's width. Loops and repeated edges do no harm; no edges give no rows.
    """
    current = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    seen = _digest(current)
    while seen[0]:
        contracted = current.mapInArrow(_contracted, "u long, v long")
        following = written(_small_star(_large_star(contracted)))
        remove(current)
        current, before = following, seen
        seen = _digest(current)
        if seen == before:
            break
    return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
