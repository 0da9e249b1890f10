"""SimHash near-duplicates by multi-index hashing over 64-bit fingerprints.

A fingerprint is cut into two halves. Two fingerprints at most three bits apart
agree in one half up to one bit, so each half is a table: first the exact half,
then its Hamming ball of radius one is looked up, and each match is verified on
the whole fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.llm.common import map_rows, utf8, written
from clinloom.llm.components import components

SEED = 42
SHINGLE = 3
DISTANCE = 3
_HASHES_AT_ONCE = 1 << 16  # of memory only: hashes are counted in slices of this many
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingle_hashes(text: str | None) -> list[int]:
    """XXH64 of every word shingle; a text of fewer words is one shingle."""
    words = utf8(text).translate(_LOWER).split()
    if len(words) < SHINGLE:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []
    digest = xxhash.xxh64_intdigest
    return [digest(b" ".join(three), SEED) for three in zip(words, words[1:], words[2:])]


def _majorities(hashes: list[int], lengths: list[int]) -> np.ndarray:
    """One fingerprint for each run of ``lengths`` hashes: the bits set in over half of them."""
    out = np.zeros(len(lengths), np.uint64)
    filled = np.flatnonzero(lengths)
    if not filled.size:
        return out
    sizes = np.asarray(lengths)[filled]
    ends = np.cumsum(sizes)
    all_hashes = np.array(hashes, np.uint64)
    counts = np.zeros((filled.size, 64), np.int64)
    for first in range(0, all_hashes.size, _HASHES_AT_ONCE):
        part = all_hashes[first : first + _HASHES_AT_ONCE]
        bits = np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        lo = np.searchsorted(ends, first, side="right")
        hi = np.searchsorted(ends, first + part.size, side="left")
        starts = np.maximum(ends[lo : hi + 1] - sizes[lo : hi + 1] - first, 0)
        counts[lo : hi + 1] += np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
    packed = np.packbits(counts * 2 > sizes[:, None], axis=1)
    out[filled] = packed.view(">u8")[:, 0]
    return out


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found, hashes, lengths = [], [], []
        for text in batch.column(1):
            mine = shingle_hashes(text.as_py())
            hashes += mine
            lengths.append(len(mine))
            if len(hashes) >= _HASHES_AT_ONCE:
                found.append(_majorities(hashes, lengths))
                hashes, lengths = [], []
        found.append(_majorities(hashes, lengths))
        bits = np.concatenate(found).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits)], ["doc_id", "bits"])


def fingerprints(documents: DataFrame) -> DataFrame:
    """(doc_id, bits long): the fingerprint of every row's whole text, null text as empty."""
    return map_rows(documents, ["doc_id", "text"], "doc_id long, bits long", _fingerprint_batches)


def _bucket_links(bits: np.ndarray) -> tuple[list[int], list[int]]:
    """Links that connect what is linked within one bucket: a forest, not all pairs."""
    left, right = [], []
    todo = bits.view(np.uint64)
    while todo.size:
        reached, todo = [todo[0]], todo[1:]
        while reached and todo.size:
            node = reached.pop()
            near = np.bitwise_count(todo ^ node) <= DISTANCE
            if near.any():
                found = todo[near]
                todo = todo[~near]
                left += [int(node.view(np.int64))] * found.size
                right += found.view(np.int64).tolist()
                reached += list(found)
    return left, right


def _exact_half_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links among rows (half, bits) of equal half; rows come sorted by it."""
    rest_half, rest_bits = np.empty(0, np.int64), np.empty(0, np.int64)

    def linked(half: np.ndarray, bits: np.ndarray) -> pa.RecordBatch:
        cuts = np.flatnonzero(np.diff(half)) + 1
        starts = np.concatenate([[0], cuts])
        ends = np.concatenate([cuts, [half.size]])
        left, right = [], []
        for a, b in zip(starts[ends - starts > 1], ends[ends - starts > 1]):
            x, y = _bucket_links(bits[a:b])
            left += x
            right += y
        return pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    for batch in batches:
        half = np.concatenate([rest_half, batch.column(0).to_numpy(zero_copy_only=False)])
        bits = np.concatenate([rest_bits, batch.column(1).to_numpy(zero_copy_only=False)])
        if not half.size:
            continue
        last = int(np.searchsorted(half, half[-1], side="left"))  # its bucket may go on in the next batch
        rest_half, rest_bits = half[last:], bits[last:]
        if last:
            yield linked(half[:last], bits[:last])
    if rest_half.size:
        yield linked(rest_half, rest_bits)


# A half's number stands above its 32 bits, so both tables share one key column.
_LOW = "bits & 4294967295L"
_HIGH = "(shiftrightunsigned(bits, 32) | 4294967296L)"


def links(prints: DataFrame) -> DataFrame:
    """(a, b) links that give the components of distinct fingerprints ``prints`` (bits long).

    Links within a bucket come as a forest. The second round joins only what
    different components of the first hold, so a large dense group never
    gives all its pairs.
    """
    halves = prints.select(F.expr(f"explode(array({_LOW}, {_HIGH}))").alias("half"), "bits")
    first = written(
        halves.repartition("half").sortWithinPartitions("half")
        .mapInArrow(_exact_half_links, "a long, b long")
    )
    roots = components(first)
    placed = written(
        prints.join(roots, prints.bits == roots.node, "left").select("bits", F.coalesce("root", "bits").alias("part"))
    )
    table = placed.select(F.expr(f"explode(array({_LOW}, {_HIGH}))").alias("half"), "bits", "part")
    ball = "transform(sequence(0, 31), i -> {half} ^ shiftleft(1L, i))"
    probes = placed.select(
        F.expr(f"explode(concat({ball.format(half='(' + _LOW + ')')}, {ball.format(half=_HIGH)}))").alias("half"),
        F.col("bits").alias("other"),
        F.col("part").alias("other_part"),
    )
    near = (
        (F.col("bits") < F.col("other"))
        & (F.col("part") != F.col("other_part"))
        & (F.bit_count(F.col("bits").bitwiseXOR(F.col("other"))) <= DISTANCE)
    )
    # Spark sizes both sides as if nothing were exploded, up to 64 times too low; neither may be broadcast by that.
    second = table.hint("merge").join(probes.hint("merge"), "half").where(near).select(F.col("part").alias("a"), F.col("other_part").alias("b"))
    return written(first.union(second.distinct()))


def near_duplicates(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, bits long and component_id, the smallest doc_id reached.

    Fingerprints link at three or fewer differing bits; copies share theirs. Null
    texts have fingerprint zero like empty ones, repeated rows stay, a component
    with null ids only has a null id. An empty table gives no rows, further
    columns are not read.
    """
    prints = written(fingerprints(documents))
    least = prints.groupBy("bits").agg(F.min("doc_id").alias("least"))
    roots = components(links(least.select("bits")))
    rooted = written(
        least.join(roots, least.bits == roots.node, "left")
        .select("bits", "least", F.coalesce("root", "bits").alias("root"))
    )
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    # Files of fingerprints are several times smaller than their rows in memory, so they aren't broadcast by file size.
    found = rooted.join(ids.hint("merge"), "root").select("bits", "component_id")
    return prints.join(found.hint("merge"), "bits").select("doc_id", "bits", "component_id")
