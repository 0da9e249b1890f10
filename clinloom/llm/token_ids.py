"""Token ids of a corpus as files of Re-Pair grammars, written and read in document order.

A folder of token ids is a Parquet table of shards. A shard holds the ids of
documents that follow each other in the order of doc_id: one Re-Pair grammar of all
of them, the documents' ids and where each of them starts. Shards stand in the
order of (part, number); the ids before a shard are the sum over those before it.
Writing goes through Spark's committer, so lost tasks run again and leave nothing.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clinloom.llm.common import _by_size, map_rows, remove, written
from clinloom.llm.repair import Grammar, compress

SHARD_IDS = 1 << 20  # a shard is closed once it has so many; a longer document stays whole
_CACHED_PARTS = 400_000  # of memory only: later parts are encoded anew each time
_CACHED_WORDS = 800_000  # of memory only
_SHARD = (
    "part int, number int, n_ids long, inside long, n_documents long, least_doc long, greatest_doc long, "
    "doc_ids binary, no_doc_id binary, starts binary, grammar binary"
)


# How the tokenizers file that this encoder knows cuts texts, and the same for
# lower-cased texts of Latin letters (below U+0180, but one letter that has a mark in lower case).
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_L, _N, _S = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\u017f", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
_PARTS = re.compile(f"'(?:s|t|re|ve|m|ll|d)|[{_L}]+|[{_N}]|[^{_S}{_L}{_N}]+")
# Byte-level BPE spells printable bytes as themselves and the others by characters from U+0100 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = {b: chr(b) for b in _PRINTABLE} | {b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)) - set(_PRINTABLE)))}
_OTHER = re.compile("[\u0130\u0180-\U0010ffff]|<\\|")


def encoder(path: str, end: int = 1) -> Callable[[], tuple[Callable[[str | None], bytes], int]]:
    """Maker of an encoder to little-endian ids, each text closed by ``end``, and the number of ids.

    Ids are uint16 if there are no more of them than that holds, else uint32. ``path`` is a
    ``tokenizers`` file of BPE over lower-cased texts whose spaces are dropped. The library encodes
    every part between two cuts once and it is remembered: the parts its
    pre-tokenizer makes for texts of Latin letters, else what stands between spaces. Other
    files are refused.
    """

    def make():
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        rules = json.loads(tokenizer.to_str())
        steps = [n["type"] for n in (rules["normalizer"] or {}).get("normalizers", [])]
        cuts = [t.get("pattern", {}).get("Regex") for t in (rules["pre_tokenizer"] or {}).get("pretokenizers", [])]
        special = tokenizer.get_added_tokens_decoder().values()
        if (
            steps != ["NFC", "Replace", "Lowercase"] or cuts[:1] != [_SPLIT]
            or any(not t.content.startswith("<|") or " " in t.content or t.lstrip or t.rstrip or t.single_word for t in special)
        ):
            raise ValueError("it isn't known where texts of this tokenizer can be cut")
        n_ids = max(tokenizer.get_vocab_size(), end + 1)
        kind = "H" if n_ids <= 1 << 16 else "I"
        bpe, tail = tokenizer.model.tokenize, array(kind, [end]).tobytes()
        words: dict[str, bytes] = {}  # what stands between spaces
        parts: dict[str, bytes] = {}  # what the pre-tokenizer makes of it

        def whole(word: str) -> bytes:
            return array(kind, tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

        def cut(word: str) -> bytes:
            """Ids of a word of Latin letters: of its parts, which only the byte table changes before BPE."""
            out = []
            lower = word.lower()
            for p in (lower,) if lower.isascii() and lower.isalpha() else _PARTS.findall(lower):
                ids = parts.get(p)
                if ids is None:
                    spelled = p if p.isascii() and p.isprintable() else "".join([_BYTES[c] for c in p.encode()])
                    ids = array(kind, [t.id for t in bpe(spelled)]).tobytes()
                    if len(parts) < _CACHED_PARTS:
                        parts[p] = ids
                out.append(ids)
            return b"".join(out)

        def encode(text: str | None) -> bytes:
            if not text:
                return tail
            asked = text.split(" ")
            found = list(map(words.get, asked))
            if None in found:
                for i, ids in enumerate(found):
                    if ids is None:
                        word = asked[i]
                        ids = words.get(word)
                        if ids is None:
                            ids = whole(word) if _OTHER.search(word) else cut(word)
                        found[i] = ids
                        if len(words) < _CACHED_WORDS:
                            words[word] = ids
            found.append(tail)
            return b"".join(found)

        return encode, n_ids

    return make


def _encoded(make: Callable) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = make()[0]
        for batch in batches:
            for part in _by_size(batch, 1):
                ids = [encode(t.as_py()) for t in part.column(1)]
                marks = pa.array([zlib.crc32(x) for x in ids], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), marks, pa.array(ids, pa.binary())], ["doc_id", "mark", "ids"]
                )

    return run


def _sharded(n_ids: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (doc_id, ids) in order to shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = "<u2" if n_ids <= 1 << 16 else "<u4"
        part, number, inside, docs, held, size = TaskContext.get().partitionId(), 0, 0, [], [], 0

        def shard() -> pa.RecordBatch:
            named = [d for d in docs if d is not None]
            sizes = np.array([x.size for x in held], np.int64)
            row = {
                "part": part, "number": number, "n_ids": int(sizes.sum()), "inside": inside, "n_documents": len(docs),
                "least_doc": min(named, default=None), "greatest_doc": max(named, default=None),
                "doc_ids": np.array([d or 0 for d in docs], "<i8").tobytes(),
                "no_doc_id": np.packbits([d is None for d in docs]).tobytes(),
                "starts": (np.cumsum(sizes) - sizes).astype("<i8").tobytes(),
                "grammar": compress(np.concatenate(held), n_ids),
            }
            types = [pa.int32()] * 2 + [pa.int64()] * 5 + [pa.binary()] * 4
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row.values(), types)], list(row))

        for batch in batches:
            for doc, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
                docs.append(doc)
                held.append(np.frombuffer(ids.as_buffer(), width))
                size += held[-1].size
                if size >= SHARD_IDS:
                    yield shard()
                    number, inside, docs, held, size = number + 1, inside + size, [], [], 0
        if docs:
            yield shard()

    return run


def write(documents: DataFrame, folder: str, make: Callable) -> None:
    """Write the ids of all texts of ``documents`` (doc_id, text) to the new folder ``folder``.

    Null text is an empty one: its end id only. Rows without a doc_id come first; rows of
    one doc_id stand side by side, in an order that depends on their ids alone, and are
    dealt over tasks like others however many they are. An empty table
    writes a table without shards; further columns are not read. A row must fit in a task.
    """
    ids = written(map_rows(documents, ["doc_id", "text"], "doc_id long, mark long, ids binary", _encoded(make)))
    order = [F.col("doc_id").asc_nulls_first(), F.col("mark")]
    in_order = ids.repartitionByRange(*order).sortWithinPartitions(*order)
    shards = map_rows(in_order, ["doc_id", "ids"], _SHARD, _sharded(make()[1]))
    shards.write.option("compression", "zstd").parquet(folder)
    remove(ids)


def shards(spark: SparkSession, folder: str) -> DataFrame:
    """The shards of a folder with ``first_id``, the number of ids before each."""
    table = spark.read.schema(_SHARD).parquet(folder)
    parts = table.groupBy("part").agg(F.sum("n_ids").alias("n"))
    # Bounded: a row for each task that wrote, whatever the size of the corpus.
    ahead = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("ahead"))
    return table.join(F.broadcast(ahead), "part").withColumn("first_id", F.col("ahead") + F.col("inside"))


def _documents(wanted: Callable[[np.ndarray], np.ndarray] | None):
    """Shards to rows (doc_id, start, n_tokens, ids), of all documents or of those wanted."""

    def rows(row: dict) -> tuple[list, ...]:
        doc_ids = np.frombuffer(row["doc_ids"], "<i8")
        unknown = np.unpackbits(np.frombuffer(row["no_doc_id"], np.uint8), count=doc_ids.size).astype(bool)
        starts = np.frombuffer(row["starts"], "<i8")
        sizes = np.diff(np.append(starts, row["n_ids"]))
        grammar = Grammar(row["grammar"])
        if wanted is None:
            picked, whole = np.arange(doc_ids.size), grammar.expand().astype("<u4")
            ids = [whole[a : a + n].tobytes() for a, n in zip(starts, sizes)]
        else:
            picked = np.flatnonzero(wanted(doc_ids) & ~unknown)
            ids = [grammar.expand(int(starts[i]), int(sizes[i])).astype("<u4").tobytes() for i in picked]
        return [None if unknown[i] else int(doc_ids[i]) for i in picked], starts[picked] + row["first_id"], sizes[picked], ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                docs, starts, sizes, ids = rows({n: batch.column(n)[at].as_py() for n in batch.schema.names})
                for a in range(0, len(docs), 1000):
                    some = slice(a, a + 1000)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(docs[some], pa.int64()), pa.array(starts[some]), pa.array(sizes[some]), pa.array(ids[some], pa.binary())],
                        ["doc_id", "start", "n_tokens", "ids"],
                    )

    return run


_READ = ["first_id", "n_ids", "doc_ids", "no_doc_id", "starts", "grammar"]
_DOCUMENT = "doc_id long, start long, n_tokens long, ids binary"


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document of a folder.

    ``start`` counts the ids of all documents before it, ``ids`` are little-endian uint32.
    """
    return map_rows(shards(spark, folder), _READ, _DOCUMENT, _documents(None))


def look_up(spark: SparkSession, folder: str, doc_ids: list[int]) -> DataFrame:
    """The rows of ``read`` for a few documents: opens only their shards and only their stretches of ids."""
    wanted = np.array(sorted(set(doc_ids)), np.int64)
    inside = F.lit(False)
    for doc in wanted.tolist():
        inside |= F.lit(doc).between(F.col("least_doc"), F.col("greatest_doc"))
    few = shards(spark, folder).where(inside)
    return map_rows(few, _READ, _DOCUMENT, _documents(lambda ids: np.isin(ids, wanted)))
