"""Mixture-controlled packing of tokenised documents into sequences.

Each source is a queue of tokens. Queues are served in slices of ``quantum``
tokens by deficit round-robin: the next slice comes from the queue whose service
lags most behind its weight. Slice k of a queue with weight w is due at virtual
time (k + 1/2) / w, so the tokens served before it are a sum over the queues
that each task computes by itself. The deficit a queue has at the end of a
window, or of a partition, is thus carried into the next without any order of
work between partitions.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinloom.llm.common import map_rows, written

LENGTH = 1024
QUANTUM = 128
QUEUES = 1024
_WEIGHT_UNITS = 1 << 22
_STRETCH = 1 << 20  # tokens of one part of the shared queue: of the work's size only
_CACHED_WORDS = 300_000  # of memory only: later words are encoded anew each time
_ROWS_OUT = 20_000  # of memory only: rows of one Arrow batch
# Between two other characters a space starts a token and a line break is one.
_CUTS = re.compile(r"(?<=\S)(?= \S)|(?<=\S)(?=\n\S)|(?<=\S\n)(?=\S)")
# White space besides space and line break, as Python splits by it.
_RARE_SPACE = (
    "\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0            "
    "    　"
)


def _lone_spaces(text: str) -> bool:
    """Whether every white space is one space or line break between two other characters."""
    return not (
        any(c in text for c in _RARE_SPACE)
        or "  " in text or "\n\n" in text or " \n" in text or "\n " in text
        or text[:1] in (" ", "\n") or text[-1:] in (" ", "\n")
    )


def byte_bpe(path: str, ranks_path: str | None = None, end: int = 0) -> Callable[[], Callable[[str], bytes]]:
    """Maker of an encoder to little-endian uint16 ids, closed by the id ``end``.

    ``path`` is a ``tokenizers`` file of byte-level BPE; ``ranks_path`` the same
    vocabulary as ranks, with which words of Latin letters are encoded faster and
    alike. Texts are cut where a token surely starts, and ids of words seen before
    come from memory. A text with a special token's string goes in whole.
    """

    def make() -> Callable[[str], bytes]:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        fast = None
        if ranks_path:
            import public_tokenizers
            import tiktoken

            with open(ranks_path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            fast = tiktoken.Encoding(
                "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
            ).encode_ordinary
        spaced: dict[str, bytes] = {}  # by the word after a space
        first: dict[str, bytes] = {}
        tail = np.array([end], "<u2").tobytes()

        def ids_of(part: str) -> bytes:
            if fast and max(part) < "ɐ":
                ids = fast(part)
            else:
                ids = tokenizer.encode(part, add_special_tokens=False).ids
            return np.array(ids, "<u2").tobytes()

        line_break = ids_of("\n")

        def look_up(known: dict[str, bytes], parts: list[str], before: str) -> list[bytes]:
            found = list(map(known.get, parts))
            if None in found:
                for i, ids in enumerate(found):
                    if ids is None:
                        found[i] = ids = ids_of(before + parts[i])
                        if len(known) < _CACHED_WORDS:
                            known[parts[i]] = ids
            return found

        def encode(text: str) -> bytes:
            if not text:
                return tail
            if any(s in text for s in special):
                return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes() + tail
            if not _lone_spaces(text):
                return b"".join(look_up(first, _CUTS.split(text), "")) + tail
            out = []
            for i, line in enumerate(text.split("\n")):
                words = line.split(" ")
                if i:
                    out.append(line_break)
                out += look_up(first, words[:1], "")
                out += look_up(spaced, words[1:], " ")
            out.append(tail)
            return b"".join(out)

        return encode

    return make


def tokenised(documents: DataFrame, make_encoder: Callable[[], Callable[[str], bytes]], queues: dict) -> DataFrame:
    """Each row's ids, its queue and the tokens its task put into that queue before it.

    Rows of sources without a queue have the number after the last and their source beside it.
    """
    rest = len(queues)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = make_encoder(), TaskContext.get().partitionId()
        served: dict[int, int] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                few = batch.slice(at, 512)
                ids = [encoder(t.as_py() or "") for t in few.column(1)]
                sources = few.column(2).to_pylist()
                mine = [queues.get(s, rest) for s in sources]
                before = []
                for q, x in zip(mine, ids):
                    before.append(served.get(q, 0))
                    served[q] = before[-1] + len(x) // 2
                yield pa.RecordBatch.from_arrays(
                    [few.column(0), pa.array(mine, pa.int32()), pa.array([part] * len(mine), pa.int32()),
                     pa.array(before, pa.int64()), pa.array([len(x) // 2 for x in ids], pa.int64()),
                     pa.array(ids, pa.binary()),
                     pa.array([s if q == rest else None for s, q in zip(sources, mine)], pa.string())],
                    ["doc_id", "queue", "part", "before", "n", "ids", "source"],
                )

    schema = "doc_id long, queue int, part int, before long, n long, ids binary, source string"
    return map_rows(documents, ["doc_id", "text", "source"], schema, encode)


def _interleaved(tokens: DataFrame, rest: int, total: int) -> DataFrame:
    """``tokens`` with the shared queue in an order that serves all its sources in proportion.

    The rule of the queues once more, by documents: each is due where a point inside it
    lies in its source, as a share of that source. The points of a source begin at a place of
    its own, so that sources of one document are not all due at once. Times are uniform over
    tokens: equal stretches of time have about equal tokens, and each becomes a part.
    """
    small = tokens.where(F.col("queue") == rest).select("source", "part", "before", "n")
    to_here = Window.unboundedPreceding, -1
    own = Window.partitionBy("source", "part").orderBy("before").rowsBetween(*to_here)
    sums = small.groupBy("source", "part").agg(F.sum("n").alias("sum"))
    parts = Window.partitionBy("source").orderBy("part")
    bases = sums.select(
        F.col("source").alias("of"), F.col("part").alias("in"),
        F.coalesce(F.sum("sum").over(parts.rowsBetween(*to_here)), F.lit(0)).alias("base"),
        F.sum("sum").over(Window.partitionBy("source")).alias("all"),
    )
    point = F.pmod(F.xxhash64("source"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    due = small.withColumn("ahead", F.coalesce(F.sum("n").over(own), F.lit(0))).join(
        bases, F.col("source").eqNullSafe(F.col("of")) & (F.col("part") == F.col("in"))
    ).select("part", "before", "n", ((F.col("base") + F.col("ahead") + point * F.col("n")) / F.col("all")).alias("due"))
    stretches = total // _STRETCH + 1
    at = Window.partitionBy("stretch").orderBy("due", "part", "before").rowsBetween(*to_here)
    places = due.withColumn("stretch", F.least(F.floor(F.col("due") * stretches), F.lit(stretches - 1)).cast("int")).select(
        "part", "before", "stretch", F.coalesce(F.sum("n").over(at), F.lit(0)).alias("ahead")
    )
    # Every row has a token, so part and what came before name it.
    moved = tokens.where(F.col("queue") == rest).join(places, ["part", "before"])
    return tokens.where(F.col("queue") != rest).unionByName(
        moved.drop("part", "before").withColumnsRenamed({"stretch": "part", "ahead": "before"})
    )


class Schedule:
    """Where each slice of each queue stands in the packed stream."""

    def __init__(self, tokens: list[int], weights: list[float], quantum: int, length: int):
        self.tokens, self.quantum, self.length = np.array(tokens, np.int64), quantum, length
        total = float(sum(weights)) or 1.0
        self.weights = np.array([max(1, round(w / total * _WEIGHT_UNITS)) for w in weights], np.int64)
        everything = int(self.tokens.sum())
        self.full = everything // length
        # What is left after the full sequences goes to shorter ones, a power of two each.
        edges, at, left = [], self.full * length, everything % length
        while left:
            edges.append(at)
            step = 1 << (left.bit_length() - 1)
            at, left = at + step, left - step
        self.edges = np.array(edges, np.int64)

    def position(self, queue: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Tokens served before slice ``k`` of ``queue``; whole numbers, so that all tasks agree."""
        before = np.zeros(k.size, np.int64)
        own = self.weights[queue]
        for j, (weight, tokens) in enumerate(zip(self.weights, self.tokens)):
            due = (2 * k + 1) * weight
            odd = (due - (j >= queue)) // own  # at equal times the smaller queue is first
            slices = np.where(queue == j, k, (odd + 1) // 2)
            before += np.minimum(tokens, slices * self.quantum)
        return before

    def sequence(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sequence of a stream position, the offset in it and the tokens up to its end."""
        number, offset = at // self.length, at % self.length
        room = self.length - offset
        late = number >= self.full
        if late.any():
            i = np.searchsorted(self.edges, at[late], side="right") - 1
            ends = np.append(self.edges[1:], self.tokens.sum())
            number[late], offset[late], room[late] = self.full + i, at[late] - self.edges[i], ends[i] - at[late]
        return number, offset, room


def _pieces(schedule: Schedule) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                yield from some(batch.slice(at, 256))

    def some(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        queue, begin, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
        lo, hi = begin // schedule.quantum, (begin + n - 1) // schedule.quantum
        row = np.repeat(np.arange(n.size), hi - lo + 1)
        k = np.arange(row.size) - np.repeat(np.cumsum(hi - lo + 1) - (hi - lo + 1), hi - lo + 1) + lo[row]
        first = np.maximum(k * schedule.quantum, begin[row])
        length = np.minimum((k + 1) * schedule.quantum, begin[row] + n[row]) - first
        stream = schedule.position(queue[row].astype(np.int64), k) + first - k * schedule.quantum
        start = first - begin[row]
        done = []
        while row.size:  # a slice may reach over the end of a sequence
            number, offset, room = schedule.sequence(stream)
            here = np.minimum(length, room)
            done.append((row, start, here, number, offset))
            more = length > here
            row, start, stream, length = row[more], (start + here)[more], (stream + here)[more], (length - here)[more]
        row, start, length, number, offset = (np.concatenate(x) for x in zip(*done))
        ids = [np.frombuffer(x.as_buffer(), "<u2").astype("<u4") for x in batch.column(4)]
        for at in range(0, row.size, _ROWS_OUT):
            s = slice(at, at + _ROWS_OUT)
            parts = [ids[r][a : a + m].tobytes() for r, a, m in zip(row[s], start[s], length[s])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row[s])), pa.array(start[s]), pa.array(length[s]),
                 pa.array(parts, pa.binary()), pa.array(n[row[s]]), pa.array(number[s]), pa.array(offset[s])],
                names,
            )

    return cut


def pack(
    documents: DataFrame,
    make_encoder: Callable[[], Callable[[str], bytes]],
    weights: dict[str | None, float] | None = None,
    quantum: int = QUANTUM,
    length: int = LENGTH,
) -> DataFrame:
    """Pieces of documents with their place: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    ``ids`` are little-endian uint32. A queue is a source, null one of them; sources
    named in ``weights`` and, up to 1,023, those of most rows have one each. All others
    share the last, so that the schedule has a fixed size; inside it they are served in
    proportion to their tokens too, a document at a time. ``weights`` are target shares of tokens by
    source (sources not named get nothing until the named are empty, but lose nothing);
    without weights a queue's weight is its tokens, and all empty together. Sequences
    have ``length`` tokens (a power of two); the remainder goes to sequences of
    smaller powers of two, so nothing is padded. Null text is empty and has the end
    id only. Repeated rows and null ids are packed like any row; an empty table
    gives no rows; further columns are not read.
    """
    named = (
        documents.groupBy("source").agg(F.count("*").alias("rows"))
        .orderBy(F.desc("rows"), F.asc_nulls_first("source")).limit(QUEUES - 1).collect()
    )
    given = list(weights or {})
    order = given + [r["source"] for r in named if r["source"] not in given]
    queues = {source: i for i, source in enumerate(order[: max(QUEUES - 1, len(given))])}
    tokens = written(tokenised(documents, make_encoder, queues))
    total = {r["queue"]: r["n"] for r in tokens.groupBy("queue").agg(F.sum("n").alias("n")).collect()}
    if len(queues) in total:
        tokens = _interleaved(tokens, len(queues), total[len(queues)])
    sums = tokens.groupBy("queue", "part").agg(F.sum("n").alias("n"))
    ahead = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = written(sums.select("queue", "part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base")))
    counts = [total.get(q, 0) for q in range(len(queues) + 1)]
    if weights is None:
        shares = [float(n) for n in counts]
    else:
        shares = [float(weights.get(s, 0.0)) for s in queues] + [0.0]
    schedule = Schedule(counts, shares, quantum, length)
    placed = tokens.join(bases, ["queue", "part"]).select(
        "doc_id", "queue", (F.col("base") + F.col("before")).alias("begin"), "n", "ids"
    )
    schema = (
        "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    )
    return placed.mapInArrow(_pieces(schedule), schema)


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids binary, n_tokens): the pieces of each sequence in order."""
    placed = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(placed, F.lit(b""), lambda whole, piece: F.concat(whole, piece["ids"]))
    return pieces.groupBy("sequence_id").agg(joined.alias("ids"), F.sum("length").alias("n_tokens"))
