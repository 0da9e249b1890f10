"""Documents scored by cross-entropy difference of two n-gram models.

Tokens are words and single other signs, or characters. Both models share one
vocabulary, every token of all texts, and have the same order and smoothing. Texts are
split once, into chunks of token numbers. For each length of n-grams a chunk asks for the
counts of its distinct n-grams (64-bit hashes), dealt evenly to tasks by hash, and gets them
back in the order in which it asked; with all its counts it scores its own texts. A
document's score is the mean difference of the two losses per token.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.llm.common import _by_size, remove, utf8, written

ORDER = 4
SYMBOLS = 48  # the fewest tokens over which the shortest context is spread
PRIOR = 5.0  # weight, in tokens, of the shorter context in a longer one's distribution
_TOKENS_AT_ONCE = 1 << 21  # of memory only: tokens of a chunk, but a text is never cut
_ASKED_AT_ONCE = 1 << 20  # of memory only: n-grams that are summed together
_SLICES = 3  # of disk only: parts of the n-grams, and of the chunks, that are worked on one after another
_WORD = re.compile(r"\w+|[^\w\s]")
_SALT = 0x9E3779B97F4A7C15


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def characters(text: str) -> list[str]:
    return list(text.lower())


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class _Numbers(dict):
    """Numbers tokens from 1 in the order in which they come."""

    def __missing__(self, token: str) -> int:
        self[token] = number = len(self) + 1
        return number


def _packed(values: np.ndarray) -> bytes:
    """Numbers, compressed byte by byte: their high bytes are alike."""
    planes = values.view(np.uint8).reshape(-1, values.itemsize).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), "zstd", asbytes=True)


def _unpacked(data: bytes, n: int, kind: type) -> np.ndarray:
    wide = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data, wide * n, "zstd", asbytes=True), np.uint8).reshape(wide, n)
    return np.ascontiguousarray(planes.T).view(kind)[:, 0]


def _order(values: np.ndarray) -> np.ndarray:
    """The order of numbers that leave as many bits free as their places need."""
    bits = np.uint64(values.size.bit_length())
    order = np.sort(values << bits | np.arange(values.size, dtype=np.uint64))
    return (order & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sorted distinct hashes, where each begins among all in order, and that order."""
    # The place stands in the hash's lowest bits, so that plain numbers are sorted; who then stands wrong is put right.
    order = _order(values >> np.uint64(values.size.bit_length()))
    found = values[order]
    if (found[1:] < found[:-1]).any():
        again = np.argsort(found, kind="stable")
        order, found = order[again], found[again]
    first = np.flatnonzero(np.append(np.ones(min(1, found.size), bool), found[1:] != found[:-1]))
    return found[first], first, order


def _which(first: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Of each value the number of its hash among the distinct ones."""
    which = np.empty(order.size, np.int64)
    which[order] = np.repeat(np.arange(first.size), np.diff(np.append(first, order.size)))
    return which


#: A chunk of texts. asks: whether any is scored; n: its tokens; all_t, all_b: the tokens each model learns from; of its texts the
#: rows (-1: only learned from), numbers of tokens and whether a model learns from them; the hashes of its distinct
#: tokens, and its tokens as numbers from 1 in these.
_CHUNK = {
    "chunk": pa.int64(), "asks": pa.bool_(), "n": pa.int64(), "all_t": pa.int64(), "all_b": pa.int64(), "rows": pa.binary(),
    "sizes": pa.binary(), "t": pa.binary(), "b": pa.binary(), "words": pa.binary(), "tokens": pa.binary(),
}
_CHUNK_DDL = "chunk long, asks boolean, n long, all_t long, all_b long, " + ", ".join(f"{c} binary" for c in list(_CHUNK)[5:])


def _chunks(split: Callable[[str], list[str]], kept: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Texts (kept columns, row, text, t, b) as chunks; each with a row number gives its kept columns and number too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        known, held, size = _Numbers(), [], 0
        own: list[pa.Field] = []

        def filled(n: int, columns: dict) -> pa.RecordBatch:
            fields = [*own, *[pa.field(c, kind) for c, kind in _CHUNK.items()]]
            return pa.RecordBatch.from_arrays(
                [columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in fields], schema=pa.schema(fields)
            )

        def chunk() -> pa.RecordBatch:
            rows, t, b = (np.array([h[i] for h in held], np.int64) for i in range(3))
            sizes = np.array([h[3].size for h in held], np.int64)
            words = np.array([xxhash.xxh64_intdigest(utf8(w), 42) or 1 for w in known], np.uint64)
            tokens = np.concatenate([h[3] for h in held])
            values = [number, bool((rows >= 0).any()), tokens.size, int(t @ sizes), int(b @ sizes), *[x.tobytes() for x in (rows, sizes, t, b, words)], _packed(tokens)]
            return filled(1, {c: pa.array([v], kind) for (c, kind), v in zip(_CHUNK.items(), values)})

        for batch in batches:
            own[:] = [f.with_nullable(True) for f in batch.schema][: kept + 1]
            for part in _by_size(batch, kept + 1):
                scored = part.filter(pc.is_valid(part.column(kept)))
                if scored.num_rows:
                    yield filled(scored.num_rows, {f.name: c for f, c in zip(own, scored.columns)})
                for row, text, t, b in zip(*[part.column(kept + i).to_pylist() for i in range(4)]):
                    tokens = split(text or "")
                    if not tokens:
                        continue
                    held.append((-1 if row is None else row, t, b, np.fromiter(map(known.__getitem__, tokens), np.uint32, len(tokens))))
                    size += len(tokens)
                    if size >= _TOKENS_AT_ONCE:
                        yield chunk()
                        number += 1
                        known, held, size = _Numbers(), [], 0
        if held:
            yield chunk()

    return run


class _Grams:
    """The n-grams of a chunk. A place is a token or, ahead of each text, its beginning, where all is padding."""

    def __init__(self, chunk: dict, order: int):
        self.order = order
        self.rows, self.sizes, self.t, self.b = (np.frombuffer(chunk[c], np.int64) for c in ("rows", "sizes", "t", "b"))
        tokens = _unpacked(chunk["tokens"], int(self.sizes.sum()), np.uint32)
        self.words = np.append(np.uint64(0), np.frombuffer(chunk["words"], np.uint64))
        self.text = np.repeat(np.arange(self.sizes.size), self.sizes + 1)
        self.at = np.arange(self.text.size) + (self.text + 1) * (order - 1)
        firsts = np.cumsum(self.sizes + 1) - self.sizes - 1
        self.token = np.ones(self.text.size, bool)
        self.token[firsts] = False
        self.goes_on = np.ones(self.text.size, bool)  # a token comes behind this place
        self.goes_on[firsts + self.sizes] = False
        self.flat = np.zeros(tokens.size + self.sizes.size * order, np.uint32)
        self.flat[self.at[self.token]] = tokens

    def hashes(self, k: int) -> np.ndarray:
        """Of each place the hash of the ``k`` tokens that end there."""
        out = np.zeros(self.at.size, np.uint64)
        for i in range(k):
            out += _mixed(self.words + np.uint64((i + 1) * _SALT & (1 << 64) - 1))[self.flat[self.at - i]]
        return _mixed(out + np.uint64(k))

    def distinct(self, k: int, low: int = 0, high: int = 1 << 64) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Places whose hash lies between, and the sorted distinct hashes among them, as ``_runs`` says."""
        if k == 1:
            return self._tokens()
        found = self.hashes(k)
        places = self.token.copy() if k == self.order else np.ones(found.size, bool)
        if low or high < 1 << 64:
            places &= (found >= np.uint64(low)) & (found <= np.uint64(high - 1))
        places = np.flatnonzero(places)
        return places, *_runs(found[places])

    def _tokens(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The same for 1-grams, of which only the chunk's distinct tokens are hashed and sorted; all of them, no slice."""
        numbers = self.flat[self.at]
        places = np.flatnonzero(self.token) if self.order == 1 else np.arange(numbers.size)
        least = int(self.order == 1)  # the padding is no 1-gram to be counted
        keys, _, rank = _runs(_mixed(_mixed(self.words[least:] + np.uint64(_SALT)) + np.uint64(1)))
        place = np.empty(rank.size, np.uint64)
        place[rank] = np.arange(rank.size)
        which = place[numbers[places] - least]
        first = np.append(0, np.cumsum(np.bincount(which.astype(np.int64), minlength=keys.size))[:-1])
        return places, keys, first, _order(which)

    def counts(self, k: int, places: np.ndarray, first: np.ndarray, order: np.ndarray) -> list[np.ndarray]:
        """How often the models meet each distinct n-gram, and, of the shorter ones, how often something follows it."""
        places = places[order]
        text, out = self.text[places], []
        for where in [self.token] if k == self.order else [self.token, self.goes_on]:
            out += [np.add.reduceat(learned[text] * where[places], first) if first.size else first for learned in (self.t, self.b)]
        return out


def _asked(k: int, order: int, edges: list[int], first: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A chunk's distinct ``k``-grams with its counts, a row for each bucket of hashes between two ``edges``."""
    inner = np.array(edges[1:-1], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in batch.to_pylist():
                grams = _Grams(chunk, order)
                places, keys, *runs = grams.distinct(k, edges[0], edges[-1])
                counts = grams.counts(k, places, *runs)
                cuts = [0, *np.searchsorted(keys, inner).tolist(), keys.size]
                rows = []
                for bucket, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    if b > a:
                        rows.append((
                            first + bucket, chunk["chunk"], chunk["asks"], b - a, _packed(np.diff(keys[a:b], prepend=np.uint64(0))),
                            _packed(np.concatenate([c[a:b] for c in counts])),
                        ))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c) for c in zip(*rows)], ["bucket", "chunk", "asks", "n", "keys", "counts"]
                    )

    return run


_ASKED = "bucket long, chunk long, asks boolean, n long, keys binary, counts binary"
_TOLD = "level long, bucket long, chunk long, n long, counts binary, distinct long"


def _told(k: int, wide: int) -> Callable[[pa.Table], pa.Table]:
    """All chunks' counts of the n-grams of a bucket, for each chunk in its order; a row without a chunk says how many n-grams."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        keys = np.concatenate([np.cumsum(_unpacked(r["keys"], r["n"], np.uint64), dtype=np.uint64) for r in rows])
        keys, first, order = _runs(keys)
        which = _which(first, order)
        counts = np.concatenate([_unpacked(r["counts"], r["n"] * wide, np.int64).reshape(wide, -1) for r in rows], axis=1)
        total = np.add.reduceat(counts[:, order], first, axis=1)
        out, start, bucket = [(k, rows[0]["bucket"], None, None, None, keys.size)], 0, rows[0]["bucket"]
        for r in rows:
            if r["asks"]:
                out.append((k, bucket, r["chunk"], r["n"], _packed(total[:, which[start : start + r["n"]]].ravel()), None))
            start += r["n"]
        kinds = (*[pa.int64()] * 4, pa.binary(), pa.int64())
        return pa.Table.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out), kinds)], ["level", "bucket", "chunk", "n", "counts", "distinct"])

    return run


def _scores(order: int, all_t: int, all_b: int, even: float) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """(row, n, t, b) of a chunk's texts: tokens and both sums of losses (nats)."""

    def run(chunk: pa.Table, told: pa.Table) -> pa.Table:
        grams = _Grams(chunk.to_pylist()[0], order)
        answers = sorted(told.to_pylist(), key=lambda r: (r["level"], r["bucket"]))
        token = np.flatnonzero(grams.token)
        p, q = np.full(token.size, even), np.full(token.size, even)
        all_of = [np.float64(all_t), np.float64(all_b)]
        for k in range(1, order + 1):
            wide = 2 if k == order else 4
            mine = np.concatenate([_unpacked(r["counts"], r["n"] * wide, np.int64).reshape(wide, -1) for r in answers if r["level"] == k], axis=1)
            _, keys, *runs = grams.distinct(k)
            which = _which(*runs)
            if keys.size != mine.shape[1]:
                raise ValueError(f"{mine.shape[1]} counts of {keys.size} n-grams")
            here = which if k == order else which[token]
            p = (mine[0][here] + PRIOR * p) / (all_of[0] + PRIOR)
            q = (mine[1][here] + PRIOR * q) / (all_of[1] + PRIOR)
            if k < order:  # of the next level: what follows the n-gram one place before
                all_of = [mine[2][which[token - 1]], mine[3][which[token - 1]]]
        starts = np.cumsum(grams.sizes) - grams.sizes
        t, b = (np.add.reduceat(-np.log(x), starts) for x in (p, q))
        of = grams.rows >= 0
        return pa.table({"row": grams.rows[of], "n": grams.sizes[of], "t": t[of], "b": b[of]})

    return run


def _work(df: DataFrame, **settings: str) -> DataFrame:
    """``written``; the shuffles behind it go at once, as nothing reads them again."""
    settings = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"} | settings
    conf = df.sparkSession.conf
    before = {name: conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            conf.set(name, value)
        return written(df)
    finally:
        for name, value in before.items():
            conf.set(name, value)


#: Of memory only: a chunk is one row of some MB.
_FEW = {"spark.sql.execution.arrow.maxRecordsPerBatch": "8"}


def _counted(chunks: DataFrame, order: int, tokens: int) -> tuple[list[DataFrame], int]:
    """The counts that each scored chunk asks for, and how many distinct tokens there are."""
    found, size = [], 0
    for k in range(1, order + 1):
        slices = _SLICES if k > 1 else 1
        buckets = 1 + tokens // (slices * _ASKED_AT_ONCE)
        edges = [(1 << 64) * i // (slices * buckets) for i in range(slices * buckets + 1)]
        for first in range(0, slices * buckets, buckets):
            asked = chunks.mapInArrow(_asked(k, order, edges[first : first + buckets + 1], first), _ASKED)
            told = _work(asked.groupBy("bucket").applyInArrow(_told(k, 2 if k == order else 4), _TOLD), **_FEW)
            if k == 1:
                size = told.agg(F.sum("distinct")).first()[0] or 0
            found.append(told)
    return found, size


def scored(
    documents: DataFrame, target: DataFrame, background: DataFrame, keep: list[str],
    split: Callable[[str], list[str]] = characters, order: int = ORDER,
) -> DataFrame:
    """The ``keep`` columns of ``documents`` with n_tokens, target_loss, background_loss and score.

    ``score`` is target_loss less background_loss, nats per token: the lower, the
    more like the target. The models learn from all texts of ``target`` and
    ``background``; one without texts is uniform. A null or empty text has no tokens and
    null losses. Rows stay as they are, an empty table gives no rows. ``split`` makes
    tokens (``characters`` or ``words``) and ``order`` is the length of the n-grams; the
    vocabulary has every token of all three tables. Each context's distribution is smoothed
    by that of the context one token shorter. The driver gets four numbers.
    """
    names = [f"__keep{i}" for i in range(len(keep))]

    def texts(frame: DataFrame, row, t: int, b: int) -> DataFrame:
        own = [F.col(f"`{c}`") if row is not None else F.lit(None).cast(documents.schema[c].dataType) for c in keep]
        number = F.lit(None).cast("long") if row is None else row
        return frame.select(
            *[c.alias(name) for c, name in zip(own, names)], number.alias("row"), "text", F.lit(t).alias("t"), F.lit(b).alias("b")
        )

    every = texts(documents, F.monotonically_increasing_id(), 0, int(documents is background))
    every = every.union(texts(target, None, 1, 0))
    if documents is not background:
        every = every.union(texts(background, None, 0, 1))
    own = ", ".join(f"{name} {documents.schema[c].dataType.simpleString()}" for c, name in zip(keep, names))
    kept = _work(every.mapInArrow(_chunks(split, len(keep)), f"{own}{', ' if own else ''}row long, {_CHUNK_DDL}"))
    chunks = kept.where("chunk is not null").select(*_CHUNK)
    all_t, all_b, tokens = chunks.agg(F.sum("all_t"), F.sum("all_b"), F.sum("n")).first()
    told, size = _counted(chunks, order, tokens or 0)
    # The distinct 1-grams have the padding among them, which is no token.
    even = 1.0 / max(SYMBOLS, size - (size > 0 and order > 1) + 2)
    answers = told[0]
    for frame in told[1:]:
        answers = answers.union(frame)
    answers = answers.where("chunk is not null")
    asking, sums = chunks.where("asks"), None
    for number in range(_SLICES):
        mine = F.pmod(F.xxhash64("chunk"), F.lit(_SLICES)) == number
        part = _work(
            asking.where(mine).groupBy("chunk").cogroup(answers.where(mine).groupBy("chunk"))
            .applyInArrow(_scores(order, all_t or 0, all_b or 0, even), "row long, n long, t double, b double"),
            **_FEW,
        )
        sums = part if sums is None else sums.union(part)
    for frame in told:
        remove(frame)
    n = F.col("n")
    return kept.where("chunk is null").select(*names, "row").join(sums, "row", "left").select(
        *[F.col(name).alias(c) for name, c in zip(names, keep)],
        F.coalesce("n", F.lit(0)).cast("long").alias("n_tokens"),
        (F.col("t") / n).alias("target_loss"), (F.col("b") / n).alias("background_loss"),
        (F.col("t") / n - F.col("b") / n).alias("score"),
    )
