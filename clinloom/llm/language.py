"""Language identification: per-word scores, script candidates and Viterbi spans.

A language is a table of smoothed log frequencies over hashed byte trigrams of its
words. A word's script narrows the languages it can have; Viterbi over the
words' scores with a penalty for each switch labels spans of mixed text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.llm.common import _by_size, extend, map_rows

BUCKETS = 1 << 15  # of trigrams: the size of a language's table, whatever the corpus
SWITCH = 12.0  # nats a switch of language costs
SCRIPT_SHARE = 0.01  # of a language's words that makes a script one of its own
_OUTSIDE = -60.0  # score of a word in a script that isn't the language's
UNKNOWN = "und"
# First code points of ranges, and the script that starts there; others are of no script.
_RANGES = [
    (0x0041, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0700, ""), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "indic"),
    (0x0E00, "thai"), (0x0E80, ""), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x1380, ""),
    (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, ""), (0x3040, "kana"), (0x3100, ""), (0x3130, "hangul"),
    (0x3190, ""), (0x3400, "han"), (0xA000, ""), (0xAC00, "hangul"), (0xD7B0, ""), (0xF900, "han"), (0xFB00, ""),
    (0x20000, "han"), (0x32000, ""),
]
_SCRIPTS = sorted({name for _, name in _RANGES} | {""})
_STARTS = np.array([0] + [start for start, _ in _RANGES])
_NUMBERS = np.array([_SCRIPTS.index("")] + [_SCRIPTS.index(name) for _, name in _RANGES])
# ASCII bytes that aren't letters part words; all other bytes stay.
_LETTERS = bytes(c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_LETTERS).split()


def has_letter(text: str | None) -> bool:
    return any(c.isalpha() for c in text or "")


def _scripts(distinct: list[bytes]) -> np.ndarray:
    """The script of each word, by its first character."""
    points = [ord(w[:4].decode("utf-8", "ignore")[:1] or "\0") for w in distinct]
    return _NUMBERS[np.searchsorted(_STARTS, points, side="right") - 1]


def _trigrams(distinct: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the trigrams of all words with their borders, one after another, and where each word starts."""
    flat = np.frombuffer(b" " + b" ".join(distinct) + b" ", np.uint8).astype(np.uint32)
    mixed = (flat[:-2] * np.uint32(65536) + flat[1:-1] * np.uint32(256) + flat[2:]) * np.uint32(2654435761)
    bucket = (mixed >> np.uint32(17)).astype(np.int64) % BUCKETS
    sizes = np.array([len(w) for w in distinct], np.int64)
    return bucket[flat[1:-1] != 32], np.cumsum(sizes) - sizes


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, bucket, n) of this task's labelled texts; the buckets after the last count scripts."""
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for part in _by_size(batch, 1):
            counters: dict[str, Counter] = {}
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                counters.setdefault(lang, Counter()).update(words(text))
            for lang, counter in counters.items():
                if not counter:
                    continue
                distinct = list(counter)
                weights = np.array(list(counter.values()), np.float64)
                buckets, _ = _trigrams(distinct)
                sizes = [len(w) for w in distinct]
                seen = totals.setdefault(lang, np.zeros(BUCKETS + len(_SCRIPTS)))
                seen[:BUCKETS] += np.bincount(buckets, np.repeat(weights, sizes), BUCKETS)
                seen[BUCKETS:] += np.bincount(_scripts(distinct), weights, len(_SCRIPTS))
    for lang, seen in totals.items():
        filled = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * filled.size, pa.string()), pa.array(filled), pa.array(seen[filled].astype(np.int64))],
            ["lang", "bucket", "n"],
        )


class Model:
    """Scores of words by language, and the best path through them."""

    def __init__(self, counts: dict[str, list[tuple[int, int]]]):
        self.languages = sorted(counts)
        table = np.zeros((len(self.languages), BUCKETS + len(_SCRIPTS)))
        for row, lang in enumerate(self.languages):
            for bucket, n in counts[lang]:
                table[row, bucket] = n
        grams, scripts = table[:, :BUCKETS] + 0.5, table[:, BUCKETS:]
        self.logs = np.log(grams / grams.sum(axis=1, keepdims=True)).astype(np.float32)
        self.candidate = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=1, keepdims=True), 1)

    def scores(self, distinct: list[bytes]) -> np.ndarray:
        """(language, word) scores; a word of no language's script favours none."""
        buckets, starts = _trigrams(distinct)
        sums = np.add.reduceat(self.logs[:, buckets], starts, axis=1).astype(np.float64)
        fits = self.candidate[:, _scripts(distinct)]
        sums = np.where(fits, sums, _OUTSIDE + sums.min(axis=0, keepdims=True))
        return np.where(fits.any(axis=0), sums, 0.0)

    def paths(self, scores: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The language number of every word of texts of ``sizes`` words, one after another."""
        ends = np.cumsum(sizes)
        begin = ends - sizes
        totals = np.add.reduceat(scores, begin, axis=1)
        best = totals.argmax(axis=0)
        path = np.repeat(best, sizes)
        # A path of m spans in other languages has m - 1 switches at least, and m >= 2 if it
        # has no more; where no span gains half a penalty, the best language alone is the path.
        text = np.repeat(np.arange(sizes.size), sizes)
        own = scores[path, np.arange(path.size)]
        gain = np.zeros(sizes.size)
        for row in range(len(self.languages)):
            total = np.cumsum(scores[row] - own)
            before = np.concatenate([[0.0], total[:-1]])
            base = before[begin]
            total, before = total - base[text], before - base[text]
            step = 2 * max(np.abs(total).max(), np.abs(before).max()) + 1
            least = np.minimum.accumulate(before - text * step) + text * step
            gain = np.maximum(gain, np.maximum.reduceat(total - least, begin))
        for at in np.flatnonzero(gain > SWITCH / 2):
            path[begin[at] : ends[at]] = self._viterbi(scores[:, begin[at] : ends[at]])
        return path

    def _viterbi(self, scores: np.ndarray) -> np.ndarray:
        n = scores.shape[1]
        columns = scores.T.tolist()
        value = columns[0]
        came: list[tuple[int, list[bool]]] = []  # the best language before a word, and who comes from it
        for column in columns[1:]:
            top = max(value)
            least = top - SWITCH
            switched = [v < least for v in value]
            came.append((value.index(top), switched))
            value = [(least if s else v) + x for v, s, x in zip(value, switched, column)]
        state = value.index(max(value))
        path = np.empty(n, np.int64)
        path[n - 1] = state
        for i in range(n - 2, -1, -1):
            top, switched = came[i]
            state = top if switched[state] else state
            path[i] = state
        return path


def learn(labelled: DataFrame) -> Model:
    """The model of all rows (lang, text) whose lang isn't null.

    Counting runs in the tasks; the driver gets at most 32,800 numbers a language.
    """
    counts = (
        map_rows(labelled.where("lang is not null"), ["lang", "text"], "lang string, bucket long, n long", _learn)
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
        .groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("counts"))
    )
    return Model({r["lang"]: [(c["bucket"], c["n"]) for c in r["counts"]] for r in counts.collect()})


_FOUND = "struct<lang: string, score: double, spans: array<struct<lang: string, first: long, last: long>>>"
_FOUND_ARROW = pa.struct([
    ("lang", pa.string()), ("score", pa.float64()),
    ("spans", pa.list_(pa.struct([("lang", pa.string()), ("first", pa.int64()), ("last", pa.int64())]))),
])


def _identify(load):
    held: list[Model] = []

    def identify(texts: list[str | None]) -> list[pa.Array]:
        if not held:
            held.append(load())
        model = held[0]
        index: dict[bytes, int] = {}
        numbers, letters = [], []
        for text in texts:
            mine = words(text) if model.languages and has_letter(text) else []
            numbers.append(np.array([index.setdefault(w, len(index)) for w in mine], np.int64))
            letters += map(len, mine)
        out = [{"lang": UNKNOWN, "score": 0.0, "spans": []} for _ in texts]
        filled = [i for i, n in enumerate(numbers) if n.size]
        if filled:
            sizes = np.array([numbers[i].size for i in filled], np.int64)
            path = model.paths(model.scores(list(index))[:, np.concatenate(numbers)], sizes)
            text = np.repeat(np.arange(sizes.size), sizes)
            shares = np.zeros((sizes.size, len(model.languages)))
            np.add.at(shares, (text, path), np.array(letters, np.float64))
            top = shares.argmax(axis=1)
            score = shares[np.arange(top.size), top] / shares.sum(axis=1)
            cuts = np.flatnonzero((np.diff(path, prepend=-1) != 0) | (np.diff(text, prepend=-1) != 0))
            begin = np.cumsum(sizes) - sizes
            lasts = np.append(cuts[1:], path.size)
            for row, at in enumerate(filled):
                out[at]["lang"], out[at]["score"] = model.languages[top[row]], float(score[row])
            for first, last in zip(cuts.tolist(), lasts.tolist()):
                row = text[first]
                out[filled[row]]["spans"].append(
                    {"lang": model.languages[path[first]], "first": first - begin[row], "last": last - begin[row]}
                )
        return [pa.array(out, _FOUND_ARROW)]

    return identify


def identified(documents: DataFrame, model: Model, keep: list[str], found: str) -> DataFrame:
    """The ``keep`` columns of ``documents`` and a struct ``found``: lang, score, spans.

    ``lang`` is the language of most letters on the best path, ``score`` their share,
    ``spans`` runs of words (first to last, exclusive) by language. A null text, one
    without a letter, or any text under a model without languages is ``und`` with
    score 0 and no spans. Ties go to the language first in order. Rows stay as they
    are; an empty table gives no rows.
    """
    return extend(documents, "text", keep, f"`{found}` {_FOUND}", _identify(lambda: model))


def training_rows(documents: DataFrame) -> DataFrame:
    """Labelled rows that aren't held out: crc32 of the doc_id as text, modulo 4, isn't 2."""
    return documents.where("lang is not null and coalesce(pmod(crc32(cast(doc_id as string)), 4), 0) <> 2").select("lang", "text")
