"""Token counts of a sentencepiece BPE model by rank-synchronous array merging.

Texts fall into pre-tokens that no vocabulary piece spans. The pre-tokens of a
batch stand side by side in one ragged numpy array of symbols; in each round
every pre-token merges its lowest-rank pair, all at the same time, until none has
a pair. What survives is counted.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.llm.common import map_rows, utf8

SPACE = "▁"
_NONE = np.int64(1 << 30)  # above all ranks
_CACHED_WORDS = 300_000  # of memory only: later words are merged anew each time
_WORDS_AT_ONCE = 10_000  # of speed only: what fits a core's cache
_CHARACTERS_AT_ONCE = 2_000_000  # of memory only
_WORDS = re.compile(f"{SPACE}+[^{SPACE}]*")


class PieceMerger:
    """Counts tokens as the sentencepiece BPE model at ``path`` gives them."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        plain = [
            i for i in range(size)
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        pieces = {model.id_to_piece(i): model.get_score(i) for i in plain}
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("a piece holds a space after other characters: texts can't be cut at spaces")
        if any(model.is_unused(i) for i in range(size)) or model.encode(SPACE + "a  b") != model.encode("  a  b".replace("  a", " a")):
            raise ValueError("a model with unused pieces or removed spaces isn't supported")
        scores = sorted(set(pieces.values()), reverse=True)
        place = {s: r for r, s in enumerate(scores)}
        held = Counter(pieces.values())
        symbols = list(pieces) + sorted({c for p in pieces for c in p} - set(pieces))
        self.number = {s: i for i, s in enumerate(symbols)}
        # After the symbols: characters of no piece, by their bytes.
        unknown = len(symbols)
        self.by_character = np.full(0x110000, unknown + 3, np.int64)
        for i, end in enumerate((0x10000, 0x800, 0x80)):
            self.by_character[:end] = unknown + 2 - i
        for s, i in self.number.items():
            if len(s) == 1:
                self.by_character[ord(s)] = i
        self.cost = np.array(
            [1 if s in pieces else len(s.encode()) for s in symbols] + [1, 2, 3, 4], np.int64
        )
        self.width = len(self.cost)
        pairs = {}
        for piece, score in pieces.items():
            for cut in range(1, len(piece)):
                left, right = self.number.get(piece[:cut]), self.number.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left * self.width + right] = (place[score], self.number[piece])
        self.keys = np.array(sorted(pairs) or [-1], np.int64)
        self.ranks = np.array([pairs[k][0] for k in sorted(pairs)] or [0], np.int64)
        self.merged = np.array([pairs[k][1] for k in sorted(pairs)] or [0], np.int64)
        # All occurrences of a pair may merge at once if nothing that the merged
        # piece takes part in has a rank as low: then the order makes no difference.
        own = np.full(self.width, -1, np.int64)
        own[self.merged] = self.ranks
        least = np.full(self.width, _NONE, np.int64)
        for side in (self.keys // self.width, self.keys % self.width):
            np.minimum.at(least, side, self.ranks)
        self.together = least > own
        for piece, score in pieces.items():
            if held[score] > 1:  # ties go by place, from the left
                self.together[self.number[piece]] = False

    def _rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), self.keys.size - 1)
        found = self.keys[at] == key
        return np.where(found, self.ranks[at], _NONE), self.merged[at]

    def count(self, words: list[str]) -> np.ndarray:
        """Tokens of each pre-token."""
        parts = [self._count(words[at : at + _WORDS_AT_ONCE]) for at in range(0, len(words), _WORDS_AT_ONCE)]
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)

    def _count(self, words: list[str]) -> np.ndarray:
        sizes = np.array([len(w) for w in words], np.int64)
        totals = np.zeros(sizes.size, np.int64)
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        symbols = self.by_character[points]
        owner = np.repeat(np.arange(sizes.size), sizes)
        rank = np.full(symbols.size, _NONE, np.int64)
        merged = np.zeros(symbols.size, np.int64)
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        rank[inside], merged[inside] = self._rank(symbols[inside], symbols[inside + 1])
        while symbols.size:
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            lengths = np.diff(np.append(starts, symbols.size))
            place = np.arange(symbols.size)
            best = np.minimum.reduceat(rank * (1 << 32) + place, starts)
            live = best < _NONE * (1 << 32)
            over = np.repeat(~live, lengths)
            if over.any():
                totals += np.bincount(owner[over], self.cost[symbols[over]], sizes.size).astype(np.int64)
                symbols, owner, rank, merged = symbols[~over], owner[~over], rank[~over], merged[~over]
                continue
            leftmost = best & 0xFFFFFFFF
            lowest = np.repeat(best >> 32, lengths)
            at_once = np.repeat(self.together[merged[leftmost]], lengths)
            chosen = np.flatnonzero((rank == lowest) & at_once)
            if chosen.size > 1:  # of occurrences that overlap, every other one from the left
                run = np.cumsum(np.diff(chosen, prepend=-2) != 1)
                first = np.flatnonzero(np.diff(run, prepend=0))
                chosen = chosen[(np.arange(chosen.size) - first[run - 1]) % 2 == 0]
            mark = np.zeros(symbols.size, bool)
            mark[chosen] = True
            mark[leftmost] = True
            chosen = np.flatnonzero(mark)
            symbols[chosen] = merged[chosen]
            keep = np.ones(symbols.size, bool)
            keep[chosen + 1] = False
            changed = mark
            before = chosen[chosen > 0] - 1
            changed[np.where(keep[before], before, np.maximum(before - 1, 0))] = True
            symbols, owner, rank, merged, changed = (x[keep] for x in (symbols, owner, rank, merged, changed))
            again = np.flatnonzero(changed)
            rank[again] = _NONE
            again = again[again + 1 < symbols.size]
            again = again[owner[again] == owner[again + 1]]
            rank[again], merged[again] = self._rank(symbols[again], symbols[again + 1])
        return totals


def pre_tokens(text: str) -> list[str]:
    """The parts of a text between which nothing merges, each with its leading spaces."""
    parts = text.split(" ")
    if "" not in parts and SPACE not in text:
        return [SPACE + p for p in parts]
    return _WORDS.findall(SPACE + text.replace(" ", SPACE)) if text else []


def _count_batches(make: Callable[[], PieceMerger]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger, known = make(), {}
        for batch in batches:
            counts, waiting, size = [], [], 0

            def settle() -> None:
                fresh = list({w for words in waiting for w in words if w not in known})
                found = dict(zip(fresh, merger.count(fresh).tolist()))
                if len(known) + len(found) <= _CACHED_WORDS:
                    known.update(found)
                for words in waiting:
                    counts.append(sum(known[w] if w in known else found[w] for w in words))
                waiting.clear()

            for text in batch.column(1):
                text = text.as_py() or ""
                waiting.append(pre_tokens(text))
                size += len(text)
                if size >= _CHARACTERS_AT_ONCE:
                    settle()
                    size = 0
            settle()
            lengths = [len(utf8(t.as_py())) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lengths, pa.int64()), pa.array(counts, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    return run


def token_counts(documents: DataFrame, path: str, limit: int) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row's whole text.

    ``path`` is a sentencepiece BPE model. Null text counts as empty: no bytes, no
    tokens. One row per row, repeated rows and null ids too; an empty table gives no
    rows; further columns are not read. Special strings in a text are plain text.
    """
    counted = map_rows(
        documents, ["doc_id", "text"], "doc_id long, n_bytes long, n_tokens long", _count_batches(lambda: PieceMerger(path))
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
