"""Spelling variants against a plain version."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pyarrow as pa
import pytest

from clinloom.llm import queries as _registered  # noqa: F401
from clinloom.llm import spelling
from clinloom.workload.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"


def _words(rows):
    found = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def _variants(words):
    """Rows by deletion neighbourhoods and a letter-by-letter check."""
    near, patterns = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            patterns[(w[:i], w[i + 1 :])].add(w)
            if w[:i] + w[i + 1 :] in words:
                near[w].add(w[:i] + w[i + 1 :])
                near[w[:i] + w[i + 1 :]].add(w)
    for same in patterns.values():
        for w in same:
            near[w] |= same - {w}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items())


def _rows(frame):
    assert frame.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, frame.collect()))


def test_query(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall()
    assert _rows(QUERIES["op11_spelling_variants"](spark, FOLDER)) == _variants(_words(rows))


@pytest.mark.parametrize("limits", [{}, {"SUBTRIE": 3, "_PROBES_AT_ONCE": 5, "_STATES_AT_ONCE": 4, "_WORDS_HELD": 10, "_MATRIX": 7}])
def test_words_close_together(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(spelling, name, value)
    random.seed(11)
    made = {"".join(random.choice("aeé×ÿ") for _ in range(random.randint(4, 8))) for _ in range(500)}
    made |= {"x" * n for n in range(5, 12)} | {"q" * 3000 + c for c in ("", "a", "b", "ab")} | {"Straße", "STRAßE", "Ärger", "ärger"}
    texts = [(i if i % 7 else None, " ".join(random.choices(sorted(made), k=60)) + "-" + random.choice(["x1y", "日本語", ""])) for i in range(120)]
    texts += [(500 + i, " ".join(w for w in sorted(made) if len(w) > 20)) for i in range(5)] + [(9, None), (9, ""), texts[0]]
    frame = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "'own' as word", "1 as n")
    want = _variants(_words(texts))
    assert sum(r[1] is not None for r in want) > 5
    assert _rows(spelling.variants(spelling.words(frame))) == want


def test_chains_of_forms(spark):
    chain = [("aaaaaa"[:i] + "bbbbbb"[i:], 3 * 2**i) for i in range(7)] + [("zzzzz", 9)]
    counted = spark.createDataFrame(chain, "word string, n long")
    assert _rows(spelling.variants(counted)) == _variants(dict(chain))


def test_odd_documents(spark, odd_documents, no_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    assert _rows(spelling.variants(spelling.words(odd_documents))) == _variants(_words(rows))
    assert spelling.variants(spelling.words(no_documents)).collect() == []


@pytest.mark.parametrize("size", [1, 3, 4, 100])
def test_batch_ends_among_the_words_of_a_root(monkeypatch, size):
    monkeypatch.setattr(spelling, "SUBTRIE", 3)
    spelled = ["aaaa" + c for c in "bcdfgh"]
    rows = [(root, state, w, 5) for root in (1, 2) for state in (-1, 0) for w in spelled]
    columns = ["root", "state", "word", "n"]
    batches = [pa.RecordBatch.from_pylist([dict(zip(columns, r)) for r in rows[i : i + size]]) for i in range(0, len(rows), size)]
    found = [tuple(sorted((p["word"], p["other"]))) for b in spelling._searched(iter(batches)) for p in b.to_pylist()]
    assert sorted(found) == sorted(2 * [(v, w) for v in spelled for w in spelled if v < w])
