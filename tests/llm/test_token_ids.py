"""Files of token ids against the tokenizer itself."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from clinloom.llm import queries as _registered  # noqa: F401
from clinloom.llm import repair, token_ids
from clinloom.workload.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")


def _plain(rows):
    """(doc_id, start, n_tokens, crc32) of rows (doc_id, text) of different doc_ids."""
    from tokenizers import Tokenizer

    tokenizer, at, out = Tokenizer.from_file(PATH), 0, []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        out.append((doc, at, ids.size, zlib.crc32(ids.tobytes())))
        at += ids.size
    return out


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op12_token_ids"](spark, FOLDER)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect())) == _plain(rows)


def test_odd_texts_and_small_shards(spark, odd_documents, no_documents, tmp_path, monkeypatch):
    monkeypatch.setattr(token_ids, "SHARD_IDS", 50)
    make = token_ids.encoder(PATH)
    words = ["Foo", "foo's", "<|endoftext|>", "<|ENDOFTEXT|>", "é", "é", " ", "́x", "\x1c", "\n\t", "\x85", "\xa0", "ab.c", "x's", "don't!'re", "İ", "Ǆ", "ª²½", "Ünï", "ﬁ", "ÀÉ’s", "a_b", "<|", "日本", "12a", "ΑΣ", "'s", "…", ""]
    random.seed(12)
    rows = [(i, " ".join(random.choices(words, k=random.randint(0, 30)))) for i in range(120)] + [(None, "no id"), (-5, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    token_ids.write(frame, str(tmp_path / "a"), make)
    got = token_ids.read(spark, str(tmp_path / "a")).collect()
    assert sorted(((r.doc_id, r.start, r.n_tokens, zlib.crc32(bytes(r.ids))) for r in got), key=lambda r: r[1]) == _plain(rows)
    few = {r.doc_id: r for r in token_ids.look_up(spark, str(tmp_path / "a"), [7, -5, 119, 4000]).collect()}
    assert few == {r.doc_id: r for r in got if r.doc_id in (7, -5, 119)}
    # repeated and missing ids, clashing columns, one very long word
    token_ids.write(odd_documents, str(tmp_path / "odd"), make)
    odd = sorted(token_ids.read(spark, str(tmp_path / "odd")).collect(), key=lambda r: r.start)
    assert Counter(r.doc_id for r in odd) == Counter(r.doc_id for r in odd_documents.collect())
    assert Counter((r.doc_id, zlib.crc32(bytes(r.ids))) for r in odd) == Counter(
        (r.doc_id, _plain([(0, r.text)])[0][3]) for r in odd_documents.collect()
    )
    at = 0
    for r in odd:
        assert r.start == at and len(r.ids) == 4 * r.n_tokens
        at += r.n_tokens
    ids = [(r.doc_id is not None, r.doc_id) for r in odd]
    assert ids == sorted(ids, key=lambda x: (x[0], x[1] or 0))
    token_ids.write(no_documents, str(tmp_path / "none"), make)
    assert token_ids.read(spark, str(tmp_path / "none")).collect() == []


def test_many_rows_of_one_id_keep_their_places(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_ids, "SHARD_IDS", 200)
    frame = spark.range(600).selectExpr("if(id % 2 = 0, 3, id) as doc_id", "concat('text number ', id % 100) as text")
    token_ids.write(frame, str(tmp_path / "a"), token_ids.encoder(PATH))
    got = sorted(token_ids.read(spark, str(tmp_path / "a")).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted(r.doc_id for r in frame.collect())
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()


def test_grammars_give_any_stretch():
    random.seed(13)
    for _ in range(400):
        kinds = random.randint(1, 6)
        ids = np.array([random.randrange(kinds) for _ in range(random.randint(0, 200))], np.int64)
        grammar = repair.Grammar(repair.compress(ids, kinds))
        assert grammar.expand().tolist() == ids.tolist()
        a = random.randint(0, ids.size)
        b = random.randint(a, ids.size)
        assert grammar.expand(a, b - a).tolist() == ids[a:b].tolist()
    text = np.tile(np.arange(50), 400)
    data = repair.compress(text, 1000)
    grammar = repair.Grammar(data)
    assert grammar.symbols.size < 1000 and len(data) < text.size
    assert all(grammar.lengths[1000 + r] == grammar.lengths[a] + grammar.lengths[b] for r, (a, b) in enumerate(zip(grammar.left, grammar.right)))


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        token_ids.encoder(public_tokenizers.path("byte_bpe_50k.json"))()


def test_encoder_gives_the_librarys_ids():
    from tokenizers import Tokenizer

    tokenizer, encode = Tokenizer.from_file(PATH), token_ids.encoder(PATH)()[0]
    random.seed(14)
    pool = [chr(c) for c in range(0x260)] + list("abcdeABC'  s.,!t\n<|>") * 20 + ["'s", "’", "日", "́", "K", "ﬁ", "😀", "<|endoftext|>"]
    texts = ["".join(random.choices(pool, k=random.randint(0, 40))) for _ in range(2000)]
    texts += [t for c in map(chr, range(0x300)) for t in (f"a{c}b", f"a{c} b", f"{c}'s")]
    for t in texts:
        assert np.frombuffer(encode(t), "<u2").tolist() == tokenizer.encode(t, add_special_tokens=False).ids + [1], repr(t)
