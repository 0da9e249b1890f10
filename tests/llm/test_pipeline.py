"""The pipeline as a whole and its stages on odd tables."""

from __future__ import annotations

import re

import brute
import corpus_pipeline
import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from clinloom.llm import common, pipeline, simhash

FOLDER = "/root/testdata/sf0.001"


def _text_tables(spark, folder, documents):
    documents.write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{FOLDER}/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_run(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet' ORDER BY doc_id").fetchall()
    bench = duckdb.sql(f"SELECT item_id, text FROM '{FOLDER}/benchmark.parquet'").fetchall()
    pieces = corpus_pipeline.run(spark, FOLDER).collect()
    by_doc = {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
    lettered = [(d, t) for d, t in rows if re.search(r"[^\W\d_]", t or "")]
    first = brute.groups([brute.simhash(t) for _, t in lettered])
    stay = [lettered[i] for i, f in enumerate(first) if i == f]
    # Who stays is settled but for documents that are benchmark passages as a whole.
    hits = {d: brute.contamination(t, bench) for d, t in stay}
    whole = {d for d, (n, hit, _) in hits.items() if n and n == hit}
    assert {d for d, _ in stay} - whole <= set(by_doc) <= {d for d, _ in stay}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for doc, mine in by_doc.items():
        ids = np.frombuffer(b"".join(bytes(p.ids) for p in sorted(mine, key=lambda p: p.start)), "<u4").tolist()
        assert ids[-1] == 0 and len(ids) == mine[0].doc_tokens
        text = tokenizer.decode(ids[:-1], skip_special_tokens=False)
        assert brute.contamination(text, bench)[1] == 0 or doc in whole


def test_run_on_odd_and_empty_tables(spark, odd_documents, no_documents, tmp_path):
    folder = _text_tables(spark, tmp_path / "odd", odd_documents)
    assert corpus_pipeline.run(spark, folder).count() > 0
    folder = _text_tables(spark, tmp_path / "none", no_documents)
    assert corpus_pipeline.run(spark, folder).collect() == []


def test_stage_broadcasts_no_exploded_table(spark, monkeypatch):
    plans = []

    def written(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return common.written(df)

    monkeypatch.setattr(simhash, "written", written)
    pipeline.near_duplicates(spark, spark.read.parquet(f"{FOLDER}/documents.parquet"), FOLDER)
    exploded = [p for p in plans if "Generate" in p and "Join" in p]
    assert exploded and not any("BroadcastHashJoin" in p for p in exploded)


@pytest.mark.parametrize("name", [n for n, _ in pipeline.STAGES[:-1]])
def test_stage_keeps_the_columns(spark, odd_documents, no_documents, name):
    stage = dict(pipeline.STAGES)[name]
    out = stage(spark, odd_documents, FOLDER)
    assert out.columns == odd_documents.columns and 0 < out.count() <= odd_documents.count()
    none = stage(spark, no_documents, FOLDER)
    assert none.columns == odd_documents.columns and none.collect() == []
