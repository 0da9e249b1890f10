"""Stages of the corpus pipeline: each takes (spark, docs, sf_dir) and works on all its predecessor kept.

Extra columns pass through every stage but the last; names that clash with an
operator's own do no harm. Empty tables stay empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinloom.llm import decontaminate, language, packing, pii, simhash
from clinloom.llm.common import fresh_name, written

SURROGATE_KEY = "clinloom"  # a production run replaces it by a secret of its own


def _with_text(docs: DataFrame, text, columns: list[str]) -> DataFrame:
    """``columns`` with the new text, and n_chars where there is one in step with it."""
    changed = docs.withColumn("text", text)
    if "n_chars" in columns:
        changed = changed.withColumn("n_chars", F.char_length("text").cast("long"))
    return changed.select(*[F.col(f"`{c}`") for c in columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language (null text, no letter); ``lang`` becomes the one found.

    Where no row tells a language to learn, ``lang`` stays as it is.
    """
    found = fresh_name(docs, "__found")
    model = language.learn(language.training_rows(docs))
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    told = language.identified(docs, model, docs.columns, found)
    return told.where(F.col(f"{found}.lang") != language.UNKNOWN).withColumn("lang", F.col(f"{found}.lang")).select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first in the table of each group of near copies: fingerprints linked at three or fewer bits."""
    row = fresh_name(docs, "__row")
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()))
    found = simhash.near_duplicates(numbered.select(F.col(row).alias("doc_id"), "text"))
    first = found.where("doc_id = component_id").select(F.col("doc_id").alias(row))
    return numbered.join(first, row, "left_semi").drop(row)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts benchmark passages out of texts; a document of which nothing is left goes."""
    found = fresh_name(docs, "__found")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    marked = decontaminate.contamination(docs, benchmark, docs.columns, found)
    rest = decontaminate.without_spans("text", found)
    left = marked.withColumn("text", rest).where((F.size(f"{found}.spans") == 0) | (F.trim("text") != ""))
    return _with_text(left, F.col("text"), docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in all texts by surrogates."""
    return _with_text(pii.replaced(docs, SURROGATE_KEY), F.col("text"), docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the texts into sequences: a row per piece with its ids and its place."""
    encoder = packing.byte_bpe(
        public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    )
    return packing.pack(docs, encoder)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packed),
]
