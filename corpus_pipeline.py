"""The corpus pipeline: stages over the documents table, each one corpus operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clinloom.llm.common import written
from clinloom.llm.pipeline import STAGES

#: SQL can't express the stages; the tests hold them against plain Python.
ORACLE_SQL = None

__all__ = ["ORACLE_SQL", "STAGES", "run"]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = written(docs)
    return docs
