"""Column shorthands shared by the extractors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinloom.functions.scalars import strip_urn, tail_after_pipe

__all__ = ["document_id", "named", "own_id", "stripped", "tail_after_pipe"]

stripped = strip_urn


def own_id() -> Column:
    """The entry's own id: its fullUrl without the prefix."""
    return strip_urn("fullUrl")


def document_id(entries: DataFrame) -> Column:
    """Id of the document an entry came from, NULL where it is not carried."""
    return F.col("doc_id") if "doc_id" in entries.columns else F.lit(None).cast("bigint")


def named(**columns: Column | str) -> list[Column]:
    """Output columns by name, each from a column or a column name."""
    return [
        (F.col(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()
    ]
