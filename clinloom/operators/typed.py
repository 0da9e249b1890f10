"""Typing of text rows, and the error rows of what does not convert."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinloom.functions.scalars import cast_text

# Error numbers the database reports for these failures.
NOT_JSON = 547
BAD_CONVERSION = 245
NULL_NOT_ALLOWED = 515
DUPLICATE_KEY = 2627
JOB_FAILED = 50000


def typed(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """Cast the named text columns; text that does not convert becomes NULL."""
    return df.select(
        *[cast_text(c, casts[c]).alias(c) if c in casts else F.col(c) for c in df.columns]
    )


def error_rows(df: DataFrame, stage: str | Column, number: int, message: Column) -> DataFrame:
    """Rows in the layout of the error log."""
    return df.select(
        (F.lit(stage) if isinstance(stage, str) else stage).alias("FILENAME"),
        F.lit(number).alias("ERRORNUMBER"),
        F.lit(None).cast("int").alias("ERRORLINE"),
        message.alias("ERRORMESSAGE"),
        F.current_timestamp().cast("timestamp_ntz").alias("IMPORTDATETIME"),
    )


def cast_rejects(df: DataFrame, casts: Mapping[str, str], stage: str, key: str) -> DataFrame:
    """One error row per text value that does not convert to its type."""
    failures = F.array_compact(
        F.array(
            *[
                F.when(
                    F.col(c).isNotNull() & cast_text(c, kind).isNull(),
                    F.struct(F.lit(c).alias("column"), F.lit(kind).alias("kind"), F.col(c).alias("text")),
                )
                for c, kind in casts.items()
            ]
        )
    )
    bad = df.select(F.col(key).alias("key"), F.explode(failures).alias("f"))
    message = F.concat(
        F.coalesce("key", F.lit("NULL")), F.lit(": "), "f.column",
        F.lit(" does not convert to "), "f.kind", F.lit(": "), "f.text",
    )
    return error_rows(bad, stage, BAD_CONVERSION, message)
