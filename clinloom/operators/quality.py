"""Table constraints as checks: each returns the rows that break a rule."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _any(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def null_rejects(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """Rows with a NULL in a required column."""
    return df.filter(_any(F.col(c).isNull() for c in required))


def without_nulls(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """The complement of ``null_rejects``."""
    return df.filter(~_any(F.col(c).isNull() for c in required))


def duplicate_keys(df: DataFrame, *key: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def overlong(df: DataFrame, limits: Mapping[str, int], key: str) -> DataFrame:
    """Texts beyond their declared length: key, column, length, limit."""
    found = F.array_compact(
        F.array(
            *[
                F.when(
                    F.length(c) > n,
                    F.struct(F.lit(c).alias("column"), F.length(c).alias("length"), F.lit(n).alias("limit")),
                )
                for c, n in limits.items()
            ]
        )
    )
    return df.select(F.col(key).alias("key"), F.explode(found).alias("f")).select("key", "f.*")
