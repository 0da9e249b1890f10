"""Operators on the document log."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinloom.functions.scalars import is_json_document

# Status of a file after an import.
IMPORTED, FAILED, ALREADY_THERE = 1, 2, 3


def checksum(text: str | Column) -> Column:
    """Fingerprint of a document, for change detection."""
    return F.md5(text)


def changed_documents(now: DataFrame, before: DataFrame, key: str, text: str = "json") -> DataFrame:
    """Documents present in both whose checksum differs: key, old and new checksum."""
    old = before.select(key, checksum(text).alias("old_checksum"))
    new = now.select(key, checksum(text).alias("new_checksum"))
    return new.join(old, key).filter(F.col("old_checksum") != F.col("new_checksum"))


def judged(docs: DataFrame, text: str = "json", flag: str = "valid") -> DataFrame:
    """Documents with a flag that tells JSON objects and arrays; each text is judged once."""
    return docs.withColumn(flag, is_json_document(text))


def day_slice(df: DataFrame, column: str, day: dt.date | None = None) -> DataFrame:
    """Rows of one calendar day, today by default.

    Written as a range on the column itself, so it reaches the file scan.
    """
    day = day or dt.date.today()
    # Written as text: a Python datetime would pass through the session's zone.
    low, high = (F.lit(d.isoformat()).cast("timestamp_ntz") for d in (day, day + dt.timedelta(days=1)))
    return df.filter((F.col(column) >= low) & (F.col(column) < high))


def latest_document(docs: DataFrame, time: str, key: str) -> DataFrame:
    """The document imported last; equal times are settled by the key."""
    return docs.orderBy(F.col(time).desc(), F.col(key).asc()).limit(1)


def any_document(docs: DataFrame, key: str) -> DataFrame:
    """One document, always the same one: that of the smallest key."""
    return docs.orderBy(F.col(key).asc()).limit(1)


def not_imported(incoming: DataFrame, log: DataFrame, path: str = "file_path") -> DataFrame:
    """Files the log does not hold yet, compared by full path."""
    return incoming.join(log.select(path), path, "left_anti").select(*incoming.columns)


def import_status(
    incoming: DataFrame, log: DataFrame, path: str = "file_path", text: str = "json"
) -> DataFrame:
    """Status per incoming file: imported, failed (not JSON) or already there."""
    judged = incoming.select(
        path, F.when(is_json_document(text), IMPORTED).otherwise(FAILED).alias("_fresh")
    )
    known = log.select(path).distinct().withColumn("_known", F.lit(True))
    return judged.join(known, path, "left").select(
        path, F.when(F.col("_known"), ALREADY_THERE).otherwise(F.col("_fresh")).alias("status")
    )
