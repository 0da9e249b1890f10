"""Incremental load: what of a batch is new, what was known, what is logged.

Everything here is a DataFrame in and a DataFrame out; writing is separate.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.operators.keys import first_per_key


@dataclass(frozen=True)
class LoadReport:
    """Outcome of one load; ``status`` is 0 for success and 1 for failure."""

    target: str
    n_input: int = 0
    n_duplicates: int = 0
    n_inserted: int = 0
    n_errors: int = 0
    status: int = 0


def known_keys(work: DataFrame, target: DataFrame, key: str, target_key: str | None = None) -> DataFrame:
    """The batch's keys that the target already holds, each once.

    The target is reduced to the batch's keys first: a batch is small beside a
    target that has grown for years, and this side is then filtered where it is
    read instead of being shuffled whole.
    """
    batch = work.select(F.col(key).alias("_key")).filter(F.col("_key").isNotNull()).distinct()
    return (
        target.select(F.col(target_key or key).alias("_key"))
        .join(batch, "_key", "left_semi")
        .distinct()
        .withColumnRenamed("_key", key)
    )


def few_keys(work: DataFrame, key: str, most: int) -> list[str] | None:
    """The batch's keys, each once, where these are at most ``most``; else None."""
    keys = work.select(key).filter(F.col(key).isNotNull()).distinct().limit(most + 1).collect()
    return [k[0] for k in keys] if len(keys) <= most else None


def looked_up_keys(keys: list[str], target: DataFrame, key: str, target_key: str | None = None) -> DataFrame:
    """``known_keys`` for a short list of keys: a condition that reaches the target's files.

    Files sorted by key, as a load writes them, are then read at the pages that may hold one of the keys.
    """
    column = target_key or key
    return target.filter(F.col(column).isin(keys)).select(F.col(column).alias(key)).distinct()


def load_new(
    work: DataFrame,
    target: DataFrame,
    key: str,
    target_key: str | None = None,
    dedupe: str = "none",
    known: DataFrame | None = None,
) -> DataFrame:
    """Rows of the batch whose key the target does not hold yet.

    ``dedupe``: ``none`` keeps repeated rows, ``rows`` removes exact copies,
    ``key`` keeps the first row of each key. A row without a key counts as new.
    ``known`` holds the result of ``known_keys``, which pays where the batch is
    staged; without it the target's keys are compared as they are, so that a batch
    still to be computed is computed once.

    Duplicates go first: each task drops its own before anything is shuffled on
    the key, so copies of a hot row never meet in one place. The anti join is
    then the last step, where adaptive execution may split a hot key.
    """
    if known is None:
        known = target.select(F.col(target_key or key).alias(key))
    if dedupe == "rows":
        batch = work.dropDuplicates()
    elif dedupe == "key":
        batch = first_per_key(work, key)
    elif dedupe == "none":
        batch = work
    else:
        raise ValueError(f"unknown dedupe mode: {dedupe}")
    return batch.join(known, key, "left_anti").select(*work.columns)


def counted_new(work: DataFrame, known: DataFrame, key: str, dedupe: str, copies: str) -> DataFrame:
    """``load_new`` with the number of batch rows that each row stands for, in a column ``copies``.

    Their sum is the batch less the rows of known keys, so the pass that writes
    the new rows tells that number too.
    """
    if dedupe == "rows":
        batch = work.groupBy(*work.columns).agg(F.count(F.lit(1)).alias(copies))
    elif dedupe == "key":
        batch = first_per_key(work, key, copies)
    elif dedupe == "none":
        batch = work.withColumn(copies, F.lit(1).cast("long"))
    else:
        raise ValueError(f"unknown dedupe mode: {dedupe}")
    return batch.join(known, key, "left_anti").select(*work.columns, copies)


def import_log_rows(
    work: DataFrame, log: DataFrame, resource_type: str, document: str = "JsonLogsID",
    export_date: dt.date | None = None,
) -> DataFrame:
    """One row per document that is not logged yet, for any resource type."""
    day = F.current_date() if export_date is None else F.lit(export_date)
    return (
        work.select(F.col(document).alias("JSONLogsId"))
        .filter(F.col("JSONLogsId").isNotNull())
        .distinct()
        .join(log.select("JSONLogsId"), "JSONLogsId", "left_anti")
        .select(
            "JSONLogsId",
            F.lit(resource_type).alias("ResourceType"),
            day.cast("timestamp_ntz").alias("ExportDate"),
        )
    )


def duplicate_count(work: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """One row: batch rows in total, and those whose key was known."""
    flagged = work.select(key).join(known.withColumn("_known", F.lit(1)), key, "left")
    return flagged.agg(
        F.count(F.lit(1)).alias("n_input"), F.count("_known").alias("n_duplicates")
    )


def report_counts(
    work: DataFrame, known: DataFrame, fresh: DataFrame, errors: DataFrame, key: str
) -> DataFrame:
    """One row with all numbers of a load; each input is counted in its own stage of one job."""
    nothing = F.lit(0).cast("long")
    batch = duplicate_count(work, known, key).select(
        "n_input", "n_duplicates", nothing.alias("n_inserted"), nothing.alias("n_errors")
    )
    inserted = fresh.agg(F.count(F.lit(1)).alias("n_inserted")).select(
        nothing.alias("n_input"), nothing.alias("n_duplicates"), "n_inserted", nothing.alias("n_errors")
    )
    failed = errors.agg(F.count(F.lit(1)).alias("n_errors")).select(
        nothing.alias("n_input"), nothing.alias("n_duplicates"), nothing.alias("n_inserted"), "n_errors"
    )
    parts = batch.unionByName(inserted).unionByName(failed)
    return parts.agg(*[F.sum(c).alias(c) for c in ("n_input", "n_duplicates", "n_inserted", "n_errors")])


def inserted_keys(new_rows: DataFrame, key: str, resource_type: str, run_date: dt.date | None = None) -> DataFrame:
    """Echo of what was inserted: key, resource type and day."""
    day = F.current_date() if run_date is None else F.lit(run_date)
    return new_rows.select(
        F.col(key).alias("ID"), F.lit(resource_type).alias("ResourceType"), day.alias("ExportDate")
    )
