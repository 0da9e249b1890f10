"""File ingest and loads as a stream: Spark's own checkpoint remembers the imported files."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clinloom.operators.documents import not_imported
from clinloom.operators.shred import explode_entries
from clinloom.plans.procedures import LOADS, documents_since, import_documents, load_entries, next_document
from clinloom.sources.files import stream_files
from clinloom.sources.warehouse import Warehouse


def ingest_available(
    wh: Warehouse, path: str, checkpoint: str, run_ts: dt.datetime | None = None,
    max_files: int | None = None, recheck: bool = False,
) -> StreamingQuery:
    """Import what has arrived in ``path`` since the last call, then stop.

    The checkpoint must lie on storage all machines share. ``max_files`` bounds
    one batch, so a large backlog is worked off in steps. Each batch leaves its
    mark in the log: one that was written but not yet checkpointed when the job
    died comes again and is passed over. ``recheck`` compares every file with
    the log by path; it is for a new checkpoint beside an older log.
    """

    def import_batch(files: DataFrame, number: int) -> None:
        mark = f"{checkpoint}#{number}"
        if _done(wh, mark):
            return
        if recheck:
            files = not_imported(files, wh.read("JSONLogs"))
        import_documents(wh, files, run_ts or dt.datetime.now(), mark)

    return _started(wh, path, checkpoint, max_files, import_batch)


def load_available(
    wh: Warehouse, path: str, checkpoint: str, run_ts: dt.datetime | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Import what has arrived in ``path`` since the last call and load every resource of it, then stop.

    A batch is one commit: its documents with its mark, the rows of all tables, the
    import log and the error log become visible together. So a batch that dies
    shows nothing and comes again whole, and one that was published but not yet
    checkpointed is passed over. An error stops the stream and is raised by
    ``awaitTermination``. The day's entries are not kept; ``split_documents`` gives them.
    """

    def load_batch(files: DataFrame, number: int) -> None:
        mark = f"{checkpoint}#{number}"
        if _done(wh, mark):
            return
        now = run_ts or dt.datetime.now()
        try:
            with wh.transaction():
                first_id = next_document(wh)
                import_documents(wh, files, now, mark)
                # Parsed once, by type: each load reads its own.
                entries = explode_entries(documents_since(wh, now, first_id)).filter(F.col("resource").isNotNull())
                entries = wh.stage(entries, "entries", by=("resourceType",))
                for spec in LOADS.values():
                    load_entries(wh, spec, entries)
        finally:
            wh.drop_staged()

    return _started(wh, path, checkpoint, max_files, load_batch)


def _done(wh: Warehouse, mark: str) -> bool:
    return wh.read("JSONLogs").filter(F.col("batch") == mark).limit(1).count() > 0


def _started(wh: Warehouse, path: str, checkpoint: str, max_files: int | None, batch) -> StreamingQuery:
    return (
        stream_files(wh.spark, path, max_files)
        .writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
