"""Readers for bundle files and CSV tables."""

from __future__ import annotations

import csv
import datetime as dt
from collections.abc import Iterable, Mapping
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinloom.functions.scalars import is_json_document
from clinloom.operators.documents import FAILED, IMPORTED, checksum
from clinloom.operators.typed import BAD_CONVERSION, error_rows
from clinloom.sources.tables import TABLES

_BYTE_ORDER_MARK = "\ufeff"


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Paths of all files below ``path``; the contents are not read."""
    return spark.read.format("binaryFile").load(path).select(
        F.col("_metadata.file_path").alias("file_path")
    )


def read_files(spark: SparkSession, path: str, only: Iterable[str] | None = None) -> DataFrame:
    """One row per file: whole text, path and name; of the files named in ``only`` where that is given.

    The names are a condition on the files' metadata, so Spark drops the others when it lists
    them and never opens them.
    """
    files = describe_files(spark.read.text(path, wholetext=True))
    return files if only is None else files.where(F.col("file_path").isin(*only))


def stream_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same as a stream of the files that arrive in ``path``."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return describe_files(reader.text(path, wholetext=True))


def describe_files(texts: DataFrame) -> DataFrame:
    return texts.select(
        F.ltrim("value", F.lit(_BYTE_ORDER_MARK)).alias("json"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
    )


def as_documents(
    files: DataFrame, run_ts: dt.datetime, first_id: int, batch: str | None = None
) -> DataFrame:
    """Rows of the document log, valid and rejected ones told apart by status.

    Ids are unique and ascending with gaps: they come from the row's place in
    the scan, so giving them moves no document between machines.
    """
    # Written as text: a Python datetime would pass through the session's zone.
    stamp = F.lit(run_ts.isoformat()).cast("timestamp_ntz")
    return files.select(
        (F.lit(first_id) + F.monotonically_increasing_id()).alias("doc_id"),
        "json",
        "file_path",
        "file_name",
        stamp.alias("import_ts"),
        checksum("json").alias("checksum"),
        F.lit(batch).cast("string").alias("batch"),
        F.when(is_json_document("json"), IMPORTED).otherwise(FAILED).alias("status"),
        F.to_date(stamp).alias("import_date"),
    )


def csv_headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The headers below ``path``, each with the files that open with it."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), "value",
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("place"),
    )
    first = lines.filter(F.trim("value") != "").groupBy("file").agg(F.min_by("value", "place").alias("line"))
    found: dict[tuple[str, ...], list[str]] = {}
    for row in first.orderBy("file").toLocalIterator():
        names = next(csv.reader([row["line"].lstrip(_BYTE_ORDER_MARK).rstrip("\r")]))
        found.setdefault(tuple(names), []).append(unquote(row["file"]))
    return found


def read_csv(
    spark: SparkSession, path: str, table: str, rename: Mapping[str, str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """CSV files with headers as rows of a table, and its error rows.

    Every file's columns are matched by its own header (``rename`` maps header to
    table column), read as text and cast; fields may hold quoted line breaks. A
    record with the wrong number of fields or a value that does not convert gives
    an error row. A malformed record is not loaded, an unreadable value loads as NULL.
    """
    rename = {k.lower(): v for k, v in (rename or {}).items()}
    broken = "_broken_line"
    reader = (
        spark.read.option("header", True).option("multiLine", True).option("escape", '"')
        .option("columnNameOfCorruptRecord", broken)
    )
    texts = []
    for header, files in csv_headers(spark, path).items():
        fields = T.StructType([T.StructField(c, T.StringType()) for c in [*header, broken]])
        records = reader.schema(fields).csv(files)
        texts.append(csv_columns(records, header, table, rename, broken))
    if not texts:
        texts = [spark.createDataFrame([], T.StructType([T.StructField(broken, T.StringType())]))]
    text = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), texts)
    return csv_rows(text, table, broken)


def csv_columns(
    records: DataFrame, header: Iterable[str], table: str, rename: Mapping[str, str], broken: str
) -> DataFrame:
    """The fields of a table among the records' columns, still text, and the broken record."""
    by_name = {rename.get(c.lower(), c).lower(): c for c in header}
    wanted = [f.name for f in TABLES[table].schema if f.name.lower() in by_name]
    # Spark refuses to read the broken record alone, so a field always comes with it.
    nothing = F.left(F.coalesce(F.col(f"`{records.columns[0]}`"), F.lit("")), F.lit(0))
    return records.select(
        *[F.col(f"`{by_name[n.lower()]}`").alias(n) for n in wanted], F.concat(broken, nothing).alias(broken)
    )


def csv_rows(text: DataFrame, table: str, broken: str) -> tuple[DataFrame, DataFrame]:
    """Typed rows of a table from text columns, and error rows for what can't be read."""
    target = [f for f in TABLES[table].schema if f.name in text.columns]
    rows = text.filter(F.col(broken).isNull()).select(
        *[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in target]
    )
    unread = F.array_compact(F.array(*[
        F.when(
            F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull(),
            F.concat(F.lit(f"{f.name} does not convert: "), F.col(f"`{f.name}`")),
        )
        for f in target
    ]))
    malformed = F.array(F.concat(F.lit("malformed line: "), F.col(broken)))
    messages = text.select(F.explode(F.when(F.col(broken).isNotNull(), malformed).otherwise(unread)).alias("m"))
    return rows, error_rows(messages, f"FAILED WHILE READING CSV {table}", BAD_CONVERSION, F.col("m"))
