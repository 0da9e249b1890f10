"""Work shared by the operators: work tables and Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clinloom.session import ensure_checkpoint_dir


def work_folder(spark: SparkSession) -> str:
    """A fresh folder below the checkpoint folder that all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder, so that nothing before it runs again.

    Spark's cleaner knows nothing of these folders; they go with the checkpoint folder.
    """
    folder = work_folder(df.sparkSession)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def remove(df: DataFrame) -> None:
    """Delete the files of a table made by ``written`` that nothing reads any more."""
    jvm = df.sparkSession._jvm
    conf = df.sparkSession._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def map_rows(
    df: DataFrame, columns: list[str], schema: str, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
) -> DataFrame:
    """``function`` over the Arrow batches of the named columns."""
    return df.select(*[F.col(f"`{c}`") for c in columns]).mapInArrow(function, schema)


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def fresh_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` doesn't hold in any case."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name += "_"
    return name


def extend(
    df: DataFrame, read: str, keep: list[str], added: str, function: Callable[[list[str | None]], list[pa.Array]]
) -> DataFrame:
    """The ``keep`` columns of ``df`` with those that ``function`` makes of the texts in ``read``.

    ``added`` is the DDL of the new columns, whose names must be free among ``keep``.
    """
    kept = df.select(*[F.col(f"`{c}`") for c in keep])
    schema = StructType(kept.schema.fields + StructType.fromDDL(added).fields)
    width = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _by_size(batch, width):
                made = function(part.column(width).to_pylist())
                yield pa.RecordBatch.from_arrays(part.columns[:width] + made, schema.names)

    return df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{read}`").alias("__read")).mapInArrow(run, schema)


_BYTES_AT_ONCE = 4 << 20  # of memory only


def _by_size(batch: pa.RecordBatch, column: int, size: int = _BYTES_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts have about ``size`` bytes, one row at least."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    block = np.cumsum(lengths, dtype=np.int64) // size
    cuts = np.flatnonzero(np.diff(block)) + 1
    for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
        yield batch.slice(start, end - start)
