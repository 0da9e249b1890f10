"""Surrogate keys and one-row-per-key selection, both safe under skew."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinloom.session import ensure_checkpoint_dir

# monotonically_increasing_id keeps the row's position within its partition in
# the low 33 bits (documented layout).
_POSITION_BITS = 33
# Partitions are sized by rows, so a small batch does not leave many tiny files.
_ROWS_PER_PARTITION = 250_000


def assign_surrogate_key(
    df: DataFrame,
    order: list[str],
    start: int,
    key: str = "Id",
    partitions: int | None = None,
    stable: bool = False,
) -> DataFrame:
    """Number rows ``start, start+1, ...`` in the given order, without gaps.

    Rows are range-partitioned on the order columns plus their position in the
    input, so equal keys, or whole copies of a row, still spread over many
    partitions. The sorted partitions are checkpointed; numbering is then the
    partition's offset plus the position inside it. Only the per-partition
    counts (as many rows as there are partitions) are added up in one place.

    The position must be the same when a lost task runs again, so the input is
    checkpointed first unless the caller says it is ``stable``, as rows read
    straight from files are.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    source = df if stable else df.checkpoint()
    n = partitions or 1 + source.count() // _ROWS_PER_PARTITION
    placed = (
        source.withColumn("_at", F.monotonically_increasing_id())
        .repartitionByRange(n, *order, "_at")
        .sortWithinPartitions(*order, "_at")
        .drop("_at")
        .checkpoint()
    )
    numbered = placed.withColumn("_row", F.monotonically_increasing_id()).withColumn(
        "_part", F.shiftright("_row", _POSITION_BITS)
    )
    counts = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    position = F.col("_row").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    # One row per partition: its size is bounded by n, whatever the data.
    return numbered.join(F.broadcast(offsets), "_part").select(
        (F.lit(start) + F.col("_offset") + position).alias(key), *df.columns
    )


def first_per_key(df: DataFrame, key: str, copies: str | None = None) -> DataFrame:
    """Keep one row per key: the first when ordered by all columns, NULLs first.

    A minimum over the whole row, so each task reduces its own rows before the
    shuffle and a hot key costs one row per task. Rows without a key are kept.
    ``copies`` names a column for the number of rows the key had.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    keyed = df.filter(F.col(key).isNotNull())
    # The key column itself is kept, so Spark still knows the rows lie by key.
    firsts = keyed.groupBy(key).agg(F.min(row).alias("_row"), F.count(F.lit(1)).alias("_rows")).select(
        *[key if c == key else F.col(f"_row.`{c}`").alias(c) for c in df.columns],
        *([F.col("_rows").alias(copies)] if copies else []),
    )
    keyless = df.filter(F.col(key).isNull())
    return firsts.unionByName(keyless.withColumn(copies, F.lit(1).cast("long")) if copies else keyless)


def not_first_per_key(df: DataFrame, key: str) -> DataFrame:
    """The distinct rows ``first_per_key`` leaves out."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    firsts = (
        df.filter(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_key"))
        .agg(F.min(row).alias("_first"))
    )
    return (
        df.dropDuplicates()
        .join(firsts, F.col(key) == F.col("_key"))
        .filter(~row.eqNullSafe(F.col("_first")))
        .select(*df.columns)
    )
