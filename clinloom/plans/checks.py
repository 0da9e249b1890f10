"""All declared constraints of a table as one report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.operators.quality import duplicate_keys, null_rejects, overlong
from clinloom.sources.tables import TABLES


def check_table(df: DataFrame, name: str) -> DataFrame:
    """Rows ``(rule, key, detail)``, one for each broken rule; empty when all hold."""
    table = TABLES[name]
    # Rows are named by their natural key, or by the first column.
    names = list(table.unique or table.schema.names[:1])
    key = F.to_json(F.array(*[F.col(f"`{c}`").cast("string") for c in names]))
    keyed = df.withColumn("_row", key)

    reports = []
    if table.required:
        missing = F.concat_ws(", ", *[F.when(F.col(f"`{c}`").isNull(), c) for c in table.required])
        reports.append(
            null_rejects(keyed, table.required).select(
                F.lit("not null").alias("rule"), F.col("_row").alias("key"), missing.alias("detail")
            )
        )
    if table.unique:
        reports.append(
            duplicate_keys(keyed, "_row").select(
                F.lit("unique").alias("rule"), F.col("_row").alias("key"),
                F.concat("n_rows", F.lit(" rows")).alias("detail"),
            )
        )
    if table.lengths:
        reports.append(
            overlong(keyed, table.lengths, "_row").select(
                F.lit("length").alias("rule"), "key",
                F.concat("column", F.lit(" has "), "length", F.lit(" of "), "limit").alias("detail"),
            )
        )
    if not reports:
        return df.sparkSession.createDataFrame([], "rule string, key string, detail string")
    return reduce(DataFrame.unionByName, reports)
