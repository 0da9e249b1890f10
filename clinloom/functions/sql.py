"""Temporary SQL functions for callers who write SQL.

They are SQL-bodied, so Catalyst inlines them: no Python worker is involved.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# The SQL names callers use.
_FUNCTIONS = {
    "udf_RemoveNumericCharacters(x STRING) RETURNS STRING": "regexp_replace(x, '[0-9]', '')",
    "strip_urn(x STRING) RETURNS STRING": "replace(x, 'urn:uuid:', '')",
    "tail_after_pipe(x STRING) RETURNS STRING": "substring_index(x, '|', -1)",
    "age_years(born DATE, as_of DATE) RETURNS INT": "year(as_of) - year(born)",
    "local_date(x STRING) RETURNS DATE": "try_cast(x AS DATE)",
}


def register_functions(spark: SparkSession) -> None:
    """Make the helpers callable from ``spark.sql`` in this session."""
    for signature, body in _FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
