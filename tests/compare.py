"""Run registered queries against their SQL in DuckDB and compare the rows.

``python tests/compare.py [folder] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


# Spark type -> DuckDB type the comparison SQL must end in.
TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def differences(df, con, sql: str) -> str | None:
    """None when the query and the SQL give the same columns, types and rows."""
    result = con.execute(sql)
    expected_types = {d[0]: str(d[1]) for d in result.description}
    got_types = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    if got_types != expected_types:
        return f"columns: {got_types} != {expected_types}"
    names = sorted(got_types)
    order = [d[0] for d in result.description]
    picks = [order.index(n) for n in names]
    expected = Counter(tuple(r[i] for i in picks) for r in result.fetchall())
    got = Counter(tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect())
    if got != expected:
        extra, missing = got - expected, expected - got
        return (
            f"rows: {sum(got.values())} != {sum(expected.values())}; extra {sum(extra.values())} "
            f"{list(extra)[:2]}; missing {sum(missing.values())} {list(missing)[:2]} of {names}"
        )
    return None if got else "no rows"


def main(folder: str, names: list[str]) -> int:
    import __spark_entry__ as entry

    from clinloom.session import session

    spark = session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            if name in oracles:
                problem = differences(df, con, oracles[name])
                count = "" if problem else "same"
            else:
                problem, count = None, f"no SQL, {df.count()} rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem or count}", flush=True)
    spark.stop()
    return bad


if __name__ == "__main__":
    where = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    sys.exit(1 if main(where, sys.argv[2:]) else 0)
