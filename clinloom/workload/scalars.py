"""Queries on the scalar functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from clinloom.functions import scalars
from clinloom.workload.registry import Tables, query

AS_OF = dt.date(2024, 1, 1)


@query("q_strip_prefix", """
SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) || '-' || CAST(o_custkey AS VARCHAR) AS id FROM orders""")
def strip_prefix(t: Tables):
    """Every occurrence goes, wherever it stands."""
    raw = F.concat(F.lit("urn:uuid:"), "o_orderkey", F.lit("-urn:uuid:"), "o_custkey")
    return t.orders.select("o_orderkey", scalars.strip_urn(raw).alias("id"))


_PIPED = """CASE o_orderstatus WHEN 'O' THEN 'a|b|' || CAST(o_custkey AS VARCHAR)
     WHEN 'F' THEN CAST(o_custkey AS VARCHAR) || '|' WHEN 'P' THEN o_orderpriority END"""


def _piped():
    return (
        F.when(F.col("o_orderstatus") == "O", F.concat(F.lit("a|b|"), "o_custkey"))
        .when(F.col("o_orderstatus") == "F", F.concat("o_custkey", F.lit("|")))
        .otherwise(F.col("o_orderpriority"))
    )


@query("q_tail_after_pipe", f"SELECT o_orderkey, string_split({_PIPED}, '|')[-1] AS tail FROM orders")
def tail_after_pipe(t: Tables):
    return t.orders.select("o_orderkey", scalars.tail_after_pipe(_piped()).alias("tail"))


@query("q_tail_by_position", f"SELECT o_orderkey, string_split({_PIPED}, '|')[-1] AS tail FROM orders")
def tail_by_position(t: Tables):
    """The same from single functions: position in the reversed text, then the right end."""
    df = t.orders.select("o_orderkey", _piped().alias("x")).withColumn(
        "at", F.instr(F.reverse("x"), "|")
    )
    tail = F.when(F.col("at") == 0, F.col("x")).otherwise(F.right("x", F.col("at") - 1))
    return df.select("o_orderkey", tail.alias("tail"))


@query("q_remove_digits", """
SELECT c_custkey, regexp_replace(c_name || c_mktsegment, '[0-9]', '', 'g') AS cleaned FROM customer""")
def remove_digits(t: Tables):
    return t.customer.select(
        "c_custkey", scalars.remove_digits(F.concat("c_name", "c_mktsegment")).alias("cleaned")
    )


@query("q_remove_first_digit", """
SELECT c_custkey, regexp_replace(c_name, '[0-9]', '') AS cleaned,
       CAST(10 AS INTEGER) AS at FROM customer""")
def remove_first_digit(t: Tables):
    """One step of digit removal: find the position, cut one character."""
    at = scalars.first_match("c_name", "[0-9]")
    return t.customer.select(
        "c_custkey", scalars.splice("c_name", at, 1, "").alias("cleaned"), at.alias("at")
    )


@query("q_age_years", f"""
SELECT o_orderkey, CAST(date_diff('year', CAST(o_orderdate AS DATE), DATE '{AS_OF}') AS INTEGER) AS age FROM orders""")
def age_years(t: Tables):
    return t.orders.select("o_orderkey", scalars.age_years(F.col("o_orderdate").cast("date"), AS_OF).alias("age"))


@query("q_concat_null", """
SELECT o_orderkey, o_orderpriority || ',' || l_returnflag AS joined
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey""")
def concat_null(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_returnflag")
    return t.orders.join(lines, F.expr("o_orderkey = l_orderkey"), "left").select(
        "o_orderkey", scalars.plus("o_orderpriority", F.lit(","), "l_returnflag").alias("joined")
    )


@query("q_local_date", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day FROM orders""")
def local_date(t: Tables):
    """The written day, whatever the offset; unreadable text is NULL."""
    day = F.col("o_orderdate").cast("date").cast("string")
    text = (
        F.when(F.col("o_orderstatus") == "O", F.concat(day, F.lit("T23:30:00-05:00")))
        .when(F.col("o_orderstatus") == "F", F.concat(day, F.lit("T00:30:00+09:00")))
        .otherwise(F.concat(F.lit("day "), day))
    )
    return t.orders.select("o_orderkey", scalars.local_date(text).alias("day"))


@query("q_year_month", """
SELECT o_orderkey, CAST(YEAR(o_orderdate) AS INTEGER) AS y, CAST(MONTH(o_orderdate) AS INTEGER) AS m FROM orders""")
def year_month(t: Tables):
    return t.orders.select("o_orderkey", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"))


@query("q_conversions", """
SELECT l_orderkey, l_linenumber, TRY_CAST(CASE WHEN l_returnflag = 'R' THEN 'x' ELSE '' END || CAST(l_linenumber AS VARCHAR) AS INTEGER) AS i,
       l_discount AS f, l_returnflag = 'A' AS b,
       CAST(CAST(l_extendedprice AS DECIMAL(19,4)) AS DOUBLE) AS m
FROM lineitem""")
def conversions(t: Tables):
    """Text to int, float, bit and money."""
    i = F.concat(F.when(F.col("l_returnflag") == "R", "x").otherwise(""), "l_linenumber")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber",
        scalars.cast_text(i, "int").alias("i"),
        scalars.cast_text(F.col("l_discount").cast("string"), "double").alias("f"),
        scalars.cast_text((F.col("l_returnflag") == "A").cast("string"), "boolean").alias("b"),
        scalars.cast_text(F.col("l_extendedprice").cast("string"), "money").cast("double").alias("m"),
    )


@query("q_match_ignoring_case", """
SELECT p_partkey, p_type FROM part WHERE p_type ILIKE '%econ%'""")
def match_ignoring_case(t: Tables):
    return t.part.filter(F.col("p_type").ilike("%econ%")).select("p_partkey", "p_type")
