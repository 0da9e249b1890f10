"""Scalar functions, document operators and checks on edge cases."""

from __future__ import annotations

import datetime as dt

import pytest
from plain import rows_of
from pyspark.sql import functions as F

from clinloom.functions import scalars
from clinloom.functions.sql import register_functions
from clinloom.operators import documents, quality
from clinloom.plans.checks import check_table
from clinloom.sources.tables import TABLES


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize("text, tail", [
    ("abc", "abc"), ("a|b", "b"), ("a|b|c", "c"), ("a|", ""), ("", ""), (None, None),
])
def test_tail(spark, text, tail):
    assert value(spark, scalars.tail_after_pipe(F.lit(text).cast("string"))) == tail


def test_strip_and_digits(spark):
    assert value(spark, scalars.strip_urn(F.lit("urn:uuid:a urn:uuid:b"))) == "a b"
    assert value(spark, scalars.remove_digits(F.lit("A1b22c3"))) == "Abc"
    assert value(spark, scalars.full_name(F.lit("Ann810"), F.lit("Lee1"))) == "Ann Lee"
    assert value(spark, scalars.full_name(F.lit(None).cast("string"), F.lit("Lee1"))) is None


def test_splice(spark):
    assert value(spark, scalars.splice(F.lit("abc"), F.lit(2), 1, "xy")) == "axyc"
    assert value(spark, scalars.splice(F.lit("abc"), F.lit(0), 1, "")) is None


@pytest.mark.parametrize("text, number", [
    ("12", 12), (" -3 ", -3), ("+7", 7), ("12.0", None), ("x1", None), ("", None), ("99999999999", None), (None, None),
])
def test_whole_numbers(spark, text, number):
    assert value(spark, scalars.cast_text(F.lit(text).cast("string"), "int")) == number


def test_age_counts_year_changes(spark):
    born = F.lit(dt.date(2000, 12, 31))
    assert value(spark, scalars.age_years(born, dt.date(2024, 1, 1))) == 24


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/Los_Angeles"])
def test_local_date_in_any_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        text = F.lit("2020-01-01T23:30:00-05:00")
        assert value(spark, scalars.local_date(text)) == dt.date(2020, 1, 1)
        assert value(spark, scalars.local_timestamp(text)) == dt.datetime(2020, 1, 1, 23, 30)
        assert value(spark, scalars.local_date(F.lit("soon"))) is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("text, ok", [
    ('{"a": 1}', True), ("[1]", True), (' \n{"a": 1}', True), ("5", False), ("null", False),
    ('"x"', False), ("{a", False), ("", False), (None, False),
])
def test_json_gate(spark, text, ok):
    assert value(spark, scalars.is_json_document(F.lit(text).cast("string"))) is ok


def test_sql_functions(spark):
    register_functions(spark)
    row = spark.sql(
        "SELECT udf_RemoveNumericCharacters('a1b'), strip_urn('urn:uuid:x'), tail_after_pipe('a|b'),"
        " age_years(DATE'2000-12-31', DATE'2024-01-01'), local_date('2020-01-01T23:30:00-05:00')"
    ).first()
    assert tuple(row) == ("ab", "x", "b", 24, dt.date(2020, 1, 1))


def test_quality_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("long text", 4)], "k string, n int")
    assert rows_of(quality.null_rejects(df, ["k"])) == [(None, 3)]
    assert quality.without_nulls(df, ["k"]).count() == 3
    assert quality.without_nulls(df, []).count() == 4
    assert rows_of(quality.duplicate_keys(df, "k")) == [("a", 2)]
    assert rows_of(quality.overlong(df, {"k": 5}, "n")) == [(4, "k", 9, 5)]


def test_day_and_latest(spark):
    rows = [(1, dt.datetime(2024, 1, 1, 23, 59, 59)), (2, dt.datetime(2024, 1, 2)), (3, dt.datetime(2024, 1, 2))]
    df = spark.createDataFrame(rows, "id int, ts timestamp_ntz")
    assert rows_of(documents.day_slice(df, "ts", dt.date(2024, 1, 1)), "id") == [(1,)]
    assert rows_of(documents.latest_document(df, "ts", "id"), "id") == [(2,)]
    assert documents.day_slice(df, "ts").count() == 0


def test_table_definitions(spark):
    claim = TABLES["fact_claim"]
    assert claim.lengths["claimStatus"] == 20
    assert claim.required == [
        "claimId", "claimPatientId", "claimbillablePeriodStart", "claimbillablePeriodEnd"
    ]
    assert claim.schema["claimStatus"].dataType.simpleString() == "string"
    assert len(TABLES) == 16


def test_table_report(spark):
    rows = [("a", None, "x"), ("a", dt.date(2000, 1, 1), "y"), ("b", dt.date(2000, 1, 1), "z" * 60)]
    df = spark.createDataFrame(rows, "ID string, DOB date, firstname string").selectExpr(
        "*", *[f"CAST('t' AS STRING) AS {f.name}" for f in TABLES["dim_patient"].schema
               if f.name not in ("ID", "DOB", "firstname", "DOD", "created_dt")]
    )
    assert rows_of(check_table(df, "dim_patient")) == [
        ("length", '["b"]', "firstname has 60 of 50"),
        ("not null", '["a"]', "DOB"),
        ("unique", '["a"]', "2 rows"),
    ]
