"""Marts on hand-made rows: fan-out, raw-name grouping, averages."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from plain import rows_of

from clinloom.plans import marts

DAY = dt.datetime(2020, 1, 1)


@pytest.fixture(scope="module")
def star(spark):
    return dict(
        claims=spark.createDataFrame(
            [("c1", "active", "p1", "e1", Decimal("10.0000"), DAY), ("c1", "active", "p1", "e1", Decimal("5.0000"), DAY),
             ("c2", "active", "p2", "e2", None, DAY), ("c3", "active", "p3", "e3", Decimal("1.0000"), DAY)],
            "claimId string, claimStatus string, claimPatientId string, encounterId string, "
            "claimTotal decimal(19,4), claimCreated timestamp_ntz"),
        encounters=spark.createDataFrame(
            [("e1", DAY, "p1", "o1", "AMB"), ("e2", DAY, "p2", "o1", "AMB"), ("e3", DAY, "p3", "o1", "AMB")],
            "encounter_ID string, start timestamp_ntz, patientID string, organizationID string, encounter_class string"),
        patients=spark.createDataFrame(
            [("p1", "Ann1", "Lee1", dt.date(2000, 12, 31)), ("p2", "Ann2", "Lee2", dt.date(2001, 1, 1)),
             ("p3", "Bo", None, dt.date(2001, 1, 1))],
            "ID string, firstname string, lastname string, DOB date").selectExpr(
                "*", "'F' AS gender", "'r' AS race", "'e' AS ethnicity"),
        hospitals=spark.createDataFrame([("o1", "HOSPITAL")], "ID string, name string"),
        diagnosed=spark.createDataFrame(
            [("e1", "44"), ("e1", "45"), ("e2", "44"), ("e3", "99")], "encounter_ID string, condition_code string"),
        conditions=spark.createDataFrame(
            [("44", "Diabetes"), ("44", "type 2 diabetes"), ("45", "prediabetes"), ("99", "Asthma")],
            "code string, description string"),
        medications=spark.createDataFrame(
            [("urn:uuid:e1", "m1", "Metformin", "Diabetes", 1.5, 2), ("e2", "m2", "Other", "Asthma", 1.0, 1)],
            "encounterID string, medicationCode string, medicationName string, "
            "conditionThatCausedMedicationRequest string, dosageQuantity double, frequency int"),
    )


def test_hospitalization_multiplies_costs_by_matches(star):
    got = marts.cohort_hospitalization_summary(
        star["patients"], star["encounters"], star["hospitals"], star["claims"],
        star["diagnosed"], star["conditions"])
    # three matching condition rows, two claim rows: 3 x 15; equal cleaned names stay apart
    assert rows_of(got, "patientId", "patientName", "hospitalizationCost") == [
        ("p1", "Ann Lee", Decimal("45.0000")), ("p2", "Ann Lee", None)]


def test_cohort_rows_repeat_per_match(star):
    visits = marts.cohort_visits(
        star["patients"], star["encounters"], star["hospitals"], star["diagnosed"], star["conditions"])
    assert rows_of(visits, "encounter_ID") == [("e1",)] * 3 + [("e2",)] * 2
    people = marts.cohort_demographics(
        star["patients"], star["encounters"], star["diagnosed"], star["conditions"], as_of=dt.date(2024, 1, 1))
    assert rows_of(people, "patient_Id", "age", "code")[0] == ("p1", 24, "44")


def test_claims_overview_of_cohort(star):
    got = marts.cohort_claims_overview(
        star["claims"], star["encounters"], star["patients"], star["hospitals"],
        star["diagnosed"], star["medications"], star["conditions"])
    assert got.count() == 3 * 2 + 2  # matches x claims x medications
    assert {r.MedicationName for r in got.collect()} == {"Metformin", "Other"}


def test_medications_by_their_own_condition(star):
    got = marts.cohort_medications(star["patients"], star["encounters"], star["medications"])
    assert rows_of(got, "patientId", "medicationCode", "dosage") == [("p1", "m1", 1.5)]
    asthma = marts.cohort_medications(star["patients"], star["encounters"], star["medications"], "%asthma%")
    assert rows_of(asthma, "patientId") == [("p2",)]


def test_averages_keep_four_digits(spark):
    df = spark.createDataFrame(
        [("a", "u", Decimal("1"), DAY, DAY), ("a", "u", Decimal("1"), DAY, DAY), ("a", "u", Decimal("0"), DAY, DAY),
         ("a", "u", None, DAY, DAY)],
        "claimStatus string, claimUse string, claimTotal decimal(19,4), "
        "claimbillablePeriodStart timestamp_ntz, claimbillablePeriodEnd timestamp_ntz")
    row = marts.claims_overview(df).first()
    assert (row.claimCount, row.averageClaimAmount) == (4, Decimal("0.6667"))


def test_texts_group_and_join_ignoring_case(spark):
    """One group of all spellings under the least of them, NULL a group of its own; ids stay exact."""
    claims = spark.createDataFrame(
        [("a", "Active", "X", 1), ("a", "active", "X", 2), ("A", "ACTIVE", "x", 4), ("b", None, "x", None)],
        "claimId string, claimStatus string, claimUse string, claimTotal int",
    ).selectExpr(
        "claimId", "claimStatus", "claimUse", "claimStatus AS claimCode", "CAST(claimTotal AS decimal(19,4)) AS claimTotal",
        "TIMESTAMP_NTZ '2020-01-01 00:00:00' AS claimbillablePeriodStart", "TIMESTAMP_NTZ '2020-01-02 00:00:00' AS claimbillablePeriodEnd",
    )
    got = marts.claims_overview(claims).selectExpr(
        "claimStatus", "claimUse", "claimCount", "CAST(totalClaimAmount AS int)", "string(averageClaimAmount)"
    )
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        [("ACTIVE", "X", 3, 7, "2.3333"), (None, "x", 1, None, None)], key=repr
    )
    kinds = marts.claims_by_type(claims).select("claimId", "ClaimType", "procedureCount")
    assert sorted(map(tuple, kinds.collect()), key=repr) == sorted(
        [("a", "Active", 2), ("A", "ACTIVE", 1), ("b", None, 1)], key=repr
    )
