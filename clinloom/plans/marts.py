"""Claim and cohort marts: DataFrames in, DataFrame out.

Joins carry no broadcast hints: adaptive execution broadcasts a side by its
measured size and splits skewed partitions. What is written by hand is the
order (the cohort filter first, then all joins on the encounter key, so each
fact is shuffled once) and, where only a sum leaves the query, aggregation
before the join.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinloom.functions.scalars import MONEY, age_years, full_name, remove_digits, strip_urn

# Fixed value: the text that selects the cohort.
DIABETES = "%diabet%"

_TOTAL = "claimTotal"


def _money_average(total: str, n: str) -> Column:
    """Average that keeps the four digits of the money type."""
    return (F.col(total).cast("decimal(28,4)") / F.col(n).cast("decimal(14,0)")).cast(MONEY)


# Texts are compared ignoring case, ids exactly.
_COLLATION = "UTF8_LCASE"


def same_text(left: str, right: str) -> Column:
    return F.collate(left, _COLLATION) == F.collate(right, _COLLATION)


def _by_text(rows: DataFrame, texts: list[str], others: list[str], first: dict[str, Column], merge: dict) -> DataFrame:
    """Aggregates by ``texts``, ignoring their case, and ``others``; a group has its least spelling.

    ``first`` holds the aggregates of the rows of one spelling and ``merge`` the function that
    makes one of those of several: the rows meet in hash tables on exact texts, and only
    the few sums are sorted by the collation.
    """
    spelled = rows.groupBy(*others, *texts).agg(*[c.alias(n) for n, c in first.items()])
    keys = [F.collate(t, _COLLATION).alias(f"_{t}") for t in texts]
    return spelled.groupBy(*others, *keys).agg(
        *[F.min(t).alias(t) for t in texts], *[merge[n](n).alias(n) for n in first]
    )


# --- claims -----------------------------------------------------------------
# A claim's total stands on each of its rows; the sums count it once per row.


def claims_overview(claims: DataFrame) -> DataFrame:
    return _by_text(
        claims, ["claimStatus", "claimUse"], [],
        {
            "claimCount": F.count(F.lit(1)),
            "totalClaimAmount": F.sum(_TOTAL),
            "_n": F.count(_TOTAL),
            "earliestClaimDate": F.min("claimbillablePeriodStart"),
            "latestClaimDate": F.max("claimbillablePeriodEnd"),
        },
        {
            "claimCount": F.sum, "totalClaimAmount": F.sum, "_n": F.sum,
            "earliestClaimDate": F.min, "latestClaimDate": F.max,
        },
    ).select(
        "claimStatus", "claimUse", "claimCount", "totalClaimAmount",
        _money_average("totalClaimAmount", "_n").alias("averageClaimAmount"),
        "earliestClaimDate", "latestClaimDate",
    )


def _year_month() -> list[Column]:
    start = "claimbillablePeriodStart"
    return [F.year(start).alias("claimYear"), F.month(start).alias("claimMonth")]


def claims_utilization_summary(claims: DataFrame) -> DataFrame:
    """Per year and month; unordered, the caller sorts."""
    return claims.groupBy(*_year_month()).agg(
        F.count(F.lit(1)).alias("totalClaims"), F.sum(_TOTAL).alias("totalClaimAmount")
    )


def claims_by_type(claims: DataFrame) -> DataFrame:
    return _by_text(
        claims.withColumnRenamed("claimCode", "ClaimType"), ["ClaimType"], ["claimId"],
        {"procedureCount": F.count(F.lit(1)), "totalClaimAmount": F.sum(_TOTAL)},
        {"procedureCount": F.sum, "totalClaimAmount": F.sum},
    ).select("claimId", "ClaimType", "procedureCount", "totalClaimAmount")


def claims_by_provider_diagnosis(claims: DataFrame) -> DataFrame:
    """``diagnosisCode`` is the claim's type code under the name the view gives it."""
    return _by_text(
        claims.withColumnRenamed("claimCode", "diagnosisCode"), ["diagnosisCode"], ["claimProviderReference"],
        {"claimCount": F.count(F.lit(1)), "totalClaimAmount": F.sum(_TOTAL)},
        {"claimCount": F.sum, "totalClaimAmount": F.sum},
    ).select("claimProviderReference", "diagnosisCode", "claimCount", "totalClaimAmount")


def _claim_encounters(claims: DataFrame, encounters: DataFrame) -> DataFrame:
    return claims.join(encounters, claims["encounterId"] == encounters["encounter_ID"])


def claims_cost_by_hospital(
    claims: DataFrame, encounters: DataFrame, organizations: DataFrame
) -> DataFrame:
    hospitals = organizations.select(F.col("ID").alias("hospitalId"), F.col("name").alias("HospitalName"))
    billed = _claim_encounters(
        claims.select("claimId", "encounterId", _TOTAL, *_year_month()),
        encounters.select("encounter_ID", "organizationID"),
    ).join(hospitals, F.col("organizationID") == F.col("hospitalId"))
    return _by_text(
        billed, ["HospitalName"], ["claimYear", "claimMonth"],
        {"TotalClaims": F.count("claimId"), "TotalClaimCost": F.sum(_TOTAL), "_n": F.count(_TOTAL)},
        {"TotalClaims": F.sum, "TotalClaimCost": F.sum, "_n": F.sum},
    ).select(
        "claimYear", "claimMonth", "HospitalName", "TotalClaims", "TotalClaimCost",
        _money_average("TotalClaimCost", "_n").alias("AverageClaimCost"),
    )


def claims_with_encounters(claims: DataFrame, encounters: DataFrame) -> DataFrame:
    return _claim_encounters(
        claims, encounters.select("encounter_ID", "start", "encounter_class")
    ).select(
        "claimId",
        "claimStatus",
        _TOTAL,
        "claimbillablePeriodStart",
        "claimbillablePeriodEnd",
        F.col("encounter_ID").alias("encounter_Id"),
        F.col("start").alias("encounterDate"),
        "encounter_class",
    )


# --- cohort ------------------------------------------------------------------


_COPIES = "_copies"


def _counted_cohort(encounter_conditions: DataFrame, conditions: DataFrame, pattern: str) -> DataFrame:
    """Encounter conditions with the matching condition rows, equal ones as one row with their number.

    A condition code is not unique among the conditions: each match counts. Joins then move each row once; ``_repeated`` gives the copies in the last step.
    """
    counted = (
        conditions.filter(F.col("description").ilike(pattern))
        .groupBy("code", "description").agg(F.count(F.lit(1)).alias(_COPIES))
    )
    return encounter_conditions.select("encounter_ID", "condition_code").join(
        counted, same_text("condition_code", "code")
    )


def _repeated(rows: DataFrame) -> DataFrame:
    columns = [c for c in rows.columns if c != _COPIES]
    return rows.select(*columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col(_COPIES)))).select(*columns)


def cohort_claims_overview(
    claims: DataFrame,
    encounters: DataFrame,
    patients: DataFrame,
    organizations: DataFrame,
    encounter_conditions: DataFrame,
    medications: DataFrame,
    conditions: DataFrame,
    pattern: str = DIABETES,
) -> DataFrame:
    cohort = _counted_cohort(encounter_conditions, conditions, pattern)
    prescribed = medications.select(
        strip_urn("encounterID").alias("encounter_ID"), "medicationCode", "medicationName"
    )
    billed = claims.select(
        F.col("encounterId").alias("encounter_ID"),
        "claimId", "claimStatus", "claimCreated", _TOTAL, "claimPatientId",
    )
    hospitals = organizations.select(
        F.col("ID").alias("organizationID"), F.col("name").alias("hospitalName")
    )
    people = patients.select(
        F.col("ID").alias("claimPatientId"), full_name("firstname", "lastname").alias("patientName")
    )
    # Names join what they belong to while it is narrow; the wide fan-out (claims x
    # medications of an encounter) comes last, and copies after it.
    visits = encounters.select("encounter_ID", "organizationID").join(hospitals, "organizationID")
    return _repeated(
        cohort.join(visits, "encounter_ID")
        .join(billed.join(people, "claimPatientId"), "encounter_ID")
        .join(prescribed, "encounter_ID")
        .select(
            "claimId", "claimStatus", "claimCreated", _TOTAL, "patientName", "hospitalName",
            "medicationCode",
            F.col("medicationName").alias("MedicationName"),
            F.col("condition_code").alias("diagnosisCode"),
            F.col("description").alias("diagnosisDescription"),
            _COPIES,
        )
    )


def cohort_demographics(
    patients: DataFrame,
    encounters: DataFrame,
    encounter_conditions: DataFrame,
    conditions: DataFrame,
    pattern: str = DIABETES,
    as_of: dt.date | None = None,
) -> DataFrame:
    people = patients.select(
        F.col("ID").alias("patient_Id"),
        remove_digits("firstname").alias("firstName"),
        remove_digits("lastname").alias("lastName"),
        "gender",
        F.col("DOB").alias("dob"),
        age_years("DOB", as_of).alias("age"),
        "race",
        "ethnicity",
    )
    return _repeated(
        _counted_cohort(encounter_conditions, conditions, pattern)
        .join(encounters.select("encounter_ID", F.col("patientID").alias("patient_Id")), "encounter_ID")
        .join(people, "patient_Id")
        .select(*people.columns, "code", "description", _COPIES)
    )


def cohort_visits(
    patients: DataFrame,
    encounters: DataFrame,
    organizations: DataFrame,
    encounter_conditions: DataFrame,
    conditions: DataFrame,
    pattern: str = DIABETES,
) -> DataFrame:
    """The cohort's encounters, once per matching condition row."""
    people = patients.select(
        F.col("ID").alias("patientId"), full_name("firstname", "lastname").alias("patientName")
    )
    visits = encounters.select(
        "encounter_ID",
        F.col("patientID").alias("patientId"),
        "organizationID",
        F.col("start").alias("encounterDate"),
        F.col("encounter_class").alias("encounterType"),
    )
    providers = organizations.select(
        F.col("ID").alias("organizationID"), F.col("name").alias("providerName")
    )
    return _repeated(
        _counted_cohort(encounter_conditions, conditions, pattern)
        .join(visits, "encounter_ID")
        .join(providers, "organizationID")
        .join(people, "patientId")
        .select("patientId", "patientName", "encounter_ID", "encounterDate", "encounterType", "providerName", _COPIES)
    )


def cohort_hospitalization_summary(
    patients: DataFrame,
    encounters: DataFrame,
    organizations: DataFrame,
    claims: DataFrame,
    encounter_conditions: DataFrame,
    conditions: DataFrame,
    pattern: str = DIABETES,
) -> DataFrame:
    """Cost per patient, hospital, date and class; names are grouped uncleaned.

    Every claim row meets every matching condition row of its encounter. Only
    the sum is wanted, so nothing is multiplied out: matching conditions are
    counted per code, then per encounter, costs are summed per encounter, and
    the products of the two are summed.
    """
    per_code = (
        conditions.filter(F.col("description").ilike(pattern))
        .groupBy("code")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    matches = (
        encounter_conditions.select("encounter_ID", "condition_code")
        .join(per_code, same_text("condition_code", "code"))
        .groupBy("encounter_ID")
        .agg(F.sum("n").alias("n_matches"))
    )
    costs = (
        claims.groupBy(F.col("encounterId").alias("encounter_ID"))
        .agg(F.sum(_TOTAL).alias("cost"))
    )
    visits = encounters.select(
        "encounter_ID", F.col("patientID").alias("patientId"), "organizationID",
        F.col("start").alias("encounterDate"), F.col("encounter_class").alias("encounterType"),
    )
    people = patients.select(F.col("ID").alias("patientId"), "firstname", "lastname")
    hospitals = organizations.select(
        F.col("ID").alias("organizationID"), F.col("name").alias("hospitalName")
    )
    return (
        matches.join(costs, "encounter_ID")
        .join(visits, "encounter_ID")
        .join(hospitals, "organizationID")
        .join(people, "patientId")
        .groupBy("patientId", "firstname", "lastname", "hospitalName", "encounterDate", "encounterType")
        .agg(F.sum(F.col("cost") * F.col("n_matches").cast("decimal(12,0)")).alias("hospitalizationCost"))
        .select(
            "patientId", full_name("firstname", "lastname").alias("patientName"), "hospitalName",
            "encounterDate", "encounterType", "hospitalizationCost",
        )
    )


def cohort_medications(
    patients: DataFrame,
    encounters: DataFrame,
    medications: DataFrame,
    pattern: str = DIABETES,
) -> DataFrame:
    """Selected by the condition text of the medication request itself."""
    prescribed = medications.filter(
        F.col("conditionThatCausedMedicationRequest").ilike(pattern)
    ).select(
        strip_urn("encounterID").alias("encounter_ID"), "medicationCode", "medicationName",
        F.col("dosageQuantity").alias("dosage"), "frequency",
    )
    people = patients.select(
        F.col("ID").alias("patientId"), full_name("firstname", "lastname").alias("patientName")
    )
    visits = encounters.select(
        "encounter_ID", F.col("patientID").alias("patientId"), F.col("start").alias("encounterDate")
    )
    return (
        prescribed.join(visits, "encounter_ID")
        .join(people, "patientId")
        .select("patientId", "patientName", "medicationCode", "medicationName", "dosage", "frequency", "encounterDate")
    )
