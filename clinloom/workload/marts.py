"""Mart queries over the star schema."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from clinloom.plans import marts
from clinloom.workload import star
from clinloom.workload.registry import Tables, as_doubles, query

COHORT = "%econ%"
AS_OF = dt.date(2024, 1, 1)


def _sum(column: str) -> str:
    return f"CAST(SUM({column}) AS DOUBLE)"


def _avg(column: str) -> str:
    """Average at four digits, half up, in whole numbers (no floating division)."""
    total = f"SUM(CAST({column} * 10000 AS HUGEINT))"
    n = f"COUNT({column})"
    return f"CAST(CAST((2 * {total} + {n}) // (2 * {n}) AS DOUBLE) / 10000 AS DOUBLE)"


@query("q_claims_overview", star.SQL + f"""
SELECT claimStatus, claimUse, COUNT(*) AS claimCount, {_sum('claimTotal')} AS totalClaimAmount,
       {_avg('claimTotal')} AS averageClaimAmount,
       MIN(claimbillablePeriodStart) AS earliestClaimDate, MAX(claimbillablePeriodEnd) AS latestClaimDate
FROM order_claims GROUP BY claimStatus, claimUse""")
def claims_overview(t: Tables):
    return as_doubles(
        marts.claims_overview(star.claims_of_orders(t)), "totalClaimAmount", "averageClaimAmount"
    )


# Every third order is written in small letters; the group is named by its least spelling.
_SPELLED = """
spelled AS (
  SELECT * REPLACE (CASE WHEN CAST(claimId AS BIGINT) % 3 = 0 THEN lower(claimStatus) ELSE claimStatus END AS claimStatus,
                    CASE WHEN CAST(claimId AS BIGINT) % 5 = 0 THEN lower(claimUse) ELSE claimUse END AS claimUse)
  FROM order_claims)
"""


@query("q_claims_overview_ignoring_case", star.SQL.rstrip() + "," + _SPELLED + f"""
SELECT MIN(claimStatus) AS claimStatus, MIN(claimUse) AS claimUse, COUNT(*) AS claimCount,
       {_sum('claimTotal')} AS totalClaimAmount, {_avg('claimTotal')} AS averageClaimAmount,
       MIN(claimbillablePeriodStart) AS earliestClaimDate, MAX(claimbillablePeriodEnd) AS latestClaimDate
FROM spelled GROUP BY lower(claimStatus), lower(claimUse)""")
def claims_overview_ignoring_case(t: Tables):
    claims = star.claims_of_orders(t).withColumns({
        "claimStatus": F.expr("if(claimId % 3 = 0, lower(claimStatus), claimStatus)"),
        "claimUse": F.expr("if(claimId % 5 = 0, lower(claimUse), claimUse)"),
    })
    return as_doubles(marts.claims_overview(claims), "totalClaimAmount", "averageClaimAmount")


_YEAR_MONTH = """CAST(YEAR(claimbillablePeriodStart) AS INTEGER) AS claimYear,
       CAST(MONTH(claimbillablePeriodStart) AS INTEGER) AS claimMonth"""


@query("q_claims_utilization_summary", star.SQL + f"""
SELECT {_YEAR_MONTH}, COUNT(*) AS totalClaims, {_sum('claimTotal')} AS totalClaimAmount
FROM order_claims GROUP BY ALL""")
def claims_utilization_summary(t: Tables):
    return as_doubles(marts.claims_utilization_summary(star.claims_of_orders(t)), "totalClaimAmount")


@query("q_claims_by_type", star.SQL + f"""
SELECT claimId, claimCode AS ClaimType, COUNT(*) AS procedureCount, {_sum('claimTotal')} AS totalClaimAmount
FROM line_claims GROUP BY ALL""")
def claims_by_type(t: Tables):
    return as_doubles(marts.claims_by_type(star.claims_of_lines(t)), "totalClaimAmount")


@query("q_claims_by_provider_diagnosis", star.SQL + f"""
SELECT claimProviderReference, claimCode AS diagnosisCode, COUNT(*) AS claimCount,
       {_sum('claimTotal')} AS totalClaimAmount
FROM line_claims GROUP BY ALL""")
def claims_by_provider_diagnosis(t: Tables):
    return as_doubles(marts.claims_by_provider_diagnosis(star.claims_of_lines(t)), "totalClaimAmount")


@query("q_claims_cost_by_hospital", star.SQL + f"""
SELECT {_YEAR_MONTH}, o.name AS HospitalName, COUNT(claimId) AS TotalClaims,
       {_sum('claimTotal')} AS TotalClaimCost, {_avg('claimTotal')} AS AverageClaimCost
FROM line_claims c JOIN encounters e ON c.encounterId = e.encounter_ID
JOIN organizations o ON e.organizationID = o.ID GROUP BY ALL""")
def claims_cost_by_hospital(t: Tables):
    return as_doubles(
        marts.claims_cost_by_hospital(star.claims_of_lines(t), star.encounters(t), star.organizations(t)),
        "TotalClaimCost", "AverageClaimCost",
    )


@query("q_claims_with_encounters", star.SQL + """
SELECT claimId, claimStatus, CAST(claimTotal AS DOUBLE) AS claimTotal, claimbillablePeriodStart,
       claimbillablePeriodEnd, encounter_ID AS encounter_Id, "start" AS encounterDate, encounter_class
FROM line_claims c JOIN encounters e ON c.encounterId = e.encounter_ID""")
def claims_with_encounters(t: Tables):
    return as_doubles(
        marts.claims_with_encounters(star.claims_of_lines(t), star.encounters(t)), "claimTotal"
    )


def _clean(column: str) -> str:
    return f"regexp_replace({column}, '[0-9]', '', 'g')"


_PATIENT_NAME = f"{_clean('p.firstname')} || ' ' || {_clean('p.lastname')} AS patientName"
_MATCH = f"dc.description ILIKE '{COHORT}'"


@query("q_cohort_claims_overview", star.SQL + f"""
SELECT fc.claimId, fc.claimStatus, fc.claimCreated, CAST(fc.claimTotal AS DOUBLE) AS claimTotal,
       {_PATIENT_NAME}, hc.name AS hospitalName, m.medicationCode, m.medicationName AS MedicationName,
       d.condition_code AS diagnosisCode, dc.description AS diagnosisDescription
FROM order_claims fc JOIN encounters e ON fc.encounterId = e.encounter_ID
JOIN patients p ON fc.claimPatientId = p.ID JOIN organizations hc ON e.organizationID = hc.ID
JOIN encounter_conditions d ON e.encounter_ID = d.encounter_ID
JOIN medications m ON e.encounter_ID = replace(m.encounterID, 'urn:uuid:', '')
JOIN conditions dc ON d.condition_code = dc.code WHERE {_MATCH}""")
def cohort_claims_overview(t: Tables):
    df = marts.cohort_claims_overview(
        star.claims_of_orders(t), star.encounters(t), star.patients(t), star.organizations(t),
        star.encounter_conditions(t), star.medications(t), star.conditions(t), COHORT,
    )
    return as_doubles(df, "claimTotal")


@query("q_cohort_demographics", star.SQL + f"""
SELECT p.ID AS patient_Id, {_clean('p.firstname')} AS firstName, {_clean('p.lastname')} AS lastName,
       p.gender, p.DOB AS dob, CAST(date_diff('year', p.DOB, DATE '{AS_OF}') AS INTEGER) AS age,
       p.race, p.ethnicity, dc.code, dc.description
FROM patients p JOIN encounters e ON p.ID = e.patientID
JOIN encounter_conditions d ON e.encounter_ID = d.encounter_ID
JOIN conditions dc ON d.condition_code = dc.code WHERE {_MATCH}""")
def cohort_demographics(t: Tables):
    return marts.cohort_demographics(
        star.patients(t), star.encounters(t), star.encounter_conditions(t), star.conditions(t),
        COHORT, AS_OF,
    )


@query("q_cohort_encounters", star.SQL + f"""
SELECT p.ID AS patientId, {_PATIENT_NAME}, e.encounter_ID, e."start" AS encounterDate,
       e.encounter_class AS encounterType, hc.name AS providerName
FROM patients p JOIN encounters e ON p.ID = e.patientID JOIN organizations hc ON e.organizationID = hc.ID
JOIN encounter_conditions d ON e.encounter_ID = d.encounter_ID
JOIN conditions dc ON d.condition_code = dc.code WHERE {_MATCH}""")
def cohort_encounters(t: Tables):
    return marts.cohort_visits(
        star.patients(t), star.encounters(t), star.organizations(t),
        star.encounter_conditions(t), star.conditions(t), COHORT,
    )


@query("q_cohort_codes_ignoring_case", star.SQL + f"""
SELECT p.ID AS patientId, {_PATIENT_NAME}, e.encounter_ID, e."start" AS encounterDate,
       e.encounter_class AS encounterType, hc.name AS providerName
FROM patients p JOIN encounters e ON p.ID = e.patientID JOIN organizations hc ON e.organizationID = hc.ID
JOIN encounter_conditions d ON e.encounter_ID = d.encounter_ID
JOIN conditions dc ON lower('C' || d.condition_code) = lower('c' || dc.code) WHERE {_MATCH}""")
def cohort_codes_ignoring_case(t: Tables):
    """Encounters write codes in capitals, conditions in small letters."""
    return marts.cohort_visits(
        star.patients(t), star.encounters(t), star.organizations(t),
        star.encounter_conditions(t).withColumn("condition_code", F.concat(F.lit("C"), "condition_code")),
        star.conditions(t).withColumn("code", F.concat(F.lit("c"), "code")), COHORT,
    )


@query("q_cohort_hospitalization", star.SQL + f"""
SELECT p.ID AS patientId, {_PATIENT_NAME}, hc.name AS hospitalName, e."start" AS encounterDate,
       e.encounter_class AS encounterType, {_sum('fc.claimTotal')} AS hospitalizationCost
FROM patients p JOIN encounters e ON p.ID = e.patientID JOIN organizations hc ON e.organizationID = hc.ID
JOIN line_claims fc ON e.encounter_ID = fc.encounterId
JOIN encounter_conditions d ON e.encounter_ID = d.encounter_ID
JOIN conditions dc ON d.condition_code = dc.code WHERE {_MATCH}
GROUP BY p.ID, p.firstname, p.lastname, hc.name, e."start", e.encounter_class""")
def cohort_hospitalization(t: Tables):
    df = marts.cohort_hospitalization_summary(
        star.patients(t), star.encounters(t), star.organizations(t), star.claims_of_lines(t),
        star.encounter_conditions(t), star.conditions(t), COHORT,
    )
    return as_doubles(df, "hospitalizationCost")


@query("q_cohort_medications", star.SQL + f"""
SELECT p.ID AS patientId, {_PATIENT_NAME}, m.medicationCode, m.medicationName, m.dosageQuantity AS dosage,
       m.frequency, e."start" AS encounterDate
FROM patients p JOIN encounters e ON p.ID = e.patientID
JOIN medications m ON e.encounter_ID = replace(m.encounterID, 'urn:uuid:', '')
WHERE m.conditionThatCausedMedicationRequest ILIKE '{COHORT}'""")
def cohort_medications(t: Tables):
    return marts.cohort_medications(
        star.patients(t), star.encounters(t), star.medications(t), COHORT
    )
