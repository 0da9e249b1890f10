"""The warehouse for SQL users: temporary views that are resolved at each query.

A table view reads the table's folder and asks the manifest, as it is when the query
runs, which commits count; the answer prunes folders before any file is opened. Marts
are SQL over these views. Their cohort and reference day are session variables, so
Catalyst sees them as constants: ``SET VAR cohort_pattern = '%asthma%'``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from clinloom.functions.sql import register_functions
from clinloom.operators.documents import IMPORTED
from clinloom.plans import marts
from clinloom.sources.tables import TABLES
from clinloom.sources.warehouse import Warehouse

_ANY_CASE = "COLLATE UTF8_LCASE"
# The matching condition rows of the cohort's encounters; equal ones are one row with their number.
_COHORT = f"""
    (SELECT diagnosed.encounter_ID, condition_code, code, description, copies
     FROM fact_encounter_conditions AS diagnosed
     JOIN (SELECT code, description, count(*) AS copies FROM dim_condition
           WHERE description ILIKE session.cohort_pattern GROUP BY code, description) AS conditions
       ON condition_code {_ANY_CASE} = code {_ANY_CASE}) AS cohort"""
_COPIES = "LATERAL VIEW explode(sequence(1L, copies)) AS copy"


def _average(total: str, n: str) -> str:
    return f"CAST(CAST({total} AS DECIMAL(28,4)) / CAST({n} AS DECIMAL(14,0)) AS DECIMAL(19,4))"


def _person(first: str = "firstname", last: str = "lastname") -> str:
    return f"udf_RemoveNumericCharacters({first}) || ' ' || udf_RemoveNumericCharacters({last})"


# The view names and their columns. Rows are summed by exact spelling
# first; only the sums meet under the collation, and a group has its least spelling.
MARTS = {
    "vw_claims_overview": f"""
        SELECT min(claimStatus) AS claimStatus, min(claimUse) AS claimUse, sum(n) AS claimCount,
            sum(total) AS totalClaimAmount, {_average("sum(total)", "sum(n_total)")} AS averageClaimAmount,
            min(first) AS earliestClaimDate, max(last) AS latestClaimDate
        FROM (SELECT claimStatus, claimUse, count(*) AS n, sum(claimTotal) AS total, count(claimTotal) AS n_total,
                min(claimbillablePeriodStart) AS first, max(claimbillablePeriodEnd) AS last
              FROM fact_claim GROUP BY claimStatus, claimUse)
        GROUP BY claimStatus {_ANY_CASE}, claimUse {_ANY_CASE}""",
    "vw_claims_utilization_summary": """
        SELECT year(claimbillablePeriodStart) AS claimYear, month(claimbillablePeriodStart) AS claimMonth,
            count(*) AS totalClaims, sum(claimTotal) AS totalClaimAmount
        FROM fact_claim GROUP BY year(claimbillablePeriodStart), month(claimbillablePeriodStart)""",
    "vw_claims_by_ClaimType": f"""
        SELECT claimId, min(claimCode) AS ClaimType, sum(n) AS procedureCount, sum(total) AS totalClaimAmount
        FROM (SELECT claimId, claimCode, count(*) AS n, sum(claimTotal) AS total FROM fact_claim GROUP BY claimId, claimCode)
        GROUP BY claimId, claimCode {_ANY_CASE}""",
    "vw_claims_by_provider_diagnosis": f"""
        SELECT claimProviderReference, min(claimCode) AS diagnosisCode, sum(n) AS claimCount, sum(total) AS totalClaimAmount
        FROM (SELECT claimProviderReference, claimCode, count(*) AS n, sum(claimTotal) AS total
              FROM fact_claim GROUP BY claimProviderReference, claimCode)
        GROUP BY claimProviderReference, claimCode {_ANY_CASE}""",
    "vw_claims_CostByHospital": f"""
        SELECT claimYear, claimMonth, min(name) AS HospitalName, sum(n) AS TotalClaims, sum(total) AS TotalClaimCost,
            {_average("sum(total)", "sum(n_total)")} AS AverageClaimCost
        FROM (SELECT year(claimbillablePeriodStart) AS claimYear, month(claimbillablePeriodStart) AS claimMonth, name,
                count(claimId) AS n, sum(claimTotal) AS total, count(claimTotal) AS n_total
              FROM fact_claim JOIN fact_encounters ON encounterId = encounter_ID
              JOIN dim_organization ON organizationID = dim_organization.ID
              GROUP BY year(claimbillablePeriodStart), month(claimbillablePeriodStart), name)
        GROUP BY claimYear, claimMonth, name {_ANY_CASE}""",
    "vw_claims_with_encounters": """
        SELECT claimId, claimStatus, claimTotal, claimbillablePeriodStart, claimbillablePeriodEnd,
            encounter_ID AS encounter_Id, start AS encounterDate, encounter_class
        FROM fact_claim JOIN fact_encounters ON encounterId = encounter_ID""",
    "vw_DiabeticPatients_ClaimsOverview": f"""
        SELECT claimId, claimStatus, claimCreated, claimTotal, {_person()} AS patientName, name AS hospitalName,
            medicationCode, medicationName AS MedicationName, condition_code AS diagnosisCode,
            description AS diagnosisDescription
        FROM {_COHORT}
        JOIN fact_encounters AS visits ON cohort.encounter_ID = visits.encounter_ID
        JOIN dim_organization AS hospitals ON organizationID = hospitals.ID
        JOIN fact_claim AS claims ON cohort.encounter_ID = claims.encounterId
        JOIN dim_patient AS people ON claimPatientId = people.ID
        JOIN fact_medication_request AS prescribed ON cohort.encounter_ID = strip_urn(prescribed.encounterID)
        {_COPIES}""",
    "vw_DiabeticPatient_Demographics": f"""
        SELECT visits.patientID AS patient_Id, udf_RemoveNumericCharacters(firstname) AS firstName,
            udf_RemoveNumericCharacters(lastname) AS lastName, gender, DOB AS dob,
            age_years(DOB, coalesce(session.cohort_as_of, current_date())) AS age, race, ethnicity, code, description
        FROM {_COHORT}
        JOIN fact_encounters AS visits ON cohort.encounter_ID = visits.encounter_ID
        JOIN dim_patient AS people ON visits.patientID = people.ID
        {_COPIES}""",
    "vw_DiabeticPatient_Encounters": f"""
        SELECT visits.patientID AS patientId, {_person()} AS patientName, cohort.encounter_ID,
            visits.start AS encounterDate, encounter_class AS encounterType, name AS providerName
        FROM {_COHORT}
        JOIN fact_encounters AS visits ON cohort.encounter_ID = visits.encounter_ID
        JOIN dim_organization AS hospitals ON organizationID = hospitals.ID
        JOIN dim_patient AS people ON visits.patientID = people.ID
        {_COPIES}""",
    "vw_DiabeticPatient_HospitalizationSummary": f"""
        SELECT patientId, {_person()} AS patientName, hospitalName, encounterDate, encounterType, hospitalizationCost
        FROM (SELECT visits.patientID AS patientId, firstname, lastname, name AS hospitalName, visits.start AS encounterDate,
                encounter_class AS encounterType, sum(cost * CAST(n AS DECIMAL(12,0))) AS hospitalizationCost
              FROM (SELECT encounter_ID, sum(copies) AS n FROM {_COHORT} GROUP BY encounter_ID) AS matches
              JOIN (SELECT encounterId AS billed, sum(claimTotal) AS cost FROM fact_claim GROUP BY encounterId) ON encounter_ID = billed
              JOIN fact_encounters AS visits ON matches.encounter_ID = visits.encounter_ID
              JOIN dim_organization AS hospitals ON organizationID = hospitals.ID
              JOIN dim_patient AS people ON visits.patientID = people.ID
              GROUP BY visits.patientID, firstname, lastname, name, visits.start, encounter_class)""",
    "vw_DiabeticPatient_Medications": f"""
        SELECT visits.patientID AS patientId, {_person()} AS patientName, medicationCode, medicationName,
            dosageQuantity AS dosage, frequency, visits.start AS encounterDate
        FROM fact_medication_request AS prescribed
        JOIN fact_encounters AS visits ON strip_urn(prescribed.encounterID) = visits.encounter_ID
        JOIN dim_patient AS people ON visits.patientID = people.ID
        WHERE conditionThatCausedMedicationRequest ILIKE session.cohort_pattern""",
}


def mart_frames(wh: Warehouse, pattern: str = marts.DIABETES, as_of: dt.date | None = None) -> dict[str, DataFrame]:
    """The marts as DataFrames over what the warehouse holds now, under the names of the views."""
    claims, encounters = wh.read("fact_claim"), wh.read("fact_encounters")
    patients, hospitals = wh.read("dim_patient"), wh.read("dim_organization")
    diagnosed, conditions = wh.read("fact_encounter_conditions"), wh.read("dim_condition")
    medications = wh.read("fact_medication_request")
    return {
        "vw_claims_overview": marts.claims_overview(claims),
        "vw_claims_utilization_summary": marts.claims_utilization_summary(claims),
        "vw_claims_by_ClaimType": marts.claims_by_type(claims),
        "vw_claims_by_provider_diagnosis": marts.claims_by_provider_diagnosis(claims),
        "vw_claims_CostByHospital": marts.claims_cost_by_hospital(claims, encounters, hospitals),
        "vw_claims_with_encounters": marts.claims_with_encounters(claims, encounters),
        "vw_DiabeticPatients_ClaimsOverview": marts.cohort_claims_overview(
            claims, encounters, patients, hospitals, diagnosed, medications, conditions, pattern
        ),
        "vw_DiabeticPatient_Demographics": marts.cohort_demographics(
            patients, encounters, diagnosed, conditions, pattern, as_of
        ),
        "vw_DiabeticPatient_Encounters": marts.cohort_visits(
            patients, encounters, hospitals, diagnosed, conditions, pattern
        ),
        "vw_DiabeticPatient_HospitalizationSummary": marts.cohort_hospitalization_summary(
            patients, encounters, hospitals, claims, diagnosed, conditions, pattern
        ),
        "vw_DiabeticPatient_Medications": marts.cohort_medications(
            patients, encounters, medications, pattern
        ),
    }


def _table_view(wh: Warehouse, name: str) -> str:
    table = TABLES[name]
    # A partition column without any value yet has no type of its own.
    columns = [
        f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" if f.name in table.partition_by else f"`{f.name}`"
        for f in table.schema
        if (name, f.name) != ("JSONLogs", "status")
    ]
    text = f"SELECT {', '.join(columns)} FROM parquet.`{_quoted(wh.path(name))}`"
    if table.derived:
        return text
    newest = f"""
        SELECT from_json(max_by(value, _metadata.file_name), 'commits MAP<STRING, ARRAY<STRING>>').commits['{name}']
        FROM text.`{_quoted(wh.manifest.files)}`"""
    kept = f" AND status = {IMPORTED}" if name == "JSONLogs" else ""
    return f"{text} WHERE array_contains(({newest}), _commit){kept}"


def _quoted(path: str) -> str:
    return path.replace("`", "``")


def register_views(wh: Warehouse, pattern: str = marts.DIABETES, as_of: dt.date | None = None) -> list[str]:
    """Register functions, tables and marts in the session; the names registered.

    One call is enough: every query sees what any writer has published by then.
    ``pattern`` and ``as_of`` (the day of the query by default) set the variables
    ``cohort_pattern`` and ``cohort_as_of``.
    """
    spark = wh.spark
    wh.declare()
    register_functions(spark)
    spark.sql("DECLARE OR REPLACE VARIABLE cohort_pattern STRING")
    spark.sql("DECLARE OR REPLACE VARIABLE cohort_as_of DATE")
    spark.sql("SET VAR (cohort_pattern, cohort_as_of) = (SELECT :pattern, :as_of)", {"pattern": pattern, "as_of": as_of})
    views = {name: _table_view(wh, name) for name in TABLES} | MARTS
    for name, text in views.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW `{name}` AS {text}")
    return list(views)
