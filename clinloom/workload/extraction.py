"""Extractor queries over bundles built from the tables."""

from __future__ import annotations

from clinloom.operators import resources
from clinloom.operators.load import load_new
from clinloom.plans.marts import claims_overview
from clinloom.workload import bundles, star
from clinloom.workload.marts import _avg
from clinloom.workload.registry import Tables, as_doubles, query


def _late(day: str) -> str:
    return f"CAST(CAST({day} AS DATE) AS VARCHAR) || 'T23:30:00-05:00'"


def _early(day: str) -> str:
    return f"CAST(CAST({day} AS DATE) AS VARCHAR) || 'T00:30:00+09:00'"


def _text(column: str) -> str:
    return f"CAST({column} AS VARCHAR)"


_ORDER_LINES = "orders LEFT JOIN lineitem ON o_orderkey = l_orderkey"


@query("q_extract_claim", f"""
SELECT {_text('o_orderkey')} AS claimId, o_orderstatus AS claimStatus, 'claim' AS claimUse,
       {_text('o_custkey')} AS claimPatientId, CAST(o_orderdate AS DATE) AS claimbillablePeriodStart,
       CAST(l_shipdate AS DATE) AS claimbillablePeriodEnd, CAST(o_orderdate AS DATE) AS claimCreated,
       {_text('l_suppkey')} AS claimProviderReference, o_orderpriority AS claimPriorityCode,
       CASE WHEN l_linestatus = 'F' THEN {_text('l_partkey')} END AS claimPrescriptionId,
       i.n = 1 AS claimFocal, i.n AS insuranceSequence,
       CASE i.n WHEN 1 THEN 'Plan ' || {_text('o_custkey')} WHEN 2 THEN 'Other' END AS claimCoverage,
       l_linenumber AS itemSequence, l_returnflag AS claimCode, {_text('l_orderkey')} AS encounterId,
       CAST(CAST(l_extendedprice AS DECIMAL(19,4)) AS DOUBLE) AS claimTotal, 'USD' AS claimCurrency
FROM {_ORDER_LINES},
     unnest(CASE o_orderstatus WHEN 'O' THEN [1, 2] WHEN 'F' THEN [1] ELSE [NULL] END) AS i(n),
     unnest(CASE WHEN l_orderkey IS NULL THEN [1] ELSE [1, 2] END) AS p(n)""")
def claim(t: Tables):
    return as_doubles(resources.extract_claim(bundles.claims(t)), "claimTotal")


@query("q_extract_claim_dates_as_written", f"""
SELECT DISTINCT {_text('o_orderkey')} AS claimId, {_late('o_orderdate')} AS claimbillablePeriodStart,
       {_early('l_shipdate')} AS claimbillablePeriodEnd, {_early('o_orderdate')} AS claimCreated
FROM {_ORDER_LINES}""")
def claim_dates_as_written(t: Tables):
    rows = resources.extract_claim(bundles.claims(t), repeats=False, cast_dates=False)
    return rows.select("claimId", "claimbillablePeriodStart", "claimbillablePeriodEnd", "claimCreated").distinct()


@query("q_extract_mixed_bundles", f"""
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id, 'Claim' AS kind, l_linestatus AS status,
       {_text('l_suppkey')} AS person, i.n AS item, {_text('l_orderkey')} AS encounter,
       CAST(CAST(l_extendedprice AS DECIMAL(19,4)) AS DOUBLE) AS total
FROM lineitem, unnest(range(1, l_linenumber % 3 + 2)) AS i(n)
UNION ALL
SELECT {_text('l_orderkey')}, 'Encounter', l_returnflag, {_text('l_suppkey')}, NULL, {_text('l_orderkey')}, NULL FROM lineitem""")
def mixed_bundles(t: Tables):
    """Claims of several items and encounters out of the same documents."""
    entries = bundles.mixed(t)
    claims = resources.extract_claim(entries).selectExpr(
        "claimId AS id", "'Claim' AS kind", "claimStatus AS status", "claimPatientId AS person",
        "CAST(itemSequence AS BIGINT) AS item", "encounterId AS encounter", "claimTotal AS total",
    )
    visits = resources.extract_encounter(entries).selectExpr(
        "encounterID AS id", "'Encounter' AS kind", "encounter_class AS status", "patientID AS person",
        "CAST(NULL AS BIGINT) AS item", "encounterID AS encounter", "CAST(NULL AS DECIMAL(19,4)) AS total",
    )
    return as_doubles(claims.unionByName(visits), "total")


_ENCOUNTER_FANOUT = """
FROM orders,
     unnest([{'code': o_orderstatus, 'display': 'status'}, {'code': o_orderpriority, 'display': 'priority'}]) AS c(coding),
     unnest(CASE o_orderstatus WHEN 'O' THEN [1, 2] WHEN 'F' THEN [1] ELSE [NULL] END) AS p(n)"""


@query("q_extract_encounter", f"""
SELECT o_orderkey AS JsonLogsID, {_text('o_orderkey')} AS encounterID,
       CAST(o_orderdate AS DATE) AS "start", CAST(o_orderdate AS DATE) AS "end",
       {_text('o_custkey')} AS patientID, {_text('o_custkey % 25')} AS organizationID,
       CASE p.n WHEN 1 THEN {_text('o_custkey % 100')} WHEN 2 THEN 'urn:uuid:' || {_text('o_custkey % 7')} END AS practitionerID,
       o_orderpriority AS encounter_class, c.coding.code AS encounter_code,
       c.coding.display AS encounter_description,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'reason' END AS encounterReasonName,
       CASE WHEN o_orderpriority = '1-URGENT' THEN {_text('o_custkey')} END AS encounterReasonCode
{_ENCOUNTER_FANOUT}""")
def encounter(t: Tables):
    return resources.extract_encounter(bundles.encounters(t))


@query("q_extract_encounter_treatments", f"""
SELECT {_text('o_orderkey')} AS encounterID, {_late('o_orderdate')} AS "start", {_early('o_orderdate')} AS "end",
       {_text('o_custkey')} AS patientID,
       'Organization?identifier=sys|' || {_text('o_custkey % 25')} AS organizationID,
       CASE p.n WHEN 1 THEN 'Practitioner?identifier=sys|' || {_text('o_custkey % 100')}
                WHEN 2 THEN {_text('o_custkey % 7')} END AS practitionerID,
       o_orderpriority AS encounter_class, c.coding.code AS encounter_code,
       c.coding.display AS encounter_description
{_ENCOUNTER_FANOUT}""")
def encounter_treatments(t: Tables):
    return resources.extract_encounter_treatments(bundles.encounters(t))


@query("q_extract_medication_request", f"""
SELECT l_orderkey AS JsonLogsID, {_text('l_orderkey')} AS medicationRequestID,
       l_linestatus AS medicationRequestStatus, 'order' AS medicationRequestIntent,
       p_name AS medicationName, {_text('p_partkey')} AS medicationCode,
       p_brand AS medicationCategoryAdministration, 'urn:uuid:' || {_text('l_suppkey')} AS patientId,
       'urn:uuid:' || {_text('l_orderkey')} AS encounterID,
       CAST(l_shipdate AS DATE) AS medicationRequestCreated, {_text('l_suppkey')} AS doctorID,
       'urn:uuid:' || {_text('l_partkey')} AS medicationRequestReasonID,
       p_type AS conditionThatCausedMedicationRequest, l_returnflag = 'R' AS asNeededBoolean,
       d.n AS sequence, l_linenumber AS frequency, l_tax AS period, 'd' AS periodUnit,
       l_quantity AS dosageQuantity
FROM lineitem JOIN part ON l_partkey = p_partkey,
     unnest(CASE WHEN l_linestatus = 'F' THEN [1, 2] ELSE [1] END) AS d(n)""")
def medication_request(t: Tables):
    return resources.extract_medication_request(bundles.medication_requests(t))


@query("q_extract_medication_doses", f"""
SELECT {_text('l_orderkey')} AS medicationRequestID, {_text('p_partkey')} AS medicationCode,
       d.n AS sequence, l_linenumber AS frequency, l_quantity + d.n AS dosageQuantity
FROM lineitem JOIN part ON l_partkey = p_partkey,
     unnest(CASE WHEN l_linestatus = 'F' THEN [1, 2] ELSE [1] END) AS d(n)""")
def medication_doses(t: Tables):
    """Each instruction has a dose of its own, beside that of the resource."""
    rows = resources.extract_medication_request(bundles.medication_requests(t, dose_in_instruction=True), "instruction")
    return rows.select("medicationRequestID", "medicationCode", "sequence", "frequency", "dosageQuantity")


@query("q_extract_eob", f"""
SELECT {_text('o_orderkey')} AS ExplanationOfBenefitId, 'active' AS status, 'claim' AS ExplanationOfBenefitUse,
       o_orderstatus AS ExplanationOfBenefitCodingDetailsCode, {_text('o_custkey')} AS patientID,
       {_late('o_orderdate')} AS billablePeriodStart, {_early('o_orderdate')} AS billablePeriodEnd,
       {_early('o_orderdate')} AS created, {_text('o_custkey % 25')} AS providerReference,
       'Plan ' || {_text('o_custkey % 5')} AS coverage, 1 AS itemSequence,
       o_orderpriority AS itemProductOrderServiceCode,
       CASE k.n WHEN 1 THEN 'ServiceRequest' ELSE 'Coverage' END AS containedResourceType,
       CASE k.n WHEN 1 THEN 'referral' ELSE 'coverage' END AS containedId,
       CASE k.n WHEN 1 THEN 'completed' ELSE 'active' END AS containedStatus,
       CASE k.n WHEN 1 THEN 'order' END AS containedIntent,
       CASE k.n WHEN 1 THEN {_text('o_custkey')} END AS containedSubject,
       CASE k.n WHEN 1 THEN {_text('o_custkey % 100')} END AS containedReference,
       CASE k.n WHEN 1 THEN {_text('o_custkey % 7')} END AS containedPerformer,
       CASE k.n WHEN 2 THEN o_orderpriority END AS containedType,
       CASE k.n WHEN 2 THEN {_text('o_custkey')} END AS containedBeneficiary,
       CASE k.n WHEN 2 THEN 'Payer' END AS containedPayor,
       {_text('o_orderkey')} AS itemEncounterId, 'complete' AS outcome,
       CASE c.n WHEN 1 THEN 'primary' ELSE 'other' END AS roleCode,
       CASE c.n WHEN 1 THEN 'Primary provider' ELSE 'Other provider' END AS careTeamRoleName,
       {_text('c.n')} AS careTeamSequence,
       CASE c.n WHEN 1 THEN {_text('o_custkey % 100')} ELSE {_text('o_custkey % 7')} END AS careTeamProvider,
       '1' AS itemcategoryCode, 'Medical care' AS itemcategoryName,
       {_late('o_orderdate')} AS servicePeriodStart, {_early('o_orderdate')} AS servicePeriodEnd,
       '21' AS locationCodeableConceptCode, 'Inpatient Hospital' AS locationCodeableConceptName,
       'USD' AS ExplanationOfBenefitCurrency,
       CAST(CASE x.n WHEN 1 THEN o_totalprice ELSE o_custkey END AS DOUBLE) AS ExplanationOfBenefitTotalAmount,
       CASE x.n WHEN 1 THEN 'submitted' ELSE 'benefit' END AS totalCategoryCode,
       CASE x.n WHEN 1 THEN 'Submitted Amount' ELSE 'Benefit Amount' END AS totalCategoryName,
       CAST(CAST(o_totalprice AS DECIMAL(19,4)) AS DOUBLE) AS paymentAmountValue, 'USD' AS paymentAmountCurrency
FROM orders, unnest([1, 2]) AS k(n),
     unnest(CASE WHEN o_orderstatus = 'O' THEN [1, 2] ELSE [1] END) AS c(n),
     unnest(CASE WHEN o_orderstatus = 'O' THEN [1, 2] ELSE [1] END) AS x(n)""")
def explanation_of_benefit(t: Tables):
    df = resources.extract_explanation_of_benefit(bundles.benefits(t))
    # The amount is text; how a number is spelled is up to each engine.
    amount = df["ExplanationOfBenefitTotalAmount"].try_cast("double")
    return as_doubles(df.withColumn("ExplanationOfBenefitTotalAmount", amount), "paymentAmountValue")


@query("q_extract_care_team", f"""
SELECT {_text('c_custkey')} AS UID, 'CareTeam' AS resourceType, {_text('c_custkey')} AS id, 'active' AS status,
       {_text('c_custkey')} AS subject, {_text('c_nationkey')} AS encounter, '2020-01-01' AS periodStart,
       r.code AS roleCode, CASE WHEN r.code IS NOT NULL THEN 'snomed' END AS roleSystem,
       CASE WHEN r.code IS NOT NULL THEN c_mktsegment END AS roleName,
       CASE WHEN r.code = 'r3' THEN {_text('c_nationkey')} WHEN r.code IS NOT NULL THEN {_text('c_custkey')} END AS roleMemberReference,
       CASE WHEN r.code = 'r3' THEN 'doctor' WHEN r.code IS NOT NULL THEN c_name END AS roleMemberDisplay,
       'snomed' AS reasonSystem, 'x' AS code, c_mktsegment AS reasonNameFromCoding,
       {_text('c_nationkey')} AS managingOrganizationReference, 'HOSPITAL' AS managingOrganizationName
FROM customer,
     unnest(CASE c_mktsegment WHEN 'BUILDING' THEN [NULL] WHEN 'MACHINERY' THEN ['r1', 'r2']
            ELSE ['r1', 'r2', 'r3'] END) AS r(code)""")
def care_team(t: Tables):
    return resources.extract_care_team(bundles.care_teams(t))


@query("q_extract_care_plan", f"""
SELECT {_text('o_orderkey')} AS UID, 'CarePlan' AS resourceType, {_text('o_orderkey')} AS id,
       o_orderstatus AS status, {_text('o_custkey')} AS subject, {_text('o_orderkey')} AS encounter,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS periodStart, 'order' AS intent, 'snomed' AS system,
       o_orderpriority AS categoryCodingCode, 'priority' AS categoryCodingName,
       {_text('o_custkey')} AS careTeamID, l_linestatus AS activityDetailStatus,
       l_returnflag AS activityDetailLocation,
       CASE WHEN l_orderkey IS NOT NULL THEN 'activity' END AS activityDetailText,
       CASE a.n WHEN 1 THEN 's1' WHEN 2 THEN 's2' END AS activityCodingSystem,
       CASE a.n WHEN 1 THEN {_text('l_partkey')} WHEN 2 THEN {_text('l_suppkey')} END AS activityCodingCode,
       CASE a.n WHEN 1 THEN 'part' WHEN 2 THEN 'supplier' END AS activityCodingName
FROM {_ORDER_LINES},
     unnest(CASE WHEN l_orderkey IS NULL THEN [NULL] WHEN l_returnflag = 'R' THEN [1, 2] ELSE [1] END) AS a(n)""")
def care_plan(t: Tables):
    return resources.extract_care_plan(bundles.care_plans(t))


_SUPPLIER_PHONE = """unnest(CASE WHEN s_acctbal > 5000 THEN [1, 2] ELSE [1] END) AS p(n)"""
_CUSTOMER_PHONE = """unnest(CASE WHEN c_acctbal > 5000 THEN [1, 2] ELSE [1] END) AS p(n)"""


def _phone(key: str, value: str, kind: str, use: str) -> str:
    return f"""CASE p.n WHEN 1 THEN {_text(key)} WHEN 2 THEN {_text(key)} || '@example.com' END AS {value},
       CASE p.n WHEN 1 THEN 'phone' WHEN 2 THEN 'email' END AS {kind},
       CASE p.n WHEN 1 THEN 'home' WHEN 2 THEN 'work' END AS {use}"""


def _gender(key: str) -> str:
    return f"CASE WHEN {key} > 12 THEN 'male' ELSE 'female' END AS gender"


@query("q_extract_practitioner", f"""
SELECT {_text('s_suppkey')} AS ID, 'Dr.' AS prefix, 'Given' || {_text('s_suppkey')} AS firstname,
       s_name AS lastname, {_gender('s_nationkey')}, '1 Elm St,US' AS address,
       'City ' || {_text('s_nationkey')} AS city, 'MA' AS state, '01970' AS zip,
       {_phone('s_suppkey', 'contactvalue', 'contactmethod', 'contacttype')}
FROM supplier, {_SUPPLIER_PHONE}""")
def practitioner(t: Tables):
    return resources.extract_practitioner(bundles.practitioners(t))


@query("q_extract_organization", f"""
SELECT {_text('s_suppkey')} AS organizationID, s_name AS name, '1 Elm St,US' AS address,
       'City ' || {_text('s_nationkey')} AS city, 'MA' AS state, '01970' AS zip,
       CASE WHEN s_nationkey > 12 THEN {_text('s_suppkey')} END AS phone, 'Healthcare Provider' AS "type"
FROM supplier, {_SUPPLIER_PHONE}""")
def organization(t: Tables):
    return resources.extract_organization(bundles.organizations(t))


_BIRTH = "CAST(DATE '1950-01-01' + CAST(c_custkey % 20000 AS INTEGER) AS TIMESTAMP) AS birthDate"


@query("q_extract_patient", f"""
SELECT {_text('c_custkey')} AS patientID, 'Patient' AS resourceType, 'Dr.' AS prefix, c_name AS family,
       'Given' || {_text('c_custkey')} AS given, {_gender('c_nationkey')}, {_BIRTH},
       '1 Elm St' AS address, 'City ' || {_text('c_nationkey')} AS city, 'MA' AS state, 'US' AS country,
       CASE e.n WHEN 1 THEN c_mktsegment END AS race,
       {_phone('c_custkey', 'contactvalue', 'contactmethod', 'contacttype')},
       'English' AS languageSpoken, c_mktsegment AS maritalValue
FROM customer, {_CUSTOMER_PHONE}, unnest([1, 2]) AS e(n),
     unnest(CASE c_mktsegment WHEN 'BUILDING' THEN [1] WHEN 'MACHINERY' THEN [1, 2] ELSE [1, 2, 3] END) AS i(n)""")
def patient(t: Tables):
    return resources.extract_patient(bundles.patients(t))


@query("q_extract_identifier", f"""
SELECT {_text('c_custkey')} AS personNumber, i.code AS idShortCode,
       CASE i.code WHEN 'MR' THEN 'Medical Record' ELSE 'Social Security' END AS idTypeName,
       CASE i.code WHEN 'MR' THEN c_name ELSE {_text('c_nationkey')} END AS idNumber
FROM customer,
     unnest(CASE c_mktsegment WHEN 'BUILDING' THEN [] WHEN 'MACHINERY' THEN ['MR'] ELSE ['MR', 'SS'] END) AS i(code)""")
def identifier(t: Tables):
    return resources.extract_identifier(bundles.patients(t))


@query("q_extract_person", f"""
SELECT {_text('c_custkey')} AS UID, 'Patient' AS resourceType, 'Dr.' AS prefix, c_name AS family,
       'Given' || {_text('c_custkey')} AS given, {_gender('c_nationkey')}, {_BIRTH}, '1 Elm St' AS line,
       'City ' || {_text('c_nationkey')} AS city, 'MA' AS state, 'US' AS country,
       {_phone('c_custkey', 'phoneoremail', 'method', 'use')}
FROM customer, {_CUSTOMER_PHONE}
UNION ALL BY NAME
SELECT {_text('s_suppkey')} AS UID, 'Practitioner' AS resourceType, 'Dr.' AS prefix, s_name AS family,
       'Given' || {_text('s_suppkey')} AS given, {_gender('s_nationkey')},
       CAST(NULL AS TIMESTAMP) AS birthDate, '1 Elm St' AS line,
       'City ' || {_text('s_nationkey')} AS city, 'MA' AS state, 'US' AS country,
       {_phone('s_suppkey', 'phoneoremail', 'method', 'use')}
FROM supplier, {_SUPPLIER_PHONE}""")
def person(t: Tables):
    return resources.extract_person(bundles.people(t))


@query("q_claims_overview_from_documents", f"""
WITH work AS (
  SELECT DISTINCT o_orderkey, o_orderstatus, l_orderkey, l_linenumber, l_returnflag, l_suppkey, o_orderpriority,
         CASE WHEN l_linestatus = 'F' THEN l_partkey END AS prescription, i.n, l_extendedprice, o_custkey,
         CAST(o_orderdate AS DATE) AS first_day, CAST(l_shipdate AS DATE) AS last_day
  FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey,
       unnest(CASE o_orderstatus WHEN 'O' THEN [1, 2] WHEN 'F' THEN [1] ELSE [NULL] END) AS i(n)
  WHERE o_orderpriority <> '1-URGENT')
SELECT o_orderstatus AS claimStatus, 'claim' AS claimUse, COUNT(*) AS claimCount,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(19,4))) AS DOUBLE) AS totalClaimAmount,
       {_avg('l_extendedprice')} AS averageClaimAmount,
       MIN(first_day) AS earliestClaimDate, MAX(last_day) AS latestClaimDate
FROM work GROUP BY o_orderstatus""")
def claims_overview_from_documents(t: Tables):
    """From documents to the mart: extract, drop copies and known claims, report.

    Claims of urgent orders are in the table already.
    """
    known = star.claims_of_orders(t).filter("claimUse = '1-URGENT'")
    work = resources.extract_claim(bundles.claims(t), repeats=False)
    fresh = load_new(work, known, "claimId", dedupe="rows")
    return as_doubles(claims_overview(fresh), "totalClaimAmount", "averageClaimAmount")
