"""Views over a warehouse: what a query sees without another registration, and the marts in SQL."""

from __future__ import annotations

import datetime as dt

import pytest
from plain import rows_of
from pyspark.sql import functions as F

from clinloom.plans.views import mart_frames, register_views
from clinloom.sources.tables import TABLES
from clinloom.sources.warehouse import Warehouse

AS_OF = dt.date(2024, 1, 1)
# Rows by table; columns that are not named here are NULL.
ROWS = {
    "fact_claim": """
        SELECT * FROM VALUES ('c1', 'active', 'X', 'p1', 'e1', 10.5, 'a', 'r1'), ('c1', 'Active', 'x', 'p1', 'e1', 5, 'A', 'r1'),
            ('c2', NULL, 'X', 'p2', 'e2', NULL, NULL, NULL), ('c3', 'ACTIVE', 'X', 'p3', 'e3', 1, 'b', 'r1'), ('c4', 'active', 'X', 'p1', 'e1', 2, 'a', 'R1')
        AS t(claimId, claimStatus, claimUse, claimPatientId, encounterId, claimTotal, claimCode, claimProviderReference)
        CROSS JOIN VALUES (TIMESTAMP_NTZ '2020-01-31 00:00:00', TIMESTAMP_NTZ '2020-02-01 00:00:00')
        AS d(claimbillablePeriodStart, claimbillablePeriodEnd)""",
    "fact_encounters": """
        SELECT *, TIMESTAMP_NTZ '2020-01-01 10:00:00' AS start FROM VALUES ('e1', 'p1', 'o1', 'AMB'), ('e2', 'p2', 'o2', 'EMER'), ('e3', 'p3', 'o1', NULL)
        AS t(encounter_ID, patientID, organizationID, encounter_class)""",
    "fact_encounter_conditions": """
        SELECT * FROM VALUES ('p1', 'e1', '44a'), ('p1', 'e1', '45'), ('p2', 'e2', '44A'), ('p3', 'e3', '99') AS t(patientID, encounter_ID, condition_code)""",
    "fact_medication_request": """
        SELECT * FROM VALUES ('urn:uuid:e1', 'm1', 'Metformin', 'Diabetes', 1.5D, 2), ('e2', 'm2', 'Other', 'Asthma', 1D, 1)
        AS t(encounterID, medicationCode, medicationName, conditionThatCausedMedicationRequest, dosageQuantity, frequency)""",
    "dim_patient": """
        SELECT * FROM VALUES ('p1', 'Ann1', 'Lee1', DATE '2000-12-31', 'F'), ('p2', 'Ann2', 'Lee2', DATE '2001-01-01', NULL), ('p3', 'Bo', 'Ray', DATE '2001-01-01', 'M')
        AS t(ID, firstname, lastname, DOB, gender)""",
    "dim_organization": "SELECT * FROM VALUES ('o1', 'Hospital'), ('o2', 'HOSPITAL') AS t(ID, name)",
    "dim_condition": """
        SELECT * FROM VALUES ('44A', 'Diabetes'), ('44A', 'type 2 diabetes'), ('44A', 'Diabetes'), ('45', 'prediabetes'), ('99', 'Asthma') AS t(code, description)""",
}


@pytest.fixture
def wh(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "ware`house"))


def fill(wh):
    with wh.transaction():
        for name, text in ROWS.items():
            wh.append(name, wh.spark.sql(text))


def test_marts_in_sql_equal_the_frames(spark, wh):
    register_views(wh, as_of=AS_OF)
    fill(wh)
    for name, frame in mart_frames(wh, as_of=AS_OF).items():
        view = spark.sql(f"SELECT * FROM {name}")
        assert [(f.name, f.dataType) for f in view.schema] == [(f.name, f.dataType) for f in frame.schema], name
        rows = rows_of(view)
        assert rows and rows == rows_of(frame), name
    spark.sql("SET VAR cohort_pattern = '%ASTHMA%'")
    assert rows_of(spark.sql("SELECT patientId, medicationCode FROM vw_DiabeticPatient_Medications")) == [("p2", "m2")]
    assert rows_of(spark.sql("SELECT patient_Id, age FROM vw_DiabeticPatient_Demographics")) == [("p3", 23)]


def test_queries_see_what_other_sessions_published(spark, wh):
    names = register_views(wh, as_of=AS_OF)
    assert len(names) == len(TABLES) + 11 and spark.sql("SELECT * FROM vw_claims_CostByHospital").collect() == []
    other = Warehouse(spark.newSession(), wh.root)
    fill(other)
    assert spark.sql("SELECT sum(claimCount) FROM vw_claims_overview").first()[0] == 5
    fill(other)
    assert spark.sql("SELECT sum(claimCount) FROM vw_claims_overview").first()[0] == 10
    with pytest.raises(KeyboardInterrupt):
        with other.transaction():
            other.append("fact_claim", other.spark.sql(ROWS["fact_claim"]))
            raise KeyboardInterrupt
    # rows of a commit that never came are neither seen nor read
    assert spark.sql("SELECT count(*) FROM fact_claim").first()[0] == 10
    plan = spark.sql("SELECT claimId FROM fact_claim")._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan parquet [claimId" in line)
    assert "ubquery" in scan.split("PartitionFilters: [")[1].split("PushedFilters")[0], scan
    other.remove_unpublished()
    other.recreate("fact_claim")
    other.remove_unpublished()
    assert spark.sql("SELECT count(*) FROM fact_claim").first()[0] == 0
    assert spark.sql("SELECT count(*) FROM fact_encounters").first()[0] == 6


def test_document_tables_keep_their_partition_types(spark, wh):
    register_views(wh)
    day = dt.date(2024, 1, 2)
    before = {n: spark.table(n).schema for n in ("JSONLogs", "bundle_entries")}
    rows = spark.sql("SELECT 1L AS doc_id, '{}' AS json, 1 AS status, DATE '2024-01-02' AS import_date UNION ALL SELECT 2L, '5', 2, DATE '2024-01-02'")
    wh.append("JSONLogs", rows)
    entries = spark.sql("SELECT 1L AS doc_id, parse_json('{\"a\":1}') AS resource, DATE '2024-01-02' AS import_date, 'Claim' AS resourceType")
    wh.replace_partitions("bundle_entries", entries)
    assert rows_of(spark.sql("SELECT doc_id, import_date FROM JSONLogs")) == [(1, day)]
    assert rows_of(spark.sql("SELECT resourceType, import_date, variant_get(resource, '$.a', 'int') FROM bundle_entries")) == [("Claim", day, 1)]
    assert {n: spark.table(n).schema for n in before} == before
    assert before["bundle_entries"].names == TABLES["bundle_entries"].schema.names
    wh.recreate("bundle_entries")
    assert spark.sql("SELECT * FROM bundle_entries").where(F.col("doc_id").isNotNull()).collect() == []
