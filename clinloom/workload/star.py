"""The given tables under the names of the clinical star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.workload.registry import Tables

MONEY = "decimal(19,4)"


def claims_of_orders(t: Tables) -> DataFrame:
    """One claim per order."""
    return t.orders.selectExpr(
        "CAST(o_orderkey AS STRING) AS claimId",
        "o_orderstatus AS claimStatus",
        "o_orderpriority AS claimUse",
        "CAST(o_custkey AS STRING) AS claimPatientId",
        "o_orderdate AS claimbillablePeriodStart",
        "o_orderdate + INTERVAL 1 DAY AS claimbillablePeriodEnd",
        "o_orderdate AS claimCreated",
        "CAST(o_orderkey AS STRING) AS encounterId",
        f"CAST(o_totalprice AS {MONEY}) AS claimTotal",
    )


def claims_of_lines(t: Tables) -> DataFrame:
    """One claim row per order line."""
    return t.lineitem.selectExpr(
        "CAST(l_orderkey AS STRING) AS claimId",
        "l_linestatus AS claimStatus",
        "l_returnflag AS claimCode",
        "CAST(l_suppkey AS STRING) AS claimProviderReference",
        "l_shipdate AS claimbillablePeriodStart",
        "l_shipdate + INTERVAL 1 DAY AS claimbillablePeriodEnd",
        "l_linenumber AS itemSequence",
        "CAST(l_orderkey AS STRING) AS encounterId",
        f"CAST(l_extendedprice AS {MONEY}) AS claimTotal",
    )


def encounters(t: Tables) -> DataFrame:
    return t.orders.selectExpr(
        "CAST(o_orderkey AS STRING) AS encounter_ID",
        "o_orderdate AS start",
        "CAST(o_custkey AS STRING) AS patientID",
        "CAST(o_custkey % 25 AS STRING) AS organizationID",
        "o_orderpriority AS encounter_class",
    )


def patients(t: Tables) -> DataFrame:
    return t.customer.selectExpr(
        "CAST(c_custkey AS STRING) AS ID",
        "date_add(DATE'1930-01-01', CAST(c_custkey * 17 % 30000 AS INT)) AS DOB",
        "c_name AS firstname",
        "concat(c_mktsegment, c_custkey) AS lastname",
        "c_mktsegment AS gender",
        "c_mktsegment AS race",
        "CAST(c_nationkey AS STRING) AS ethnicity",
    )


def organizations(t: Tables) -> DataFrame:
    return t.nation.selectExpr("CAST(n_nationkey AS STRING) AS ID", "n_name AS name")


def encounter_conditions(t: Tables) -> DataFrame:
    return t.lineitem.selectExpr(
        "CAST(l_orderkey AS STRING) AS encounter_ID", "CAST(l_partkey AS STRING) AS condition_code"
    )


def conditions(t: Tables) -> DataFrame:
    """Condition codes are not unique: large parts appear a second time."""
    rows = t.part.selectExpr(
        "CAST(p_partkey AS STRING) AS code", "p_type AS description",
        "explode(CASE WHEN p_size > 25 THEN array(1, 2) ELSE array(1) END) AS copy",
    )
    return rows.drop("copy")


def medications(t: Tables) -> DataFrame:
    part = t.part.select("p_partkey", "p_name", "p_type")
    return t.lineitem.join(part, F.expr("l_partkey = p_partkey")).selectExpr(
        "concat('urn:uuid:', l_orderkey) AS encounterID",
        "CAST(l_partkey AS STRING) AS medicationCode",
        "p_name AS medicationName",
        "p_type AS conditionThatCausedMedicationRequest",
        "l_quantity AS dosageQuantity",
        "l_linenumber AS frequency",
    )


# The same schema for the comparison SQL.
SQL = f"""
WITH order_claims AS (
  SELECT o_orderkey::VARCHAR AS claimId, o_orderstatus AS claimStatus, o_orderpriority AS claimUse,
         o_custkey::VARCHAR AS claimPatientId, o_orderdate AS claimbillablePeriodStart,
         o_orderdate + INTERVAL 1 DAY AS claimbillablePeriodEnd, o_orderdate AS claimCreated,
         o_orderkey::VARCHAR AS encounterId, o_totalprice::{MONEY} AS claimTotal FROM orders),
line_claims AS (
  SELECT l_orderkey::VARCHAR AS claimId, l_linestatus AS claimStatus, l_returnflag AS claimCode,
         l_suppkey::VARCHAR AS claimProviderReference, l_shipdate AS claimbillablePeriodStart,
         l_shipdate + INTERVAL 1 DAY AS claimbillablePeriodEnd,
         l_orderkey::VARCHAR AS encounterId, l_extendedprice::{MONEY} AS claimTotal FROM lineitem),
encounters AS (
  SELECT o_orderkey::VARCHAR AS encounter_ID, o_orderdate AS "start", o_custkey::VARCHAR AS patientID,
         (o_custkey % 25)::VARCHAR AS organizationID, o_orderpriority AS encounter_class FROM orders),
patients AS (
  SELECT c_custkey::VARCHAR AS ID, DATE '1930-01-01' + (c_custkey * 17 % 30000)::INTEGER AS DOB,
         c_name AS firstname, c_mktsegment || c_custkey::VARCHAR AS lastname, c_mktsegment AS gender,
         c_mktsegment AS race, c_nationkey::VARCHAR AS ethnicity FROM customer),
organizations AS (SELECT n_nationkey::VARCHAR AS ID, n_name AS name FROM nation),
encounter_conditions AS (
  SELECT l_orderkey::VARCHAR AS encounter_ID, l_partkey::VARCHAR AS condition_code FROM lineitem),
conditions AS (
  SELECT p_partkey::VARCHAR AS code, p_type AS description FROM part
  UNION ALL SELECT p_partkey::VARCHAR, p_type FROM part WHERE p_size > 25),
medications AS (
  SELECT 'urn:uuid:' || l_orderkey::VARCHAR AS encounterID, l_partkey::VARCHAR AS medicationCode,
         p_name AS medicationName, p_type AS conditionThatCausedMedicationRequest,
         l_quantity AS dosageQuantity, l_linenumber AS frequency
  FROM lineitem JOIN part ON l_partkey = p_partkey)
"""
