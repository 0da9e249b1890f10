"""Queries on import, incremental load, keys and quality checks.

In the load queries the claims of orders with status P are already in the
target, and the claims of all orders arrive.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.operators import documents, keys, load, quality
from clinloom.operators.typed import cast_rejects
from clinloom.plans.checks import check_table
from clinloom.sources.files import as_documents, csv_columns, csv_rows
from clinloom.workload.registry import Tables, query

# --- documents ------------------------------------------------------------------


def _incoming(t: Tables) -> DataFrame:
    """Texts that are JSON (event properties) and texts that are not (documents)."""
    return t.documents.selectExpr("concat('doc/', doc_id) AS file_path", "text AS json").unionByName(
        t.events.selectExpr("concat('event/', event_id) AS file_path", "props AS json")
    )


_INCOMING = """
WITH incoming AS (
  SELECT 'doc/' || CAST(doc_id AS VARCHAR) AS file_path, text AS json FROM documents
  UNION ALL SELECT 'event/' || CAST(event_id AS VARCHAR), props FROM events),
judged AS (
  SELECT file_path, json_valid(json) AND left(ltrim(json), 1) IN ('{', '[') AS valid FROM incoming),
known AS (SELECT 'doc/' || CAST(doc_id AS VARCHAR) AS file_path FROM labels)
"""


def _known(t: Tables) -> DataFrame:
    return t.labels.selectExpr("concat('doc/', doc_id) AS file_path")


@query("q_validity_gate", """
SELECT 'event/' || CAST(event_id AS VARCHAR) || '/' || e.kind AS file_path, e.good AS valid
FROM events, unnest([{'kind': 'whole', 'good': true}, {'kind': 'listed', 'good': true}, {'kind': 'repeated key', 'good': true},
                     {'kind': 'trailing', 'good': false}, {'kind': 'doubled', 'good': false},
                     {'kind': 'joined', 'good': false}, {'kind': 'cut', 'good': false}]) AS u(e)
UNION ALL SELECT 'doc/' || CAST(doc_id AS VARCHAR), false FROM documents""")
def validity_gate(t: Tables):
    texts = {
        "whole": "props", "listed": "concat('[', props, ', 1]')",
        "repeated key": "concat('{\"a\":', event_id, ',\"a\":', props, '}')", "trailing": "concat(props, ' xyz')",
        "doubled": "concat(props, props)", "joined": "concat(props, ',', props)",
        "cut": "substring(props, 1, length(props) - 1)",
    }
    kinds = ", ".join(f"named_struct('kind', '{k}', 'json', {v})" for k, v in texts.items())
    events = t.events.selectExpr("event_id", f"inline(array({kinds}))").selectExpr(
        "concat('event/', event_id, '/', kind) AS file_path", "json"
    )
    docs = t.documents.selectExpr("concat('doc/', doc_id) AS file_path", "text AS json")
    return documents.judged(events.unionByName(docs)).select("file_path", "valid")


@query("q_document_rows", """
SELECT 'event/' || CAST(event_id AS VARCHAR) AS file_path, 'e' || CAST(event_id AS VARCHAR) AS file_name, md5(props) AS checksum,
       CAST(1 AS INTEGER) AS status, DATE '2024-01-15' AS import_date, TIMESTAMP '2024-01-15 23:30:00' AS import_ts
FROM events
UNION ALL
SELECT 'doc/' || CAST(doc_id AS VARCHAR), 'd' || CAST(doc_id AS VARCHAR), md5(text), 2, DATE '2024-01-15',
       TIMESTAMP '2024-01-15 23:30:00'
FROM documents""")
def document_rows(t: Tables):
    """Rows of the document log for texts that are JSON and texts that are not."""
    files = _incoming(t).withColumn(
        "file_name", F.concat(F.substring("file_path", 1, 1), F.substring_index("file_path", "/", -1))
    )
    return as_documents(files, dt.datetime(2024, 1, 15, 23, 30), 1).select(
        "file_path", "file_name", "checksum", "status", "import_date", "import_ts"
    )


@query("q_csv_rows", """
SELECT CAST(c_custkey AS VARCHAR) AS ID, CASE WHEN c_nationkey % 5 > 0 THEN DATE '1970-01-01' + c_nationkey END AS DOB,
       c_name AS firstname, c_mktsegment AS lastname
FROM customer WHERE c_nationkey % 3 > 0""")
def csv_rows_of_customers(t: Tables):
    """Text records to typed rows: bad dates load as NULL, broken records do not load."""
    header = ["Id", "LAST", "BIRTHDATE", "FIRST"]
    records = t.customer.selectExpr(
        "CAST(c_custkey AS STRING) AS Id", "c_mktsegment AS LAST",
        "CASE WHEN c_nationkey % 5 > 0 THEN CAST(date_add(DATE '1970-01-01', c_nationkey) AS STRING) ELSE 'soon' END AS BIRTHDATE",
        "c_name AS FIRST", "CASE WHEN c_nationkey % 3 = 0 THEN 'torn' END AS broken",
    )
    rename = {"birthdate": "DOB", "first": "firstname", "last": "lastname"}
    return csv_rows(csv_columns(records, header, "dim_patient", rename, "broken"), "dim_patient", "broken")[0]


@query("q_check_table", """
SELECT 'length' AS rule, '["' || CAST(s_suppkey AS VARCHAR) || '"]' AS key, 'phone has ' || CAST(90 + s_nationkey AS VARCHAR) || ' of 100' AS detail
FROM supplier WHERE s_nationkey > 10
UNION ALL SELECT 'unique', '["' || CAST(s_suppkey AS VARCHAR) || '"]', '2 rows' FROM supplier WHERE s_nationkey % 4 = 0
UNION ALL SELECT 'length', '["' || CAST(s_suppkey AS VARCHAR) || '"]', 'phone has ' || CAST(90 + s_nationkey AS VARCHAR) || ' of 100'
FROM supplier WHERE s_nationkey > 10 AND s_nationkey % 4 = 0""")
def check_payers(t: Tables):
    """Rules of a table: some rows doubled, some texts too long."""
    rows = t.supplier.selectExpr(
        "CAST(s_suppkey AS STRING) AS ID", "s_name AS name", "CAST(NULL AS STRING) AS address", "CAST(NULL AS STRING) AS city",
        "CAST(NULL AS STRING) AS state", "CAST(NULL AS STRING) AS zip", "repeat('5', 90 + s_nationkey) AS phone",
        "TIMESTAMP_NTZ '2024-01-15 00:00:00' AS created_dt",
        "explode(sequence(1, CASE WHEN s_nationkey % 4 = 0 THEN 2 ELSE 1 END)) AS n",
    ).drop("n")
    return check_table(rows, "dim_payer")


@query("q_skip_imported", _INCOMING + """
SELECT file_path FROM incoming WHERE file_path NOT IN (SELECT file_path FROM known)""")
def skip_imported(t: Tables):
    return documents.not_imported(_incoming(t).select("file_path"), _known(t))


@query("q_import_status", _INCOMING + """
SELECT file_path, CAST(CASE WHEN file_path IN (SELECT file_path FROM known) THEN 3
                            WHEN valid THEN 1 ELSE 2 END AS INTEGER) AS status FROM judged""")
def import_status(t: Tables):
    return documents.import_status(_incoming(t), _known(t))


@query("q_doc_checksum_changes", """
SELECT doc_id, md5(text) AS old_checksum, md5(text || '.') AS new_checksum
FROM documents WHERE lang = 'en'""")
def doc_checksum_changes(t: Tables):
    """English documents come back with one more character, the others unchanged."""
    before = t.documents.selectExpr("doc_id", "text AS json")
    now = t.documents.selectExpr("doc_id", "CASE WHEN lang = 'en' THEN concat(text, '.') ELSE text END AS json")
    return documents.changed_documents(now, before, "doc_id")


@query("q_day_slice", """
SELECT event_id, event_type FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'""")
def day_slice(t: Tables):
    return documents.day_slice(t.events, "ts", dt.date(2024, 1, 15)).select("event_id", "event_type")


@query("q_latest_document", """
SELECT event_id, ts FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15' ORDER BY ts DESC, event_id LIMIT 1""")
def latest_document(t: Tables):
    day = documents.day_slice(t.events.select("event_id", "ts"), "ts", dt.date(2024, 1, 15))
    return documents.latest_document(day, "ts", "event_id")


@query("q_any_document", "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 1")
def any_document(t: Tables):
    return documents.any_document(t.documents.select("doc_id", "lang"), "doc_id")


# --- incremental load --------------------------------------------------------------


def _work(t: Tables) -> DataFrame:
    return t.lineitem.selectExpr(
        "CAST(l_orderkey AS STRING) AS claimId", "l_orderkey AS JsonLogsID",
        "l_returnflag AS claimCode", "l_linestatus AS claimStatus", "l_linenumber AS itemSequence",
    )


def _target(t: Tables) -> DataFrame:
    return t.orders.filter("o_orderstatus = 'P'").selectExpr(
        "CAST(o_orderkey AS STRING) AS claimId", "o_orderkey AS JSONLogsId"
    )


_LOAD = """
WITH work AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS claimId, l_orderkey AS JsonLogsID, l_returnflag AS claimCode,
         l_linestatus AS claimStatus, l_linenumber AS itemSequence FROM lineitem),
target AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS claimId, o_orderkey AS JSONLogsId FROM orders WHERE o_orderstatus = 'P'),
fresh AS (SELECT * FROM work WHERE claimId NOT IN (SELECT claimId FROM target))
"""


@query("q_load_new", _LOAD + "SELECT * FROM fresh")
def load_new(t: Tables):
    return load.load_new(_work(t), _target(t), "claimId")


@query("q_load_new_dedupe", _LOAD + "SELECT DISTINCT claimId, claimCode, claimStatus FROM fresh")
def load_new_dedupe(t: Tables):
    work = _work(t).select("claimId", "claimCode", "claimStatus")
    return load.load_new(work, _target(t), "claimId", dedupe="rows")


_FIRST = """row_number() OVER (PARTITION BY claimId
         ORDER BY claimId, JsonLogsID, claimCode, claimStatus, itemSequence)"""


@query("q_load_new_one_per_key", _LOAD + f"""
SELECT claimId, JsonLogsID, claimCode, claimStatus, itemSequence
FROM (SELECT *, {_FIRST} AS place FROM fresh) WHERE place = 1""")
def load_new_one_per_key(t: Tables):
    return load.load_new(_work(t), _target(t), "claimId", dedupe="key")


@query("q_key_rejects", _LOAD + f"""
SELECT claimId, JsonLogsID, claimCode, claimStatus, itemSequence
FROM (SELECT *, {_FIRST} AS place FROM (SELECT DISTINCT * FROM work)) WHERE place > 1""")
def key_rejects(t: Tables):
    """Rows that a one-row-per-key load leaves out."""
    return keys.not_first_per_key(_work(t), "claimId")


@query("q_known_keys", _LOAD + """
SELECT DISTINCT claimId FROM target WHERE claimId IN (SELECT claimId FROM work)""")
def known_keys(t: Tables):
    return load.known_keys(_work(t), _target(t), "claimId")


@query("q_import_log", _LOAD + """
SELECT DISTINCT JsonLogsID AS JSONLogsId, 'Claim' AS ResourceType, TIMESTAMP '2024-01-15' AS ExportDate
FROM work WHERE JsonLogsID NOT IN (SELECT JSONLogsId FROM target)""")
def import_log(t: Tables):
    return load.import_log_rows(_work(t), _target(t), "Claim", export_date=dt.date(2024, 1, 15))


@query("q_inserted_keys", _LOAD + """
SELECT claimId AS ID, 'Claim' AS ResourceType, DATE '2024-01-15' AS ExportDate FROM fresh""")
def inserted_keys(t: Tables):
    fresh = load.load_new(_work(t), _target(t), "claimId")
    return load.inserted_keys(fresh, "claimId", "Claim", dt.date(2024, 1, 15))


@query("q_load_report", _LOAD + """
SELECT 'fact_claim' AS target, (SELECT COUNT(*) FROM work) AS n_input, (SELECT COUNT(*) FROM work) - COUNT(*) AS n_duplicates,
       COUNT(*) AS n_inserted,
       (SELECT COUNT(*) FROM lineitem WHERE l_returnflag IS NOT NULL) AS n_errors, CAST(0 AS INTEGER) AS status FROM fresh""")
def load_report(t: Tables):
    """Every number of a load; the claim code of no row converts to a number."""
    work = _work(t)
    known = load.known_keys(work, _target(t), "claimId")
    fresh = load.load_new(work, _target(t), "claimId", known=known)
    errors = cast_rejects(work, {"claimCode": "int"}, "FAILED WHILE CREATING CLAIM", "claimId")
    counts = load.report_counts(work, known, fresh, errors, "claimId")
    return counts.select(F.lit("fact_claim").alias("target"), "*", F.lit(0).alias("status"))


@query("q_error_log", """
SELECT 'FAILED WHILE CREATING CLAIM' AS FILENAME, CAST(245 AS INTEGER) AS ERRORNUMBER,
       CAST(o_orderkey AS VARCHAR) || ': ' || x.c || ' does not convert to ' || x.k || ': ' || x.v AS ERRORMESSAGE
FROM orders, unnest([{'c': 'priority', 'k': 'int', 'v': o_orderpriority},
                     {'c': 'status', 'k': 'date', 'v': o_orderstatus}]) AS u(x)""")
def error_log(t: Tables):
    raw = t.orders.selectExpr(
        "CAST(o_orderkey AS STRING) AS claimId", "o_orderpriority AS priority", "o_orderstatus AS status",
        "CAST(CAST(o_orderdate AS DATE) AS STRING) AS created",
    )
    casts = {"priority": "int", "status": "date", "created": "date"}
    return cast_rejects(raw, casts, "FAILED WHILE CREATING CLAIM", "claimId").select(
        "FILENAME", "ERRORNUMBER", "ERRORMESSAGE"
    )


@query("q_distinct_all", "SELECT DISTINCT l_returnflag, l_linestatus, l_suppkey, l_linenumber FROM lineitem")
def distinct_all(t: Tables):
    return t.lineitem.select("l_returnflag", "l_linestatus", "l_suppkey", "l_linenumber").dropDuplicates()


@query("q_surrogate_key", """
SELECT 99 + row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS Id, o_orderdate, o_orderkey FROM orders""")
def surrogate_key(t: Tables):
    rows = t.orders.select("o_orderdate", "o_orderkey")
    return keys.assign_surrogate_key(rows, ["o_orderdate", "o_orderkey"], 100, stable=True)


# --- quality --------------------------------------------------------------------------


@query("q_dq_not_null", """
SELECT o_orderkey, l_linenumber FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey WHERE l_linenumber IS NULL""")
def dq_not_null(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_linenumber")
    df = t.orders.join(lines, F.expr("o_orderkey = l_orderkey"), "left").select("o_orderkey", "l_linenumber")
    return quality.null_rejects(df, ["o_orderkey", "l_linenumber"])


@query("q_dq_unique", """
SELECT l_orderkey, COUNT(*) AS n_rows FROM lineitem GROUP BY l_orderkey HAVING COUNT(*) > 1""")
def dq_unique(t: Tables):
    return quality.duplicate_keys(t.lineitem, "l_orderkey")


@query("q_dq_composite_unique", """
SELECT l_orderkey, l_linenumber, l_returnflag, COUNT(*) AS n_rows
FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1""")
def dq_composite_unique(t: Tables):
    return quality.duplicate_keys(t.lineitem, "l_orderkey", "l_linenumber", "l_returnflag")


@query("q_dq_length", """
SELECT doc_id AS "key", 'text' AS "column", CAST(length(text) AS INTEGER) AS length, CAST(250 AS INTEGER) AS "limit"
FROM documents WHERE length(text) > 250
UNION ALL SELECT doc_id, 'source', CAST(length(source) AS INTEGER), CAST(4 AS INTEGER)
FROM documents WHERE length(source) > 4""")
def dq_length(t: Tables):
    return quality.overlong(t.documents, {"text": 250, "source": 4}, "doc_id")
