"""CSV import and streaming ingest."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from plain import rows_of
from sample import CLAIM

from clinloom.functions.scalars import is_json_document
from clinloom.plans import procedures as jobs
from clinloom.plans.views import register_views
from clinloom.sources.files import read_csv
from clinloom.sources.warehouse import Warehouse
from clinloom.streaming.ingest import ingest_available

NOW = dt.datetime(2024, 11, 30, 12, 0)


@pytest.fixture
def wh(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"))


PATIENTS = """Id,BIRTHDATE,FIRST,LAST,GENDER,RACE,UNUSED
p1,2000-12-31,Ann810,Marks830,F,white,x
p2,not a date,Bo2,Lee1,M,asian,y
p3,1990-01-01,Cy,,M,asian,z
p1,1999-01-01,Ann,Other,F,white,x
p4,1980-05-05,Di,Poe
"""
HEADERS = {"Id": "ID", "BIRTHDATE": "DOB", "FIRST": "firstname", "LAST": "lastname"}


def test_csv_values_and_rejects(spark, tmp_path):
    path = tmp_path / "patients.csv"
    path.write_text(PATIENTS)
    rows, errors = read_csv(spark, str(path), "dim_patient", HEADERS)
    assert rows_of(rows, "ID", "DOB", "firstname", "race")[0] == ("p1", dt.date(1999, 1, 1), "Ann", "white")
    assert rows.count() == 4  # the short line is not loaded
    messages = [m for (m,) in rows_of(errors, "ERRORMESSAGE")]
    assert messages == ["DOB does not convert: not a date", "malformed line: p4,1980-05-05,Di,Poe"]


def test_csv_import_into_keyed_table(wh, tmp_path):
    path = tmp_path / "patients.csv"
    path.write_text(PATIENTS)
    report = jobs.import_csv(wh, str(path), "dim_patient", HEADERS)
    assert report.n_inserted == 1
    assert rows_of(wh.read("dim_patient"), "ID", "DOB", "lastname") == [("p1", dt.date(1999, 1, 1), "Other")]
    # two conversions/lines, two rows with a missing required value, one second row of p1
    assert rows_of(wh.read("import_error_logs"), "ERRORNUMBER") == [(245,), (245,), (2627,), (515,), (515,)]
    assert jobs.import_csv(wh, str(path), "dim_patient", HEADERS).n_inserted == 0


def test_csv_import_without_key(wh, tmp_path):
    path = tmp_path / "conditions.csv"
    path.write_text("START,STOP,PATIENT,ENCOUNTER,CODE,DESCRIPTION\n"
                    "2020-01-01,,p1,e1,44054006,Diabetes\n2020-01-01,,p1,e1,44054006,Diabetes\n")
    assert jobs.import_csv(wh, str(path), "dim_condition", {"STOP": "END"}).n_inserted == 2
    assert rows_of(wh.read("dim_condition"), "ID", "code", "START") == [
        (1, "44054006", dt.date(2020, 1, 1)), (2, "44054006", dt.date(2020, 1, 1))
    ]


def test_csv_composite_key(wh, tmp_path):
    path = tmp_path / "ec.csv"
    path.write_text("patientID,encounter_ID,condition_code\np1,e1,a\np1,e1,b\np1,e1,a\n")
    assert jobs.import_csv(wh, str(path), "fact_encounter_conditions").n_inserted == 2


def test_csv_own_header_per_file_and_quoted_breaks(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_text("ID,name,address\no1,First,1 Elm St\n")
    (folder / "b.csv").write_bytes("\ufeffname,ID\r\n\"Sec\nond \"\"x\"\"\",o2\r\n".encode())
    (folder / "c d.csv").write_text("name,ID\nThird,o3\n")
    rows, errors = read_csv(spark, str(folder), "dim_organization")
    assert rows_of(rows, "ID", "name", "address") == [
        ("o1", "First", "1 Elm St"), ("o2", 'Sec\nond "x"', None), ("o3", "Third", None)
    ]
    assert errors.count() == 0


BUNDLE = {"resourceType": "Bundle", "entry": [{"fullUrl": CLAIM[0], "resource": CLAIM[1]}]}
TEXTS = {
    "pretty.json": json.dumps(BUNDLE, indent=2), "crlf.json": json.dumps(BUNDLE, indent=1).replace("\n", "\r\n"),
    "marked.json": "\ufeff" + json.dumps(BUNDLE), "two.json": json.dumps(BUNDLE) + "\n" + json.dumps(BUNDLE),
}


def test_files_of_many_lines(wh, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    for name, text in TEXTS.items():
        (inbox / name).write_bytes(text.encode())
    status = jobs.import_json_files(wh, str(inbox), NOW)
    assert [(p.rsplit("/", 1)[1], s) for p, s in rows_of(status)] == [
        ("crlf.json", 1), ("marked.json", 1), ("pretty.json", 1), ("two.json", 2)
    ]
    assert wh.read("JSONLogs").count() == 4 and wh.read("import_error_logs").count() == 1
    assert [s for _, s in rows_of(jobs.import_json_files(wh, str(inbox), NOW))] == [3, 3, 3, 2]
    jobs.split_documents(wh, NOW.date())
    assert jobs.json_claim_extract(wh, NOW.date()).n_inserted == 2  # equal rows of three files
    assert not list((tmp_path / "warehouse" / "_staging").glob("fact_claim*"))


def test_views_follow_later_rows(wh, tmp_path):
    path = tmp_path / "ec.csv"
    path.write_text("patientID,encounter_ID,condition_code\np1,e1,a\n")
    register_views(wh)
    assert wh.spark.sql("SELECT * FROM fact_encounter_conditions").count() == 0
    jobs.import_csv(wh, str(path), "fact_encounter_conditions")
    assert wh.spark.sql("SELECT * FROM fact_encounter_conditions").count() == 1


def test_streamed_files_of_many_lines(wh, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "pretty.json").write_text(TEXTS["pretty.json"])
    ingest_available(wh, str(inbox), str(tmp_path / "checkpoint"), NOW).awaitTermination()
    assert rows_of(wh.read("JSONLogs"), "file_name", "status") == [("pretty.json", 1)]


@pytest.mark.parametrize("text, valid", [
    ('{"a":1}', True), (' [1, 2]\n', True), ('{"a":1} xyz', False), ('{"a":1}{"b":2}', False), ('{"a":1},{"b":2}', False),
    ('{"a":1,"a":2}', True), ('{"a":', False), ("5", False), ('"{}"', False), ("", False), (None, False), ("{}]", False),
    ('{"a":"' + "x" * 3_000_000 + '"}', True),
])
def test_json_gate(spark, text, valid):
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(is_json_document("t")).first()[0] is valid


def test_streaming_ingest_takes_each_file_once(wh, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    body = json.dumps({"entry": [{"fullUrl": CLAIM[0], "resource": CLAIM[1]}]})
    (inbox / "a.json").write_text(body)
    (inbox / "b.json").write_text("not json")
    checkpoint = str(tmp_path / "checkpoint")
    ingest_available(wh, str(inbox), checkpoint, NOW).awaitTermination()
    assert rows_of(wh.read("JSONLogs"), "file_name", "status") == [("a.json", 1), ("b.json", 2)]
    (inbox / "c.json").write_text(body)
    ingest_available(wh, str(inbox), checkpoint, NOW, max_files=1).awaitTermination()
    assert wh.read("JSONLogs").count() == 3
    # a batch whose commit was lost comes again and is passed over
    last = max(int(p.name) for p in (tmp_path / "checkpoint" / "commits").iterdir() if p.name.isdigit())
    for name in (str(last), f".{last}.crc"):
        (tmp_path / "checkpoint" / "commits" / name).unlink()
    ingest_available(wh, str(inbox), checkpoint, NOW).awaitTermination()
    assert wh.read("JSONLogs").count() == 3
    # a lost checkpoint: all files come again, the log keeps them out
    ingest_available(wh, str(inbox), str(tmp_path / "checkpoint2"), NOW, recheck=True).awaitTermination()
    assert wh.read("JSONLogs").count() == 3
    assert wh.read("JSONLogs").select("doc_id").distinct().count() == 3
    jobs.split_documents(wh, NOW.date())
    assert jobs.json_claim_extract(wh, NOW.date()).n_inserted == 2


def test_second_import_opens_new_files_only(wh, tmp_path, monkeypatch):
    inbox = tmp_path / "in box"
    inbox.mkdir()
    for i in range(5):
        (inbox / f"{i} [x]*.json").write_text(json.dumps(BUNDLE))
    monkeypatch.setattr(jobs, "FILES_AT_ONCE", 2)
    opened = []
    real = jobs.read_files

    def counted(spark, path, only):
        texts = real(spark, path, only)
        texts.collect()
        scan = texts._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
        opened.append(scan.metrics().apply("numFiles").value())
        return texts

    monkeypatch.setattr(jobs, "read_files", counted)
    assert [s for _, s in rows_of(jobs.import_json_files(wh, str(inbox), NOW))] == [1] * 5
    assert opened == [2, 2, 1]
    opened.clear()
    (inbox / "later.json").write_text("no json")
    assert [s for _, s in rows_of(jobs.import_json_files(wh, str(inbox), NOW))] == [3] * 5 + [2]
    assert opened == [1]
    assert wh.read("JSONLogs").select("doc_id").distinct().count() == 6
