"""Load scenarios: first load, rerun, mixed batch, bad input, logs, keys."""

from __future__ import annotations

import copy
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame
from plain import rows_of
from sample import BUNDLE, CLAIM, ENCOUNTER, MEDICATION, ORGANIZATION, PATIENT, PRACTITIONER

from clinloom.operators.keys import assign_surrogate_key, first_per_key, not_first_per_key
from clinloom.operators.load import counted_new, few_keys, import_log_rows, known_keys, load_new, looked_up_keys
from clinloom.plans import procedures as jobs
from clinloom.plans.views import register_views
from clinloom.sources.manifest import CommitRefused
from clinloom.sources.tables import TABLES
from clinloom.sources.warehouse import Warehouse
from clinloom.streaming import ingest
from clinloom.streaming.ingest import load_available

NOW = dt.datetime(2024, 11, 30, 12, 0)
DAY = NOW.date()


def write_bundle(folder, name, *entries):
    body = {"resourceType": "Bundle", "entry": [{"fullUrl": u, "resource": r} for u, r in entries]}
    (folder / name).write_text(json.dumps(body))


def renamed(entry, url, **fields):
    _, resource = copy.deepcopy(entry)
    return url, {**resource, **fields}


@pytest.fixture
def wh(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"))


@pytest.fixture
def inbox(tmp_path):
    folder = tmp_path / "inbox"
    folder.mkdir()
    return folder


def statuses(df):
    return {r.file_path.rsplit("/", 1)[1]: r.status for r in df.collect()}


def test_day_of_loads(spark, wh, inbox):
    write_bundle(inbox, "a.json", *BUNDLE, PRACTITIONER, MEDICATION)
    (inbox / "it's bad.json").write_text("{not json")
    (inbox / "scalar.json").write_text("5")
    (inbox / "empty.json").write_text('{"resourceType": "Bundle"}')
    got = statuses(jobs.import_json_files(wh, str(inbox), NOW))
    assert {k.replace("%20", " "): v for k, v in got.items()} == {
        "a.json": 1, "it's bad.json": 2, "scalar.json": 2, "empty.json": 1,
    }
    assert wh.read("import_error_logs").filter("ERRORNUMBER = 547").count() == 2

    reports = jobs.run_day(wh, DAY)
    assert all(r.status == 0 for r in reports.values()), rows_of(wh.read("import_error_logs"), "FILENAME", "ERRORMESSAGE")
    assert reports["claim"].n_inserted == 2
    assert reports["encounter"].n_inserted == 4
    assert (reports["encounter_treatments"].n_inserted, reports["encounter_treatments"].n_duplicates) == (0, 4)
    assert reports["medication_request"].n_inserted == 1
    assert reports["identification"].n_inserted == 1
    # two phones: one row stays, the other goes to the error log
    assert (reports["practitioner"].n_inserted, reports["practitioner"].n_errors) == (1, 1)
    assert reports["organization"].n_inserted == 1
    assert rows_of(wh.read("dim_practitioner"), "contactvalue") == [("555-0102",)]
    assert wh.read("import_error_logs").filter("ERRORNUMBER = 2627").count() == 1

    assert rows_of(wh.read("fact_claim"), "Id", "claimId", "itemSequence") in (
        [(10, "c1", 1), (11, "c1", 2)], [(10, "c1", 2), (11, "c1", 1)]
    )
    row = wh.read("fact_claim").first()
    assert row.claimbillablePeriodStart == dt.datetime(2020, 1, 1) and row.created_dt is not None
    assert rows_of(wh.read("fact_Identification"), "personNumber", "idNumber", "idShortCode") == [("p1", "mr-1", "MR")]
    # logged once per document, under the type that came first
    assert rows_of(wh.read("JSONImportLog"), "ID", "ResourceType") == [(100, "Encounter")]

    # the same files again: known by path; the rejected ones are tried again
    assert sorted(statuses(jobs.import_json_files(wh, str(inbox), NOW)).values()) == [2, 2, 3, 3]
    again = jobs.run_day(wh, DAY)
    assert all(r.n_inserted == 0 and r.status == 0 for r in again.values())
    assert again["claim"].n_duplicates == 2
    assert wh.read("JSONImportLog").count() == 1

    # a mixed batch on the next day: only the new keys
    write_bundle(inbox, "b.json", CLAIM, renamed(CLAIM, "urn:uuid:c2"), renamed(ENCOUNTER, "urn:uuid:e2"))
    tomorrow = NOW + dt.timedelta(days=1)
    jobs.import_json_files(wh, str(inbox), tomorrow)
    mixed = jobs.run_day(wh, tomorrow.date())
    assert (mixed["claim"].n_input, mixed["claim"].n_duplicates, mixed["claim"].n_inserted) == (4, 2, 2)
    assert sorted(r[0] for r in rows_of(wh.read("fact_claim"), "Id")) == [10, 11, 12, 13]
    assert mixed["encounter"].n_inserted == 4
    assert wh.read("JSONImportLog").count() == 2

    names = register_views(wh, as_of=dt.date(2024, 1, 1))
    assert "vw_claims_overview" in names
    assert spark.sql("SELECT claimCount FROM vw_claims_overview").first()[0] == 4
    assert spark.sql("SELECT count(*) FROM vw_claims_with_encounters").first()[0] == 8
    assert spark.sql("SELECT udf_RemoveNumericCharacters('Ann810')").first()[0] == "Ann"


def test_bad_values_are_logged(wh, inbox):
    bad_total = renamed(CLAIM, "urn:uuid:c3", total={"value": "lots", "currency": "USD"})
    no_patient = renamed(CLAIM, "urn:uuid:c4", patient={})
    write_bundle(inbox, "a.json", bad_total, no_patient)
    jobs.import_json_files(wh, str(inbox), NOW)
    jobs.split_documents(wh, DAY)
    report = jobs.json_claim_extract(wh, DAY)
    assert (report.status, report.n_input, report.n_inserted, report.n_errors) == (0, 4, 2, 4)
    assert rows_of(wh.read("fact_claim").distinct(), "claimId", "claimTotal")[0] == ("c3", None)
    numbers = rows_of(wh.read("import_error_logs"), "ERRORNUMBER")
    assert numbers == [(245,), (245,), (515,), (515,)]


def test_failing_job_reports(wh):
    # nothing was split for that day and the folder does not exist
    report = jobs.json_claim_extract(wh, DAY)
    assert (report.status, report.n_inserted) == (0, 0)
    broken = Warehouse(wh.spark, wh.root)
    broken.stage = lambda *a: (_ for _ in ()).throw(RuntimeError("disk is gone"))
    assert jobs.json_claim_extract(broken, DAY).status == 1
    assert rows_of(wh.read("import_error_logs"), "FILENAME", "ERRORNUMBER") == [
        ("FAILED WHILE CREATING CLAIM", 50000)
    ]


def test_recreate_all_then_import(wh, inbox):
    wh.recreate_all()
    write_bundle(inbox, "a.json", CLAIM)
    assert statuses(jobs.import_json_files(wh, str(inbox), NOW)) == {"a.json": 1}
    assert jobs.split_documents(wh, DAY).count() == 1
    # splitting a day again replaces its partitions
    assert jobs.split_documents(wh, DAY).count() == 1
    wh.recreate("JSONLogs")
    assert wh.read("JSONLogs").count() == 0


def test_recreate(wh, spark):
    wh.append("dim_payer", spark.createDataFrame([("x", "P")], "ID string, name string"))
    assert wh.read("dim_payer").filter("created_dt IS NOT NULL").count() == 1
    wh.recreate("dim_payer")
    assert wh.read("dim_payer").count() == 0
    wh.recreate("JSONLogs")
    assert wh.read("JSONLogs").count() == 0


def test_load_new_modes(spark):
    work = spark.createDataFrame(
        [("a", 1), ("b", 2), ("b", 2), ("b", 1), (None, 7), (None, 7)], "k string, v int"
    )
    target = spark.createDataFrame([("a",), ("z",), (None,)], "k string")
    assert rows_of(load_new(work, target, "k")) == sorted(
        [("b", 2), ("b", 2), ("b", 1), (None, 7), (None, 7)], key=repr
    )
    assert rows_of(load_new(work, target, "k", dedupe="rows")) == sorted(
        [("b", 2), ("b", 1), (None, 7)], key=repr
    )
    assert rows_of(load_new(work, target, "k", dedupe="key")) == sorted(
        [("b", 1), (None, 7), (None, 7)], key=repr
    )
    assert rows_of(known_keys(work, target, "k")) == [("a",)]
    with pytest.raises(ValueError):
        load_new(work, target, "k", dedupe="some")


def test_first_per_key_orders_nulls_first(spark):
    df = spark.createDataFrame([("a", None, 3), ("a", "x", 1), ("a", None, 3)], "k string, s string, n int")
    assert rows_of(first_per_key(df, "k")) == [("a", None, 3)]
    assert rows_of(not_first_per_key(df, "k")) == [("a", "x", 1)]


def test_import_log_once_per_document(spark):
    work = spark.createDataFrame([(1,), (1,), (2,), (None,)], "JsonLogsID bigint")
    log = spark.createDataFrame([(2, "Encounter")], "JSONLogsId bigint, ResourceType string")
    assert rows_of(import_log_rows(work, log, "MedicationRequest"), "JSONLogsId", "ResourceType") == [
        (1, "MedicationRequest")
    ]


@pytest.mark.parametrize("stable", [True, False])
def test_surrogate_key_with_a_hot_key(spark, stable):
    """A third of the rows are copies of one row, and still many partitions share them."""
    df = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 500 ELSE id END AS k")
    out = assign_surrogate_key(df, ["k"], 100, partitions=8, stable=stable)
    got = sorted(tuple(r) for r in out.collect())
    assert [g[0] for g in got] == list(range(100, 3100))
    assert [g[1] for g in got] == sorted(g[1] for g in got)
    assert out.filter("k = 500").selectExpr("spark_partition_id() AS p").distinct().count() > 1


def test_load_with_a_hot_key(spark):
    """One key holds a third of the rows, half of them copies."""
    work = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id) END AS k", "id % 2 AS v"
    )
    target = spark.createDataFrame([("k1",)], "k string")
    assert load_new(work, target, "k").count() == 2999
    assert load_new(work, target, "k", dedupe="rows").count() == 2001
    assert rows_of(load_new(work, target, "k", dedupe="key").filter("k = 'hot'")) == [("hot", 0)]
    assert load_new(work, spark.createDataFrame([("hot",)], "k string"), "k").count() == 2000


# What the writing passes tell, and what a lookup reads

def test_counts_of_copies_and_known_rows(spark, wh, inbox):
    """Known keys, copies, rows without a required value: the numbers add up without a count of their own."""
    write_bundle(inbox, "a.json", CLAIM, CLAIM, renamed(CLAIM, "urn:uuid:c4", patient={}))
    jobs.import_json_files(wh, str(inbox), NOW)
    jobs.split_documents(wh, DAY)
    first = jobs.json_claim_extract(wh, DAY)
    assert (first.n_input, first.n_duplicates, first.n_inserted, first.n_errors) == (6, 0, 2, 2)
    again = jobs.json_claim_extract(wh, DAY)
    assert (again.n_input, again.n_duplicates, again.n_inserted, again.n_errors) == (6, 4, 0, 2)


@pytest.mark.parametrize("dedupe", ["none", "rows", "key"])
def test_counted_new_agrees_with_load_new(spark, dedupe):
    work = spark.createDataFrame(
        [("a", 1), ("b", 2), ("b", 2), ("b", 1), (None, 7), (None, 7)], "k string, v int"
    )
    target = spark.createDataFrame([("a",), ("z",), (None,)], "k string")
    counted = counted_new(work, known_keys(work, target, "k"), "k", dedupe, "_n")
    assert rows_of(counted.drop("_n")) == rows_of(load_new(work, target, "k", dedupe=dedupe))
    assert counted.agg(F.sum("_n")).first()[0] == 5
    with pytest.raises(ValueError):
        counted_new(work, target, "k", "some", "_n")


def test_a_load_counts_nothing_apart(wh, inbox, monkeypatch):
    write_bundle(inbox, "a.json", ENCOUNTER)
    jobs.import_json_files(wh, str(inbox), NOW)
    jobs.split_documents(wh, DAY)
    real = Warehouse._with_key
    counted = []

    def keyed(self, name, table, rows, order, stable):
        monkeypatch.setattr(DataFrame, "count", count)
        try:
            return real(self, name, table, rows, order, stable)
        finally:
            monkeypatch.setattr(DataFrame, "count", lambda *_: counted.append(1) or 0)

    count = DataFrame.count
    monkeypatch.setattr(Warehouse, "_with_key", keyed)
    monkeypatch.setattr(DataFrame, "count", lambda *_: counted.append(1) or 0)
    report = jobs.json_encounter_extract(wh, DAY)
    monkeypatch.setattr(DataFrame, "count", count)
    assert report.n_inserted > 0 and not counted


def test_append_tells_broken_rules(spark, wh):
    rows = spark.createDataFrame([("x" * 101, "P"), (None, "Q"), ("z", None)], "ID string, name string")
    wh.append("dim_payer", rows)
    assert wh.broken["dim_payer"] == {"not null ID": 1, "length ID": 1}
    wh.append("dim_payer", rows.filter("name IS NULL"))
    assert wh.broken["dim_payer"] == {}


def _scanned(spark, df):
    """Rows that the file scans of ``df`` gave to the plan."""
    df.collect()
    rows, plans = 0, [df._jdf.queryExecution().executedPlan()]
    while plans:
        plan = plans.pop()
        if plan.nodeName().startswith("AdaptiveSparkPlan"):
            plans.append(plan.executedPlan())
            continue
        if plan.nodeName().endswith("QueryStage"):
            plans.append(plan.plan())
            continue
        if plan.nodeName().startswith("Scan"):
            rows += plan.metrics().apply("numOutputRows").value()
        children = plan.children()
        plans.extend(children.apply(i) for i in range(children.size()))
    return rows


def test_lookup_reads_what_the_batch_needs(spark, tmp_path):
    """Of sorted files only the pages that may hold a key of the batch are read."""
    n = 200_000
    path = str(tmp_path / "target")
    spark.range(n, numPartitions=1).selectExpr("md5(string(id)) AS k").sort("k").write.parquet(path)
    target = spark.read.parquet(path)
    spark.conf.set("spark.sql.parquet.pushdown.inFilterThreshold", "500")
    work = spark.createDataFrame([(row[0],) for row in spark.range(2).selectExpr("md5(string(id))").collect()] + [("none",), (None,)], "k string")
    keys = few_keys(work, "k", 3)
    assert few_keys(work, "k", 2) is None and len(keys) == 3
    few = looked_up_keys(keys, target, "k")
    assert rows_of(few) == rows_of(known_keys(work, target, "k")) and few.count() == 2
    assert _scanned(spark, few) < n // 3
    assert _scanned(spark, known_keys(work, target, "k")) > n // 3


# Commits

def _writes(wh, monkeypatch):
    """Counts the writes of a load and stops before the one of a given number."""
    made, stop = [], [None]
    for name in ("_write", "stage"):
        real = getattr(Warehouse, name)

        def guarded(self, *args, real=real, name=name, **kw):
            if len(made) == stop[0]:
                raise KeyboardInterrupt
            made.append(name)
            return real(self, *args, **kw)

        monkeypatch.setattr(Warehouse, name, guarded)
    publish = wh.manifest.publish

    def published(state):
        if len(made) == stop[0]:
            raise KeyboardInterrupt
        made.append("publish")
        publish(state)

    monkeypatch.setattr(wh.manifest, "publish", published)
    return made, stop


TABLES_OF_A_LOAD = ("fact_encounters", "JSONImportLog", "import_error_logs")


def test_killed_load_shows_nothing(spark, wh, inbox, monkeypatch):
    write_bundle(inbox, "a.json", ENCOUNTER, renamed(ENCOUNTER, "urn:uuid:e2", period={"start": "never"}))
    jobs.import_json_files(wh, str(inbox), NOW)
    jobs.split_documents(wh, DAY)
    made, stop = _writes(wh, monkeypatch)
    steps = 0
    while True:
        made.clear()
        stop[0] = steps
        reader = Warehouse(spark, wh.root)
        try:
            jobs.json_encounter_extract(wh, DAY)
        except KeyboardInterrupt:
            assert [reader.read(t).count() for t in TABLES_OF_A_LOAD] == [0, 0, 0]
            steps += 1
            continue
        break
    assert steps >= 6 and made[-1] == "publish"
    assert [reader.read(t).count() > 0 for t in TABLES_OF_A_LOAD] == [True] * 3
    stop[0] = None
    seen = [rows_of(reader.read(t)) for t in TABLES_OF_A_LOAD]
    folders = {f.name for f in (inbox.parent / "warehouse" / "fact_encounters").iterdir()}
    wh.remove_unpublished()
    left = {f.name for f in (inbox.parent / "warehouse" / "fact_encounters").iterdir()}
    assert left < folders and [rows_of(reader.read(t)) for t in TABLES_OF_A_LOAD] == seen


def test_second_writer_is_refused(spark, wh):
    other = Warehouse(spark, wh.root)
    rows = spark.createDataFrame([("f", 1)], "FILENAME string, ERRORNUMBER int")
    with pytest.raises(CommitRefused):
        with wh.transaction():
            wh.append("import_error_logs", rows)
            other.append("import_error_logs", rows.withColumn("FILENAME", F.lit("g")))
    assert rows_of(wh.read("import_error_logs"), "FILENAME") == [("g",)]
    wh.append("import_error_logs", rows)
    assert rows_of(other.read("import_error_logs"), "FILENAME") == [("f",), ("g",)]


def test_keys_go_on_without_reading_the_table(spark, wh, monkeypatch):
    rows = spark.createDataFrame([("a",), ("b",)], "FILENAME string")
    wh.append("import_error_logs", rows, ["FILENAME"])
    key, seed = TABLES["import_error_logs"].identity
    read = Warehouse.read
    monkeypatch.setattr(Warehouse, "read", lambda *_: pytest.fail("the table is read"))
    wh.append("import_error_logs", rows, ["FILENAME"])
    monkeypatch.setattr(Warehouse, "read", read)
    assert sorted(r[0] for r in wh.read("import_error_logs").select(key).collect()) == [seed, seed + 1, seed + 2, seed + 3]
    assert Warehouse(spark, wh.root).last_key("import_error_logs") == seed + 3
    wh.recreate("import_error_logs")
    assert wh.last_key("import_error_logs") is None and wh.read("import_error_logs").count() == 0


# Loads as a stream

LOADED = ("JSONLogs", "fact_claim", "fact_encounters", "JSONImportLog", "import_error_logs")


def test_stream_loads_each_batch_once(spark, wh, inbox, tmp_path, monkeypatch):
    write_bundle(inbox, "a.json", CLAIM, ENCOUNTER, renamed(CLAIM, "urn:uuid:c9", patient={}))
    checkpoint = tmp_path / "checkpoint"
    monkeypatch.setattr(ingest, "LOADS", {name: jobs.LOADS[name] for name in ("claim", "encounter")})
    write = Warehouse._write

    def dies(self, table, rows, path, *args, **kw):
        if "fact_encounters" in path:
            raise RuntimeError("executor lost")
        return write(self, table, rows, path, *args, **kw)

    # between the log and the data: nothing of the batch is seen
    monkeypatch.setattr(Warehouse, "_write", dies)
    with pytest.raises(Exception, match="executor lost"):
        load_available(wh, str(inbox), str(checkpoint), NOW).awaitTermination()
    monkeypatch.setattr(Warehouse, "_write", write)
    assert [wh.read(t).count() for t in LOADED] == [0] * 5

    # the batch comes again
    load_available(wh, str(inbox), str(checkpoint), NOW).awaitTermination()
    whole = [wh.read(t).count() for t in LOADED]
    assert all(whole)

    # published but not checkpointed: the same batch comes again and is passed over
    (checkpoint / "commits" / "0").unlink()
    (checkpoint / "commits" / ".0.crc").unlink(missing_ok=True)
    load_available(wh, str(inbox), str(checkpoint), NOW).awaitTermination()
    assert [wh.read(t).count() for t in LOADED] == whole

    # a new file with one known and one new claim
    write_bundle(inbox, "b.json", CLAIM, renamed(CLAIM, "urn:uuid:c2"))
    load_available(wh, str(inbox), str(checkpoint), NOW).awaitTermination()
    assert wh.read("fact_claim").count() == 2 * whole[1]
    # the day's load finds all of it loaded
    jobs.split_documents(wh, DAY)
    report = jobs.json_claim_extract(wh, DAY)
    assert (report.n_inserted, report.status) == (0, 0)
