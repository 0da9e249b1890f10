"""The jobs: import files, split documents into entries, load each resource."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from itertools import islice

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.operators.documents import ALREADY_THERE, FAILED, IMPORTED
from clinloom.operators.keys import not_first_per_key
from clinloom.operators.load import (
    LoadReport, counted_new, few_keys, import_log_rows, known_keys, load_new, looked_up_keys,
)
from clinloom.operators.quality import null_rejects, without_nulls
from clinloom.operators.resources.benefit import BENEFIT_CASTS, benefit_rows
from clinloom.operators.resources.claim import CLAIM_CASTS, claim_rows
from clinloom.operators.resources.encounter import (
    ENCOUNTER_CASTS, TREATMENT_CASTS, encounter_rows, treatment_rows,
)
from clinloom.operators.resources.medication import MEDICATION_CASTS, medication_rows
from clinloom.operators.resources.organization import extract_organization
from clinloom.operators.resources.person import extract_identifier, extract_practitioner
from clinloom.operators.shred import explode_entries
from clinloom.operators.typed import (
    DUPLICATE_KEY, JOB_FAILED, NOT_JSON, NULL_NOT_ALLOWED, cast_rejects, error_rows, typed,
)
from clinloom.sources.files import as_documents, list_files, read_csv, read_files
from clinloom.sources.tables import TABLES
from clinloom.sources.warehouse import Warehouse

FILES_AT_ONCE = 10_000  # names that the driver holds and a commit takes
KEYS_LOOKED_UP = 500  # a batch of more keys is compared with the target by a join
ROWS_LOOKED_AT = 100 * KEYS_LOOKED_UP  # in larger batches the keys are not counted first
_COPIES = "_copies"

# --- files -> documents -> entries ---------------------------------------------


def import_json_files(wh: Warehouse, path: str, run_ts: dt.datetime | None = None) -> DataFrame:
    """Import the files below ``path``; status per file.

    Files the log holds already are known by their full path. The folder is listed first and
    only new files are opened, ``FILES_AT_ONCE`` of them in one commit, so an import that
    dies goes on where it stopped. Valid and rejected documents are written in
    one pass, into separate partitions.
    """
    run_ts = run_ts or dt.datetime.now()
    # Fixed before anything is written: the log grows during this very job.
    listed = wh.stage(
        list_files(wh.spark, path).join(
            wh.read("JSONLogs").filter(F.col("status") == IMPORTED).select("file_path")
            .withColumn("_known", F.lit(True)),
            "file_path", "left",
        ),
        "files",
    )
    first_id = next_document(wh)
    names = (r.file_path for r in listed.filter("_known IS NULL").select("file_path").toLocalIterator())
    while group := list(islice(names, FILES_AT_ONCE)):
        import_documents(wh, read_files(wh.spark, path, group), run_ts)
    written = _documents_since(wh, run_ts, first_id)
    return (
        listed.join(written.select("file_path", F.col("status").alias("_status")), "file_path", "left")
        .select("file_path", F.when(F.col("_known"), ALREADY_THERE).otherwise(F.col("_status")).alias("status"))
    )


def import_documents(
    wh: Warehouse, files: DataFrame, run_ts: dt.datetime, batch: str | None = None
) -> DataFrame:
    """Append texts to the document log and log the rejected, in one commit; path and status."""
    with wh.transaction():
        first_id = next_document(wh)
        wh.append("JSONLogs", as_documents(files, run_ts, first_id, batch))
        rejected = _documents_since(wh, run_ts, first_id).filter(F.col("status") == FAILED)
        _log_errors(
            wh, error_rows(rejected, F.col("file_path"), NOT_JSON, F.lit("the file is not a JSON object or array"))
        )
    return _documents_since(wh, run_ts, first_id)


def next_document(wh: Warehouse) -> int:
    return (wh.last_key("JSONLogs") or 0) + 1


def _documents_since(wh: Warehouse, run_ts: dt.datetime, first_id: int) -> DataFrame:
    return wh.read("JSONLogs").filter(
        (F.col("import_date") == F.lit(run_ts.date())) & (F.col("doc_id") >= first_id)
    ).select("file_path", "status")


def documents_since(wh: Warehouse, run_ts: dt.datetime, first_id: int) -> DataFrame:
    """The JSON documents that an import at ``run_ts`` has added from ``first_id`` on."""
    return wh.read("JSONLogs").filter(
        (F.col("status") == IMPORTED) & (F.col("import_date") == F.lit(run_ts.date())) & (F.col("doc_id") >= first_id)
    ).select("doc_id", "file_path", "import_date", "json")


def split_documents(wh: Warehouse, run_date: dt.date | None = None) -> DataFrame:
    """Parse the day's documents into entries, replacing that day's partitions.

    Done once, so that each of the loads below reads only its resource type
    instead of parsing every document again.
    """
    day = run_date or dt.date.today()
    docs = (
        wh.read("JSONLogs")
        .filter((F.col("status") == IMPORTED) & (F.col("import_date") == F.lit(day)))
        .select("doc_id", "file_path", "import_date", "json")
    )
    wh.replace_partitions(
        "bundle_entries", explode_entries(docs).filter(F.col("resource").isNotNull())
    )
    return day_entries(wh, day)


def day_entries(wh: Warehouse, run_date: dt.date | None = None) -> DataFrame:
    day = run_date or dt.date.today()
    return wh.read("bundle_entries").filter(F.col("import_date") == F.lit(day))


# --- entries -> tables --------------------------------------------------------------


@dataclass(frozen=True)
class Load:
    """How one resource reaches its table."""

    target: str
    rows: Callable[[DataFrame], DataFrame]
    key: str
    stage: str
    target_key: str | None = None
    casts: Mapping[str, str] = field(default_factory=dict)
    dedupe: str = "none"
    log_as: str | None = None


# Natural keys, stage texts of the error log, logged types.
LOADS = {
    "claim": Load(
        "fact_claim", lambda e: claim_rows(e, repeats=False), "claimId",
        "FAILED WHILE CREATING CLAIM", casts=CLAIM_CASTS, dedupe="rows",
    ),
    "encounter": Load(
        "fact_encounters", encounter_rows, "encounterID", "FAILED WHILE CREATING ENCOUNTERS",
        target_key="encounter_ID", casts=ENCOUNTER_CASTS, log_as="Encounter",
    ),
    "encounter_treatments": Load(
        "fact_encounters", treatment_rows, "encounterID", "FAILED WHILE CREATING TREATMENTS",
        target_key="encounter_ID", casts=TREATMENT_CASTS,
    ),
    "medication_request": Load(
        "fact_medication_request", medication_rows, "medicationRequestID",
        "FAILED WHILE CREATING MEDICATION REQUESTS", casts=MEDICATION_CASTS,
        log_as="MedicationRequest",
    ),
    "identification": Load(
        "fact_Identification", extract_identifier, "personNumber",
        "FAILED WHILE CREATING IDENTIFICATION", dedupe="rows",
    ),
    "practitioner": Load(
        "dim_practitioner", extract_practitioner, "ID", "FAILED WHILE CREATING PRACTITIONER",
        dedupe="key",
    ),
    "organization": Load(
        "dim_organization", lambda e: extract_organization(e, repeats=False), "organizationID",
        "FAILED WHILE CREATING ORGANIZATION", target_key="ID", dedupe="key",
    ),
    "explanation_of_benefit": Load(
        "fact_EplanationOfBenefit", benefit_rows, "ExplanationOfBenefitId",
        "FAILED WHILE CREATING EXPLANATION OF BENEFIT", casts=BENEFIT_CASTS,
    ),
}


def load_resource(wh: Warehouse, name: str, run_date: dt.date | None = None) -> LoadReport:
    """Load one resource of a day; never raises, a failure is logged and reported."""
    spec = LOADS[name]
    try:
        with wh.transaction():
            return load_entries(wh, spec, day_entries(wh, run_date))
    except Exception as error:  # any failure of the job belongs in the error log
        message = wh.spark.range(1).select(F.lit(str(error)).alias("m"))
        wh.append("import_error_logs", error_rows(message, spec.stage, JOB_FAILED, F.col("m")))
        return LoadReport(spec.target, n_errors=1, status=1)
    finally:
        wh.drop_staged()


def load_entries(wh: Warehouse, spec: Load, entries: DataFrame) -> LoadReport:
    """Load the resource's rows of ``entries``; its numbers come from the passes that write."""
    table = TABLES[spec.target]
    key = spec.target_key or spec.key
    # Written once: everything below reads these rows, the JSON is not parsed again.
    text, read = wh.stage_counted(spec.rows(entries), spec.target, {"n_input": F.count(F.lit(1))})
    work = typed(text, spec.casts)
    if spec.target_key:
        work = work.withColumnRenamed(spec.key, spec.target_key)
    target = wh.read(spec.target)
    complete = without_nulls(work, table.required)
    keys = few_keys(complete, key, KEYS_LOOKED_UP) if read["n_input"] <= ROWS_LOOKED_AT else None
    known = known_keys(complete, target, key) if keys is None else looked_up_keys(keys, target, key)
    # How many rows are inserted, and how many rows of the batch these stand for.
    fresh, new = wh.stage_counted(
        counted_new(complete, known, key, spec.dedupe, _COPIES), f"{spec.target}-new",
        {"n_inserted": F.count(F.lit(1)), "n_rows": F.sum(_COPIES)}, without=(_COPIES,),
    )

    errors = cast_rejects(text, spec.casts, spec.stage, spec.key) if spec.casts else None
    incomplete = null_rejects(work, table.required)
    nulls = error_rows(
        incomplete, spec.stage, NULL_NOT_ALLOWED,
        F.concat(F.lit("a required column is NULL, key "), F.coalesce(F.col(key), F.lit("NULL"))),
    )
    errors = nulls if errors is None else errors.unionByName(nulls)
    if spec.dedupe == "key":
        errors = errors.unionByName(_further_rows(complete, fresh, key, spec.stage))
    n_errors, n_incomplete = _log_errors(wh, errors)
    if spec.log_as:
        log = import_log_rows(fresh, wh.read("JSONImportLog"), spec.log_as)
        wh.append("JSONImportLog", log, ["JSONLogsId"])
    wh.append(spec.target, fresh, [key], stable=True)
    return LoadReport(
        spec.target,
        n_input=read["n_input"],
        n_duplicates=read["n_input"] - n_incomplete - new["n_rows"],
        n_inserted=new["n_inserted"],
        n_errors=n_errors,
    )


def _further_rows(complete: DataFrame, fresh: DataFrame, key: str, stage: str) -> DataFrame:
    """Error rows for what a load of one row per key leaves out; known keys are no error."""
    new_keys = complete.join(fresh.select(key), key, "left_semi").select(*complete.columns)
    return error_rows(
        not_first_per_key(new_keys, key), stage, DUPLICATE_KEY, F.concat(F.lit("more than one row for key "), F.col(key))
    )


def _log_errors(wh: Warehouse, errors: DataFrame) -> tuple[int, int]:
    """Number of errors, and of those on a missing required column (one a row)."""
    staged, seen = wh.stage_counted(errors, "errors", {
        "n": F.count(F.lit(1)), "n_null": F.count_if(F.col("ERRORNUMBER") == NULL_NOT_ALLOWED),
    })
    if seen["n"]:
        wh.append("import_error_logs", staged, ["FILENAME"], stable=True)
    return seen["n"], seen["n_null"]


# --- the public jobs, one per resource ------------------------------------------------


def json_claim_extract(wh: Warehouse, run_date: dt.date | None = None) -> LoadReport:
    return load_resource(wh, "claim", run_date)


def json_encounter_extract(wh: Warehouse, run_date: dt.date | None = None) -> LoadReport:
    return load_resource(wh, "encounter", run_date)


def json_encounter_treatments_extract(wh: Warehouse, run_date: dt.date | None = None) -> LoadReport:
    return load_resource(wh, "encounter_treatments", run_date)


def json_medication_request_extract(wh: Warehouse, run_date: dt.date | None = None) -> LoadReport:
    return load_resource(wh, "medication_request", run_date)


def json_identification_extract(wh: Warehouse, run_date: dt.date | None = None) -> LoadReport:
    return load_resource(wh, "identification", run_date)


def json_practitioner_extract(wh: Warehouse, run_date: dt.date | None = None) -> LoadReport:
    return load_resource(wh, "practitioner", run_date)


def json_organization_extract(wh: Warehouse, run_date: dt.date | None = None) -> LoadReport:
    return load_resource(wh, "organization", run_date)


def json_explanation_of_benefit_extract(wh: Warehouse, run_date: dt.date | None = None) -> LoadReport:
    return load_resource(wh, "explanation_of_benefit", run_date)


def run_day(wh: Warehouse, run_date: dt.date | None = None) -> dict[str, LoadReport]:
    """All loads of a day. Treatments come after encounters and add what is missing."""
    split_documents(wh, run_date)
    return {name: load_resource(wh, name, run_date) for name in LOADS}


def import_csv(wh: Warehouse, path: str, table: str, rename: Mapping[str, str] | None = None) -> LoadReport:
    """Load a CSV file into a table; rows of a known key are left out.

    A table without a declared key takes every row.
    """
    with wh.transaction():
        report = _csv(wh, path, table, rename)
    wh.drop_staged()
    return report


def _csv(wh: Warehouse, path: str, table: str, rename: Mapping[str, str] | None) -> LoadReport:
    spec = TABLES[table]
    rows, errors = read_csv(wh.spark, path, table, rename)
    work, read = wh.stage_counted(rows, table, {"n_input": F.count(F.lit(1))})
    complete = without_nulls(work, spec.required)
    stage = f"FAILED WHILE READING CSV {table}"
    errors = errors.unionByName(error_rows(
        null_rejects(work, spec.required), stage, NULL_NOT_ALLOWED, F.lit("a required column is NULL")
    ))
    fresh, new = complete, None
    if spec.unique:
        # One text for a key of several columns.
        key = "_natural_key"
        keyed = complete.withColumn(key, F.to_json(F.array(*spec.unique)))
        known = wh.read(table).withColumn(key, F.to_json(F.array(*spec.unique)))
        kept, new = wh.stage_counted(
            load_new(keyed, known, key, dedupe="key"), f"{table}-new", {"n_inserted": F.count(F.lit(1))}
        )
        errors = errors.unionByName(_further_rows(keyed, kept, key, stage))
        fresh = kept.drop(key)
    n_errors, n_incomplete = _log_errors(wh, errors)
    n_complete = read["n_input"] - n_incomplete
    n_inserted = new["n_inserted"] if new else n_complete
    wh.append(table, fresh, [spec.unique[0] if spec.unique else spec.required[0]], stable=True)
    return LoadReport(table, read["n_input"], n_complete - n_inserted, n_inserted, n_errors)
