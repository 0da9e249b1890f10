"""Shredding rules: levels, kinds of nodes, indexes, scalars."""

from __future__ import annotations

import copy
import datetime as dt
from decimal import Decimal

import pytest
from plain import rows_of
from sample import BUNDLE, CLAIM, ENCOUNTER, MEDICATION, PATIENT, PRACTITIONER

from clinloom.operators.resources import (
    extract_care_plan, extract_claim, extract_encounter, extract_encounter_treatments,
    extract_identifier, extract_medication_request, extract_organization, extract_patient,
    extract_person, extract_practitioner,
)
from clinloom.operators.resources.claim import claim_rows
from clinloom.functions.scalars import is_json_document
from clinloom.operators.shred import explode_entries, leaf, node, rows, shape, tabulate


def changed(entry, **fields):
    url, resource = copy.deepcopy(entry)
    for k, v in fields.items():
        if v is None:
            resource.pop(k, None)
        else:
            resource[k] = v
    return url, resource


def test_entries(bundle_of, spark):
    docs = bundle_of(BUNDLE, [])
    assert explode_entries(docs).count() == 5  # 4 + one NULL row for the empty bundle
    assert rows_of(explode_entries(docs, "Claim"), "doc_id", "fullUrl") == [(1, "urn:uuid:c1")]
    assert rows_of(explode_entries(docs, "Claim", "Patient"), "resourceType") == [("Claim",), ("Patient",)]


def test_entries_of_unusual_documents(spark):
    docs = spark.createDataFrame(
        [
            (1, '{"entry": {"fullUrl": "a", "resource": {"resourceType": "Claim"}}}'),
            (2, '[{"entry": [{"fullUrl": "b", "resource": {"resourceType": "Claim"}}]}, {"x": 1}]'),
            (3, '{"resourceType": "Bundle"}'),
            (4, '{"entry": [{"fullUrl": "c", "resource": 5}, {"fullUrl": {"x": 1}, "resource": {"resourceType": "Claim"}}]}'),
        ],
        "doc_id bigint, json string",
    )
    assert rows_of(explode_entries(docs), "doc_id", "fullUrl", "resourceType") == sorted(
        [(1, "a", "Claim"), (2, "b", "Claim"), (3, None, None), (4, "c", None), (4, None, "Claim")],
        key=repr,
    )


def test_peek_ignores_nested_type(spark):
    docs = spark.createDataFrame(
        [(1, '{"entry":[{"fullUrl":"x","resource":{"contained":[{"resourceType":"Claim"}],"resourceType":"Other"}}]}')],
        "doc_id bigint, json string",
    )
    assert explode_entries(docs, "Claim").count() == 0


LEVELS = shape(leaf("id"), rows("a", leaf("x"), node("n", leaf("y"))), node("o", leaf("z")))


@pytest.mark.parametrize(
    "text, expected",
    [
        ('{"id":"i","a":[{"x":1,"n":{"y":2}}],"o":{"z":3}}', [("i", "1", "2", "3")]),
        ('{"id":"i"}', [("i", None, None, None)]),
        ('{"id":"i","a":[]}', [("i", None, None, None)]),
        # object where an array is usual: one row
        ('{"id":"i","a":{"x":1,"n":{"y":2}}}', [("i", "1", "2", None)]),
        # array where an object is usual: a row per element
        ('{"id":"i","o":[{"z":3},{"z":4}]}', [("i", None, None, "3"), ("i", None, None, "4")]),
        ('{"id":"i","a":[{"x":1,"n":[{"y":2},{"y":3}]},{"x":4}]}',
         [("i", "1", "2", None), ("i", "1", "3", None), ("i", "4", None, None)]),
        # scalar where a level is expected: one row of NULLs
        ('{"id":"i","a":5,"o":"t"}', [("i", None, None, None)]),
        ('{"id":"i","a":[{"x":1},5]}', [("i", "1", None, None), ("i", None, None, None)]),
        ('{"id":"i","o":[],"a":[{"x":"7"}]}', [("i", "7", None, None)]),
    ],
)
def test_node_kinds(spark, text, expected):
    df = spark.createDataFrame([(text,)], "resource string")
    out = tabulate(df, LEVELS, "a")
    assert rows_of(out, "id", "a_x", "a_n_y", "o_z") == sorted(expected, key=repr)


def test_sample_counts(bundle_of):
    entries = explode_entries(bundle_of(BUNDLE)).cache()
    assert extract_claim(entries).count() == 4
    assert extract_claim(entries).distinct().count() == 2
    assert extract_claim(entries, repeats=False).count() == 2
    assert extract_encounter(entries).count() == 4
    assert extract_identifier(entries).count() == 1
    assert extract_patient(entries).count() == 4
    assert extract_organization(entries).count() == 1
    entries.unpersist()


def test_claim_values(bundle_of):
    row = extract_claim(explode_entries(bundle_of([CLAIM]), "Claim")).orderBy("itemSequence").first()
    assert row.claimId == "c1" and row.claimPatientId == "p1" and row.encounterId == "e1"
    assert row.claimbillablePeriodStart == dt.date(2020, 1, 1)
    assert row.claimbillablePeriodEnd == dt.date(2020, 1, 2)
    assert row.claimTotal == Decimal("129.1600") and row.claimFocal is True
    assert row.claimProviderReference == "Organization?identifier=sys|o1"
    assert (row.claimCode, row.claimPriorityCode, row.itemSequence) == ("institutional", "normal", 1)


def test_claim_without_date_cast(bundle_of):
    entries = explode_entries(bundle_of([CLAIM]), "Claim")
    row = extract_claim(entries, cast_dates=False).first()
    assert row.claimCreated == "2020-01-02T00:30:00-05:00"


def test_lax_scalars(bundle_of):
    odd = changed(CLAIM, status={"x": 1}, use=["claim"], patient="p1", created="[a] text")
    odd[1]["total"] = {"value": "12.5", "currency": "USD"}
    odd[1]["insurance"] = {"sequence": "3", "focal": "true"}
    row = claim_rows(explode_entries(bundle_of([odd]), "Claim")).first()
    assert row.claimStatus is None and row.claimUse is None and row.claimPatientId is None
    assert row.claimCreated == "[a] text"
    typed_row = extract_claim(explode_entries(bundle_of([odd]), "Claim")).first()
    assert typed_row.claimTotal == Decimal("12.5000")
    assert (typed_row.insuranceSequence, typed_row.claimFocal) == (3, True)
    assert typed_row.claimCreated is None


def test_index_paths(bundle_of):
    odd = changed(PATIENT, name=[{"family": "F", "given": [], "prefix": "Ms."}])
    row = extract_person(explode_entries(bundle_of([odd]), "Patient")).first()
    assert (row.family, row.given, row.prefix) == ("F", None, None)
    # an index into something that is not an array reads as NULL
    item = {"sequence": 1, "encounter": {"reference": "urn:uuid:e9"}}
    row = extract_claim(explode_entries(bundle_of([changed(CLAIM, item=[item])]), "Claim")).first()
    assert (row.itemSequence, row.encounterId) == (1, None)


def test_encounter_values(bundle_of):
    got = rows_of(
        extract_encounter(explode_entries(bundle_of([ENCOUNTER]), "Encounter")),
        "JsonLogsID", "encounterID", "start", "end", "organizationID", "practitionerID", "encounter_code",
    )
    day = dt.date(2020, 1, 1), dt.date(2020, 1, 2)
    assert got == sorted(
        [(1, "e1", *day, "o1", p, c) for p in ("d1", "urn:uuid:d2") for c in ("185345009", "x2")], key=repr
    )


def test_encounter_subject_as_array(bundle_of):
    odd = changed(ENCOUNTER, subject=[{"reference": "urn:uuid:p1"}, {"reference": "urn:uuid:p2"}], participant=None)
    got = rows_of(extract_encounter(explode_entries(bundle_of([odd]), "Encounter")), "patientID", "encounter_code")
    assert len(got) == 4 and {g[0] for g in got} == {"p1", "p2"}


def test_treatments(bundle_of):
    with_reasons = changed(
        ENCOUNTER, participant=None, reasonCode=[{"coding": [{"code": "1"}, {"code": "2"}]}],
        serviceProvider={"reference": "urn:uuid:o|1"},
    )
    got = extract_encounter_treatments(explode_entries(bundle_of([with_reasons]), "Encounter"))
    assert got.count() == 4 and "encounterReasonCode" not in got.columns
    row = got.first()
    assert row.start == "2020-01-01T23:30:00-05:00" and row.organizationID == "o|1"
    timed = extract_encounter_treatments(explode_entries(bundle_of([with_reasons]), "Encounter"), cast_times=True)
    assert timed.first().start == dt.datetime(2020, 1, 1, 23, 30)


def test_medication(bundle_of):
    entries = explode_entries(bundle_of([MEDICATION]), "MedicationRequest")
    row = extract_medication_request(entries).first()
    assert row.patientId == "urn:uuid:p1" and row.encounterID == "urn:uuid:e1" and row.doctorID == "d1"
    assert row.conditionThatCausedMedicationRequest == "Diabetes" and row.dosageQuantity is None
    assert (row.frequency, row.period, row.periodUnit, row.asNeededBoolean) == (2, 1.0, "d", False)
    assert extract_medication_request(entries, "instruction").first().dosageQuantity == 1.5


def test_practitioner_and_person(bundle_of):
    entries = explode_entries(bundle_of([PRACTITIONER, PATIENT]), "Practitioner", "Patient")
    assert extract_practitioner(entries).count() == 2
    assert rows_of(extract_practitioner(entries), "address")[0] == ("3 Ash St,US",)
    assert extract_person(entries).count() == 3
    no_country = changed(PRACTITIONER, address=[{"line": ["x"]}])
    only = extract_practitioner(explode_entries(bundle_of([no_country]), "Practitioner"))
    assert rows_of(only, "address")[0] == (None,)


def test_patient_race_of_every_extension(bundle_of):
    got = rows_of(extract_patient(explode_entries(bundle_of([PATIENT]), "Patient")), "race", "maritalValue", "languageSpoken")
    assert got.count(("White", "M", "English")) == 2 and got.count((None, "M", "English")) == 2


def test_care_plan_chain(bundle_of):
    plan = ("urn:uuid:k1", {
        "resourceType": "CarePlan", "id": "k1", "status": "active", "intent": "order",
        "subject": {"reference": "urn:uuid:p1"}, "encounter": {"reference": "urn:uuid:e1"},
        "period": {"start": "2020"}, "careTeam": [{"reference": "urn:uuid:t1"}],
        "category": [{"coding": [{"system": "s", "code": "c", "display": "d"}]}],
        "activity": [
            {"detail": {"status": "on", "location": {"display": "L"},
                        "code": {"text": "T", "coding": [{"code": "1"}, {"code": "2"}]}}},
            {"detail": {"status": "off"}},
        ],
    })
    got = rows_of(
        extract_care_plan(explode_entries(bundle_of([plan]), "CarePlan")),
        "careTeamID", "activityDetailStatus", "activityDetailText", "activityCodingCode",
    )
    assert got == sorted([("t1", "on", "T", "1"), ("t1", "on", "T", "2"), ("t1", "off", None, None)], key=repr)


def test_strings_of_any_length(spark):
    long = "concat('{\"entry\":[{\"fullUrl\":\"urn:uuid:c\",\"resource\":{\"resourceType\":\"Claim\",\"status\":\"', repeat('x', 25000000), '\",\"use\":\"claim\"}}]}')"
    docs = spark.range(1).selectExpr("id AS doc_id", f"{long} AS json")
    assert docs.select(is_json_document("json")).first()[0]
    entries = explode_entries(docs)
    assert rows_of(entries, "fullUrl", "resourceType") == [("urn:uuid:c", "Claim")]
    row = claim_rows(entries).selectExpr("claimId", "length(claimStatus) AS n", "claimUse").first()
    assert tuple(row) == ("c", 25_000_000, "claim")


def test_repeated_keys_and_exact_numbers_in_unusual_nodes(spark):
    text = '{"a":{"v":1,"v":12345678901234567890.1234567890},"o":[{"w":0.10},{"w":"x"}]}'
    df = spark.createDataFrame([(text,)], "resource string")
    out = tabulate(df, shape(rows("a", leaf("v")), node("o", leaf("w"))), "a")
    assert rows_of(out, "a_v", "o_w") == [("12345678901234567890.123456789", "0.1"), ("12345678901234567890.123456789", "x")]


def test_a_resource_is_read_once_whatever_levels_open(spark):
    schema = shape(leaf("a"), rows("item", leaf("s"), node("prod", rows("coding", leaf("code")))), rows("other", leaf("x")))
    df = spark.createDataFrame([("{}",)], "resource string")
    out = tabulate(df, schema, "item", "item.prod.coding", "other")
    plan = out._jdf.queryExecution().analyzed().toString().splitlines()
    opened = [line for line in plan if "Generate" in line]
    assert len(opened) == 4 and not [line for line in opened if "variant" in line]


def test_kinds_are_told_apart_below_opened_levels(spark):
    text = (
        '{"a":"{x","item":[{"s":"[1]","prod":{"coding":[{"code":"{"}]}},{"s":{"z":1},"prod":[{"coding":{"code":1.0}},{"coding":[]}]},'
        '{"s":[1]},5],"other":{"x":2}}'
    )
    df = spark.createDataFrame([(text,)], "resource string")
    schema = shape(leaf("a"), rows("item", leaf("s"), node("prod", rows("coding", leaf("code")))), rows("other", leaf("x")))
    out = tabulate(df, schema, "item", "item.prod.coding", "other")
    assert rows_of(out, "a", "item_s", "item_prod_coding_code", "other_x") == sorted(
        [("{x", "[1]", "{", "2"), ("{x", None, "1", "2"), ("{x", None, None, "2"), ("{x", None, None, "2"), ("{x", None, None, "2")], key=repr
    )
