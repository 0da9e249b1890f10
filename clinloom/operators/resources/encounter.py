"""Encounter: one row per type coding x participant x reason coding."""

from __future__ import annotations

from pyspark.sql import DataFrame

from clinloom.operators.resources.columns import (
    document_id, named, own_id, stripped, tail_after_pipe,
)
from clinloom.operators.shred import coding, leaf, node, obj, of_type, rows, shape, tabulate
from clinloom.operators.typed import typed

ENCOUNTER = shape(
    obj("class", leaf("code")),
    rows("type", coding("code", "display")),
    node("subject", leaf("reference")),
    node("period", leaf("start", "end")),
    rows("participant", node("individual", leaf("reference"))),
    rows("reasonCode", coding("code", "display")),
    node("serviceProvider", leaf("reference")),
)

ENCOUNTER_CASTS = {"start": "date", "end": "date"}
TREATMENT_CASTS = {"start": "timestamp", "end": "timestamp"}


def _encounters(entries: DataFrame) -> DataFrame:
    return tabulate(
        of_type(entries, "Encounter"), ENCOUNTER,
        "type", "type.coding", "participant", "reasonCode", "reasonCode.coding",
    )


def encounter_rows(entries: DataFrame) -> DataFrame:
    """Text rows of all encounters, with the id of their document."""
    return _encounters(entries).select(
        *named(
            JsonLogsID=document_id(entries),
            encounterID=own_id(),
            start="period_start",
            end="period_end",
            patientID=stripped("subject_reference"),
            organizationID=tail_after_pipe("serviceProvider_reference"),
            practitionerID=tail_after_pipe("participant_individual_reference"),
            encounter_class="class_code",
            encounter_code="type_coding_code",
            encounter_description="type_coding_display",
            encounterReasonName="reasonCode_coding_display",
            encounterReasonCode="reasonCode_coding_code",
        )
    )


def extract_encounter(entries: DataFrame) -> DataFrame:
    return typed(encounter_rows(entries), ENCOUNTER_CASTS)


def treatment_rows(entries: DataFrame) -> DataFrame:
    """Encounters with whole references and times, without reasons.

    Reasons appear in no column but still repeat rows.
    """
    return _encounters(entries).select(
        *named(
            encounterID=own_id(),
            start="period_start",
            end="period_end",
            patientID=stripped("subject_reference"),
            organizationID=stripped("serviceProvider_reference"),
            practitionerID=stripped("participant_individual_reference"),
            encounter_class="class_code",
            encounter_code="type_coding_code",
            encounter_description="type_coding_display",
        )
    )


def extract_encounter_treatments(entries: DataFrame, cast_times: bool = False) -> DataFrame:
    """Times stay text unless asked; the loader stores the local date and time."""
    df = treatment_rows(entries)
    return typed(df, TREATMENT_CASTS) if cast_times else df
