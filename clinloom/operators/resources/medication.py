"""MedicationRequest: one row per medication coding x dosage instruction."""

from __future__ import annotations

from pyspark.sql import DataFrame

from clinloom.operators.resources.columns import document_id, named, own_id, tail_after_pipe
from clinloom.operators.shred import (
    coding, items, leaf, node, obj, of_type, rows, shape, tabulate,
)
from clinloom.operators.typed import typed

_DOSE = items("doseAndRate", obj("doseQuantity", leaf("value")))

MEDICATION_REQUEST = shape(
    leaf("status", "intent", "authoredOn"),
    node("medicationCodeableConcept", leaf("text"), coding("code", "display")),
    obj("subject", leaf("reference")),
    obj("encounter", leaf("reference")),
    obj("requester", leaf("reference")),
    items("reasonReference", leaf("reference", "display")),
    rows(
        "dosageInstruction",
        leaf("sequence", "asNeededBoolean"),
        obj("timing", obj("repeat", leaf("frequency", "period", "periodUnit"))),
        _DOSE,
    ),
    _DOSE,
)

MEDICATION_CASTS = {
    "medicationRequestCreated": "date",
    "asNeededBoolean": "boolean",
    "sequence": "int",
    "frequency": "int",
    "period": "double",
    "dosageQuantity": "double",
}


def medication_rows(entries: DataFrame, dose_from: str = "resource") -> DataFrame:
    """Text rows of all medication requests, with the id of their document.

    The dose is read at the resource itself by default; ``"instruction"`` reads
    it inside the dosage instruction, where current documents carry it. Patient
    references keep their prefix.
    """
    dose = {
        "resource": "doseAndRate_doseQuantity_value",
        "instruction": "dosageInstruction_doseAndRate_doseQuantity_value",
    }[dose_from]
    return tabulate(
        of_type(entries, "MedicationRequest"), MEDICATION_REQUEST,
        "medicationCodeableConcept.coding", "dosageInstruction",
    ).select(
        *named(
            JsonLogsID=document_id(entries),
            medicationRequestID=own_id(),
            medicationRequestStatus="status",
            medicationRequestIntent="intent",
            medicationName="medicationCodeableConcept_coding_display",
            medicationCode="medicationCodeableConcept_coding_code",
            medicationCategoryAdministration="medicationCodeableConcept_text",
            patientId="subject_reference",
            encounterID=tail_after_pipe("encounter_reference"),
            medicationRequestCreated="authoredOn",
            doctorID=tail_after_pipe("requester_reference"),
            medicationRequestReasonID=tail_after_pipe("reasonReference_reference"),
            conditionThatCausedMedicationRequest="reasonReference_display",
            asNeededBoolean="dosageInstruction_asNeededBoolean",
            sequence="dosageInstruction_sequence",
            frequency="dosageInstruction_timing_repeat_frequency",
            period="dosageInstruction_timing_repeat_period",
            periodUnit="dosageInstruction_timing_repeat_periodUnit",
            dosageQuantity=dose,
        )
    )


def extract_medication_request(entries: DataFrame, dose_from: str = "resource") -> DataFrame:
    return typed(medication_rows(entries, dose_from), MEDICATION_CASTS)
