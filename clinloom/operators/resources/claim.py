"""Claim: one row per insurance x priority x type x item combination."""

from __future__ import annotations

from pyspark.sql import DataFrame

from clinloom.operators.resources.columns import named, own_id, stripped
from clinloom.operators.shred import (
    coding, items, leaf, node, obj, of_type, rows, shape, tabulate,
)
from clinloom.operators.typed import typed

CLAIM = shape(
    leaf("status", "use", "created"),
    obj("patient", leaf("reference")),
    obj("billablePeriod", leaf("start", "end")),
    obj("provider", leaf("reference")),
    obj("prescription", leaf("reference")),
    obj("total", leaf("value", "currency")),
    node("priority", coding("code")),
    node("type", coding("code")),
    rows("insurance", leaf("sequence", "focal"), obj("coverage", leaf("display"))),
    rows(
        "item",
        leaf("sequence"),
        items("encounter", leaf("reference")),
        node("productOrService", coding("code")),
    ),
)

_DATES = ("claimbillablePeriodStart", "claimbillablePeriodEnd", "claimCreated")
CLAIM_CASTS = {
    **{c: "date" for c in _DATES},
    "claimFocal": "boolean",
    "insuranceSequence": "int",
    "itemSequence": "int",
    "claimTotal": "money",
}


def claim_rows(entries: DataFrame, repeats: bool = True) -> DataFrame:
    """Text rows of all claims.

    Product codings appear in no column, they only repeat rows. A caller that
    removes duplicates afterwards passes ``repeats=False`` and saves the level.
    """
    levels = ["priority.coding", "type.coding", "insurance", "item"]
    if repeats:
        levels.append("item.productOrService.coding")
    return tabulate(of_type(entries, "Claim"), CLAIM, *levels).select(
        *named(
            claimId=own_id(),
            claimStatus="status",
            claimUse="use",
            claimPatientId=stripped("patient_reference"),
            claimbillablePeriodStart="billablePeriod_start",
            claimbillablePeriodEnd="billablePeriod_end",
            claimCreated="created",
            claimProviderReference=stripped("provider_reference"),
            claimPriorityCode="priority_coding_code",
            claimPrescriptionId=stripped("prescription_reference"),
            claimFocal="insurance_focal",
            insuranceSequence="insurance_sequence",
            claimCoverage="insurance_coverage_display",
            itemSequence="item_sequence",
            claimCode="type_coding_code",
            encounterId=stripped("item_encounter_reference"),
            claimTotal="total_value",
            claimCurrency="total_currency",
        )
    )


def extract_claim(entries: DataFrame, repeats: bool = True, cast_dates: bool = True) -> DataFrame:
    """Typed claim rows; ``cast_dates=False`` keeps the dates as written."""
    casts = {c: k for c, k in CLAIM_CASTS.items() if cast_dates or c not in _DATES}
    return typed(claim_rows(entries, repeats), casts)
