"""ExplanationOfBenefit: the widest resource, one row per combination of levels."""

from __future__ import annotations

from pyspark.sql import DataFrame

from clinloom.operators.resources.columns import named, own_id, stripped
from clinloom.operators.shred import (
    coding, items, leaf, node, obj, of_type, rows, shape, tabulate,
)
from clinloom.operators.typed import typed

_REFERENCE = leaf("reference")
_FIRST_CODING = items("coding", leaf("code", "display"))

EXPLANATION_OF_BENEFIT = shape(
    leaf("status", "use", "created", "outcome"),
    obj("patient", _REFERENCE),
    obj("billablePeriod", leaf("start", "end")),
    obj("provider", _REFERENCE),
    obj("payment", obj("amount", leaf("value", "currency"))),
    node("priority", coding("code")),
    node("type", coding("code")),
    rows("insurance", obj("coverage", leaf("display"))),
    rows("careTeam", leaf("sequence"), obj("provider", _REFERENCE), node("role", _FIRST_CODING)),
    rows(
        "contained",
        leaf("resourceType", "id", "status", "intent"),
        obj("subject", _REFERENCE),
        obj("requester", _REFERENCE),
        items("performer", _REFERENCE),
        obj("type", leaf("text")),
        obj("beneficiary", _REFERENCE),
        items("payor", leaf("display")),
    ),
    rows(
        "item",
        leaf("sequence"),
        obj("category", _FIRST_CODING),
        node("productOrService", coding("code")),
        items("encounter", _REFERENCE),
        obj("servicedPeriod", leaf("start", "end")),
        node("locationCodeableConcept", coding("code", "display")),
    ),
    rows("total", node("category", coding("code", "display")), obj("amount", leaf("value", "currency"))),
)

BENEFIT_CASTS = {"itemSequence": "int", "paymentAmountValue": "money"}


def benefit_rows(entries: DataFrame) -> DataFrame:
    # Levels that are usually one element come first: the row count, and with
    # it the copying, grows as late as possible.
    return tabulate(
        of_type(entries, "ExplanationOfBenefit"), EXPLANATION_OF_BENEFIT,
        "priority.coding", "type.coding", "insurance", "total", "total.category.coding",
        "contained", "careTeam", "item", "item.productOrService.coding",
        "item.locationCodeableConcept.coding",
    ).select(
        *named(
            ExplanationOfBenefitId=own_id(),
            status="status",
            ExplanationOfBenefitUse="use",
            ExplanationOfBenefitCodingDetailsCode="type_coding_code",
            patientID=stripped("patient_reference"),
            billablePeriodStart="billablePeriod_start",
            billablePeriodEnd="billablePeriod_end",
            created="created",
            providerReference=stripped("provider_reference"),
            coverage="insurance_coverage_display",
            itemSequence="item_sequence",
            itemProductOrderServiceCode="item_productOrService_coding_code",
            containedResourceType="contained_resourceType",
            containedId="contained_id",
            containedStatus="contained_status",
            containedIntent="contained_intent",
            containedSubject=stripped("contained_subject_reference"),
            containedReference=stripped("contained_requester_reference"),
            containedPerformer=stripped("contained_performer_reference"),
            containedType="contained_type_text",
            containedBeneficiary=stripped("contained_beneficiary_reference"),
            containedPayor="contained_payor_display",
            itemEncounterId=stripped("item_encounter_reference"),
            outcome="outcome",
            roleCode="careTeam_role_coding_code",
            careTeamRoleName="careTeam_role_coding_display",
            careTeamSequence="careTeam_sequence",
            careTeamProvider=stripped("careTeam_provider_reference"),
            itemcategoryCode="item_category_coding_code",
            itemcategoryName="item_category_coding_display",
            servicePeriodStart="item_servicedPeriod_start",
            servicePeriodEnd="item_servicedPeriod_end",
            locationCodeableConceptCode="item_locationCodeableConcept_coding_code",
            locationCodeableConceptName="item_locationCodeableConcept_coding_display",
            ExplanationOfBenefitCurrency="total_amount_currency",
            ExplanationOfBenefitTotalAmount="total_amount_value",
            totalCategoryCode="total_category_coding_code",
            totalCategoryName="total_category_coding_display",
            paymentAmountValue="payment_amount_value",
            paymentAmountCurrency="payment_amount_currency",
        )
    )


def extract_explanation_of_benefit(entries: DataFrame) -> DataFrame:
    """40 columns; dates stay text, rows are not deduplicated."""
    return typed(benefit_rows(entries), BENEFIT_CASTS)
