"""Care teams and care plans; all columns are text."""

from __future__ import annotations

from pyspark.sql import DataFrame

from clinloom.operators.resources.columns import named, own_id, stripped
from clinloom.operators.shred import (
    coding, items, leaf, node, obj, of_type, rows, shape, tabulate,
)

_COMMON = [
    *leaf("id", "status"),
    obj("subject", leaf("reference")),
    obj("encounter", leaf("reference")),
    obj("period", leaf("start")),
]

CARE_TEAM = shape(
    _COMMON,
    rows(
        "participant",
        rows("role", items("coding", leaf("system", "code", "display"))),
        obj("member", leaf("reference", "display")),
    ),
    rows("reasonCode", coding("system", "code", "display")),
    rows("managingOrganization", leaf("reference", "display")),
)

CARE_PLAN = shape(
    _COMMON,
    leaf("intent"),
    rows("category", coding("system", "code", "display")),
    items("careTeam", leaf("reference")),
    rows(
        "activity",
        node(
            "detail",
            leaf("status"),
            obj("location", leaf("display")),
            node("code", leaf("text"), coding("system", "code", "display")),
        ),
    ),
)


def _common() -> dict:
    return dict(
        UID=own_id(),
        resourceType="resourceType",
        id="id",
        status="status",
        subject=stripped("subject_reference"),
        encounter=stripped("encounter_reference"),
        periodStart="period_start",
    )


def extract_care_team(entries: DataFrame) -> DataFrame:
    """One row per participant role x reason coding x managing organization."""
    return tabulate(
        of_type(entries, "CareTeam"), CARE_TEAM,
        "managingOrganization", "reasonCode", "reasonCode.coding",
        "participant", "participant.role",
    ).select(
        *named(
            **_common(),
            roleCode="participant_role_coding_code",
            roleSystem="participant_role_coding_system",
            roleName="participant_role_coding_display",
            roleMemberReference=stripped("participant_member_reference"),
            roleMemberDisplay="participant_member_display",
            reasonSystem="reasonCode_coding_system",
            code="reasonCode_coding_code",
            reasonNameFromCoding="reasonCode_coding_display",
            managingOrganizationReference=stripped("managingOrganization_reference"),
            managingOrganizationName="managingOrganization_display",
        )
    )


def extract_care_plan(entries: DataFrame) -> DataFrame:
    """One row per category coding x activity coding."""
    return tabulate(
        of_type(entries, "CarePlan"), CARE_PLAN,
        "category", "category.coding", "activity", "activity.detail.code.coding",
    ).select(
        *named(
            **_common(),
            intent="intent",
            system="category_coding_system",
            categoryCodingCode="category_coding_code",
            categoryCodingName="category_coding_display",
            careTeamID=stripped("careTeam_reference"),
            activityDetailStatus="activity_detail_status",
            activityDetailLocation="activity_detail_location_display",
            activityDetailText="activity_detail_code_text",
            activityCodingSystem="activity_detail_code_coding_system",
            activityCodingCode="activity_detail_code_coding_code",
            activityCodingName="activity_detail_code_coding_display",
        )
    )
