"""One extractor per resource type: bundle entries in, flat rows out.

Each module states the schema of the fields it needs, a ``*_rows`` function
that gives text columns, and the casts that type them. ``extract_*`` is both.
"""

from clinloom.operators.resources.benefit import extract_explanation_of_benefit
from clinloom.operators.resources.care import extract_care_plan, extract_care_team
from clinloom.operators.resources.claim import extract_claim
from clinloom.operators.resources.encounter import (
    extract_encounter,
    extract_encounter_treatments,
)
from clinloom.operators.resources.medication import extract_medication_request
from clinloom.operators.resources.organization import extract_organization
from clinloom.operators.resources.person import (
    extract_identifier,
    extract_patient,
    extract_person,
    extract_practitioner,
)

__all__ = [
    "extract_care_plan",
    "extract_care_team",
    "extract_claim",
    "extract_encounter",
    "extract_encounter_treatments",
    "extract_explanation_of_benefit",
    "extract_identifier",
    "extract_medication_request",
    "extract_organization",
    "extract_patient",
    "extract_person",
    "extract_practitioner",
]
