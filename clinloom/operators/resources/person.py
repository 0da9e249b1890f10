"""Patients and practitioners: names, contacts, addresses, identifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.functions.scalars import plus
from clinloom.operators.resources.columns import named, own_id
from clinloom.operators.shred import (
    items, leaf, node, obj, of_type, rows, shape, tabulate, texts,
)
from clinloom.operators.typed import typed

_NAME = rows("name", leaf("family"), texts("given"), texts("prefix"))
_TELECOM = rows("telecom", leaf("system", "value", "use"))
_FIRST_CODING = items("coding", leaf("code", "display"))


def _address(*names: str):
    return rows("address", texts("line"), leaf("city", "state", *names))


PERSON = shape(_NAME, _TELECOM, _address("country"), leaf("gender", "birthDate"))

PATIENT = shape(
    PERSON.fields,
    rows("communication", obj("language", _FIRST_CODING)),
    node("maritalStatus", _FIRST_CODING),
    rows("identifier", leaf("value")),
    rows("extension", items("extension", obj("valueCoding", leaf("display")))),
)

PRACTITIONER = shape(_NAME, _TELECOM, _address("postalCode", "country"), leaf("gender"))

IDENTIFIED = shape(rows("identifier", leaf("value"), obj("type", _FIRST_CODING)))

BIRTH_CASTS = {"birthDate": "timestamp"}
_CONTACTS = ("name", "telecom", "address")


def person_rows(entries: DataFrame) -> DataFrame:
    return tabulate(of_type(entries, "Practitioner", "Patient"), PERSON, *_CONTACTS).select(
        *named(
            UID=own_id(),
            resourceType="resourceType",
            prefix="name_prefix",
            family="name_family",
            given="name_given",
            gender="gender",
            birthDate="birthDate",
            line="address_line",
            city="address_city",
            state="address_state",
            country="address_country",
            phoneoremail="telecom_value",
            method="telecom_system",
            use="telecom_use",
        )
    )


def extract_person(entries: DataFrame) -> DataFrame:
    """Patients and practitioners: one row per name x telecom x address."""
    return typed(person_rows(entries), BIRTH_CASTS)


def patient_rows(entries: DataFrame) -> DataFrame:
    return tabulate(
        of_type(entries, "Patient"), PATIENT,
        *_CONTACTS, "communication", "identifier", "extension",
    ).select(
        *named(
            patientID=own_id(),
            resourceType="resourceType",
            prefix="name_prefix",
            family="name_family",
            given="name_given",
            gender="gender",
            birthDate="birthDate",
            address="address_line",
            city="address_city",
            state="address_state",
            country="address_country",
            race="extension_extension_valueCoding_display",
            contactvalue="telecom_value",
            contactmethod="telecom_system",
            contacttype="telecom_use",
            languageSpoken="communication_language_coding_display",
            maritalValue="maritalStatus_coding_code",
        )
    )


def extract_patient(entries: DataFrame) -> DataFrame:
    """One row per name x telecom x address x language x identifier x extension.

    ``race`` is the first nested value of each extension, whatever it is about.
    """
    return typed(patient_rows(entries), BIRTH_CASTS)


def extract_identifier(entries: DataFrame) -> DataFrame:
    """One row per patient identifier that has a type code."""
    return (
        tabulate(of_type(entries, "Patient"), IDENTIFIED, "identifier")
        .select(
            *named(
                personNumber=own_id(),
                idShortCode="identifier_type_coding_code",
                idTypeName="identifier_type_coding_display",
                idNumber="identifier_value",
            )
        )
        .filter(F.col("idShortCode").isNotNull())
    )


def extract_practitioner(entries: DataFrame) -> DataFrame:
    """One row per name x telecom x address."""
    return tabulate(of_type(entries, "Practitioner"), PRACTITIONER, *_CONTACTS).select(
        *named(
            ID=own_id(),
            prefix="name_prefix",
            firstname="name_given",
            lastname="name_family",
            gender="gender",
            address=plus("address_line", F.lit(","), "address_country"),
            city="address_city",
            state="address_state",
            zip="address_postalCode",
            contactvalue="telecom_value",
            contacttype="telecom_use",
            contactmethod="telecom_system",
        )
    )
