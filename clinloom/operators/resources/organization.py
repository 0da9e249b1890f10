"""Organization: one row per type coding x telecom x address."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.functions.scalars import plus
from clinloom.operators.resources.columns import named, own_id
from clinloom.operators.shred import coding, leaf, of_type, rows, shape, tabulate, texts

ORGANIZATION = shape(
    leaf("name"),
    rows("telecom", leaf("value")),
    rows("address", texts("line"), leaf("city", "state", "postalCode", "country")),
    rows("type", leaf("text"), coding("code")),
)


def extract_organization(entries: DataFrame, repeats: bool = True) -> DataFrame:
    """All columns are text. Type codings only repeat rows (``repeats``)."""
    levels = ["type", *(["type.coding"] if repeats else []), "telecom", "address"]
    return tabulate(of_type(entries, "Organization"), ORGANIZATION, *levels).select(
        *named(
            organizationID=own_id(),
            name="name",
            address=plus("address_line", F.lit(","), "address_country"),
            city="address_city",
            state="address_state",
            zip="address_postalCode",
            phone="telecom_value",
            type="type_text",
        )
    )
