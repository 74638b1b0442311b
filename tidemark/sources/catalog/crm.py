"""Tables of a HubSpot account. Their columns come from a property catalogue."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import types as T

from tidemark.model import CDC, TableDef
from tidemark.sources.catalog.fields import fields

# Base columns, associations of the standard objects, ids of object
# types that are not custom objects, and property types other than string.
_BASE = "id createdAt updatedAt archived:boolean"
ASSOCIATIONS = {
    "contacts": ["companies"],
    "companies": ["contacts"],
    "deals": ["contacts", "companies", "tickets"],
    "tickets": ["contacts", "companies", "deals"],
    "calls": ["contacts", "companies", "deals", "tickets"],
    "emails": ["contacts", "companies", "deals", "tickets"],
    "meetings": ["contacts", "companies", "deals", "tickets"],
    "tasks": ["contacts", "companies", "deals", "tickets"],
    "notes": ["contacts", "companies", "deals", "tickets"],
    "deal_split": [],
}
UNLISTED = ("deal_split",)
STANDARD_OBJECT_TYPES = ["0-1", "0-2", "0-3", "0-5"]
PROPERTY_TYPES: dict[str, T.DataType] = {"bool": T.BooleanType(), "number": T.LongType()}
PREFIX = "properties_"


def object_table(
    name: str,
    properties: Iterable[tuple[str, str]] = (),
    types: Mapping[str, T.DataType] | None = None,
) -> TableDef:
    """Definition of a standard or custom object with the given (name, type) properties.

    `types` replaces entries of the type map, for instance a decimal for `number`,
    which is a whole number by default. An unknown type is a string.
    """
    known = {**PROPERTY_TYPES, **(types or {})}
    schema = fields(_BASE)
    associations = ASSOCIATIONS.get(name, [])
    for other in associations:
        schema = schema.add(other, T.ArrayType(T.StringType()))
    paths = {}
    for prop, kind in properties:
        schema = schema.add(PREFIX + prop, known.get((kind or "string").lower(), T.StringType()))
        paths[PREFIX + prop] = ("properties", prop)
    return TableDef(
        name,
        schema,
        keys=("id",),
        cursor="updatedAt",
        mode=CDC,
        paths=paths,
        id_arrays={other: f"associations.{other}" for other in associations},
        envelope="results",
        archived=True,
    )


TABLES = {name: object_table(name) for name in ASSOCIATIONS}
