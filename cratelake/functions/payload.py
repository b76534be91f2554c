"""JSON payloads of crate records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cratelake.model import CRATE_FIELDS, CRATE_SCHEMA, LABEL_FIELDS

_KEEP_NULLS = {"ignoreNullFields": "false"}


def record_json(fields: list[str] = CRATE_FIELDS) -> Column:
    """The record as a JSON object, nulls written out."""
    return F.to_json(F.struct(*fields), _KEEP_NULLS)


def record_of(body: Column) -> Column:
    """Lenient parse: fields the body lacks are null; of a repeated field the last value counts."""
    return F.from_json(body, CRATE_SCHEMA)


def readable(body: Column) -> Column:
    """Whether the body is a JSON object, as a record must be."""
    return F.json_object_keys(body).isNotNull()


def view_of(body: Column, fields: list[str]) -> Column:
    """The named fields as a struct, by the same rule."""
    return F.from_json(body, ", ".join(f"`{name}` string" for name in fields))


def fields_of(body: Column) -> Column:
    """All fields as a map, so that a missing field differs from a null one."""
    return F.from_json(body, "map<string,string>")


def label_json(body: Column) -> Column:
    """The short label payload of a message body; absent fields become null."""
    label = F.from_json(body, ", ".join(f"{name} string" for name in LABEL_FIELDS))
    return F.to_json(label, _KEEP_NULLS)
