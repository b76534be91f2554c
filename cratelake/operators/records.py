"""Crate records: canonical shape, strict views, form rules, text results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratelake.functions.payload import view_of
from cratelake.functions.text import quantity_value
from cratelake.model import (
    CRATE_FIELDS, DATE_FIELDS, FORM_NAMES, QUEUE_VIEW_FIELDS, TIME_FIELDS,
)


def canonical_record(form: DataFrame) -> DataFrame:
    """The crate fields in order, form names mapped, anything else left out."""
    return form.withColumnsRenamed(FORM_NAMES).select(*CRATE_FIELDS)


def result_as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def _strict(messages: DataFrame, required: list[str]) -> tuple[DataFrame, Column]:
    absent = F.array_except(
        F.array(*[F.lit(name) for name in required]),
        F.coalesce(F.json_object_keys("body"), F.array().cast("array<string>")),
    )
    return messages, absent


def inprogress_view(messages: DataFrame) -> DataFrame:
    """Queue view of the messages that have every field it shows (null values count)."""
    parsed, absent = _strict(messages, QUEUE_VIEW_FIELDS)
    return parsed.where(F.size(absent) == 0).select(
        "message_id", view_of(F.col("body"), QUEUE_VIEW_FIELDS).alias("_record")
    ).select("message_id", *[F.col(f"_record.{name}").alias(name) for name in QUEUE_VIEW_FIELDS])


def inprogress_rejects(messages: DataFrame) -> DataFrame:
    """The other messages, with the fields they lack."""
    parsed, absent = _strict(messages, QUEUE_VIEW_FIELDS)
    return parsed.withColumn("missing", absent).where(F.size("missing") > 0).select(
        "message_id", "missing"
    )


_BETWEEN = "; "


def _broken_rules() -> Column:
    """Text naming the form rules a record breaks, empty for a valid one."""
    rules = []
    for name in CRATE_FIELDS:
        value = F.col(name)
        empty = value.isNull() | (value == "")
        rules.append(F.when(empty, f"{name} is missing"))
        if name in DATE_FIELDS:
            shaped = value.rlike(r"^\d{4}-\d{2}-\d{2}$") & value.try_cast("date").isNotNull()
            rules.append(F.when(~empty & ~shaped, f"{name} is not a date"))
        if name in TIME_FIELDS:
            shaped = value.rlike(r"^([01]\d|2[0-3]):[0-5]\d(:[0-5]\d)?$")
            rules.append(F.when(~empty & ~shaped, f"{name} is not a time"))
    return F.concat_ws(_BETWEEN, *rules)


def accepted(df: DataFrame) -> DataFrame:
    """Records that keep every rule of the form."""
    return df.where(_broken_rules() == "")


def rejected(df: DataFrame) -> DataFrame:
    """The other records, with ``reason``: the rules each one breaks."""
    broken = df.withColumn("reason", _broken_rules()).where(F.col("reason") != "")
    return broken.withColumn("reason", F.split("reason", _BETWEEN))


def typed_view(crates: DataFrame) -> DataFrame:
    """Text columns read as the dates and quantities they mean; bad text becomes null."""
    return crates.withColumns({
        **{name: F.col(name).try_cast("date") for name in DATE_FIELDS},
        "temperature": quantity_value(F.col("temperature"), "C", 6),
        "weight": quantity_value(F.col("weight"), "kg", 12),
    })
