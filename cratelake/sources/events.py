"""Object-created events and where their objects go."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratelake.functions.dates import event_date
from cratelake.functions.keys import silver_key
from cratelake.model import EVENT_SCHEMA


def route_objects(events: DataFrame, event: str = "event") -> DataFrame:
    """One row per object of every record of every event: key, arrival date, new key."""
    return _with_destination(_objects(events, event)).where("destination_key is not null").drop("event")


def route_rejects(events: DataFrame, event: str = "event") -> DataFrame:
    """What cannot be routed: the event, its object's key if it has one, and the reason.

    An event that is no JSON or names no object is one row. An accepted object is never among them, and
    an object is either here or in ``route_objects``.
    """
    left = _with_destination(_objects(events, event)).where("destination_key is null")
    return left.select(
        "event", "object_key",
        F.when(F.col("object_key").isNull(), "no object").otherwise("no event time").alias("reason"),
    )


def _objects(events: DataFrame, event: str) -> DataFrame:
    record = F.explode_outer(F.from_json(event, EVENT_SCHEMA)["Records"]).alias("r")
    return events.select(F.col(event).alias("event"), record).select(
        "event", F.col("r.s3.object.key").alias("object_key"),
        event_date(F.col("r.eventTime")).alias("creation_date"),
    )


def _with_destination(objects: DataFrame) -> DataFrame:
    return objects.withColumn(
        "destination_key", silver_key(F.col("creation_date"), F.col("object_key"))
    )
