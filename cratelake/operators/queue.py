"""The message queue as two append-only tables: sent messages and acknowledgements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratelake.functions.text import arrival_text, scan_completed_text

FEW = 10_000  # messages whose places are broadcast to fetch their bodies


def pending(sent: DataFrame, acked: DataFrame) -> DataFrame:
    """Sent messages not acknowledged yet.

    The distinct makes one row per task of an id acknowledged very often, before the
    shuffle the join needs anyway.
    """
    return sent.join(acked.select("message_id").distinct(), "message_id", "left_anti")


def scanned(sent: DataFrame, acked: DataFrame) -> DataFrame:
    return sent.join(acked.select("message_id").distinct(), "message_id", "left_semi")


def settled_files(sent: DataFrame, acked: DataFrame) -> DataFrame:
    """``file, settled`` of each file of ``sent(message_id, file)``: whether all its messages are acknowledged."""
    done = acked.select("message_id").distinct().withColumn("_done", F.lit(True))
    known = sent.join(done, "message_id", "left").select("file", F.coalesce("_done", F.lit(False)).alias("_done"))
    return known.groupBy("file").agg(F.bool_and("_done").alias("settled"))


def idle_acks(acked: DataFrame, sent: DataFrame) -> DataFrame:
    """``file, idle`` of each file of ``acked(message_id, file)``: whether no message of ``sent`` needs it."""
    here = sent.select("message_id").distinct().withColumn("_here", F.lit(True))
    known = acked.join(here, "message_id", "left").select("file", F.col("_here").isNull().alias("_idle"))
    return known.groupBy("file").agg(F.bool_and("_idle").alias("idle"))


def peek(queue: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` messages in queue order; nothing is consumed."""
    return queue.orderBy("sent_ts", "seq").limit(n)


def peek_pending(sent: DataFrame, acked: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` pending messages with all their columns, bodies too.

    Only ids and times take part in the search; the bodies of the messages found are fetched.
    """
    place = ["message_id", "sent_ts", "seq"]
    found = peek(pending(sent.select(*place), acked), n)
    if n <= FEW:
        found = F.broadcast(found)
    same = [sent[c].eqNullSafe(found[c]) for c in place]
    return sent.join(found, same, "left_semi").orderBy("sent_ts", "seq").limit(n)


def head(queue: DataFrame) -> DataFrame:
    return peek(queue, 1)


def scan_notifications(crates: DataFrame, subject: str = "Scan Completed") -> DataFrame:
    """One notification per scanned crate."""
    return crates.select(
        F.col("crate_id"),
        F.lit(subject).alias("subject"),
        scan_completed_text(F.col("crate_id")).alias("message"),
    )


def arrival_notifications(objects: DataFrame, *others: str) -> DataFrame:
    """One message per arrived object, with the columns ``others`` before it."""
    return objects.select(*others, "object_key", arrival_text(F.col("object_key")).alias("body"))


def waiting(notifications: DataFrame, threshold: int = 10) -> DataFrame:
    """How many arrivals wait, and whether they are enough for a batch."""
    return notifications.agg(F.count(F.lit(1)).alias("waiting")).withColumn(
        "batch_due", F.col("waiting") > threshold
    )
