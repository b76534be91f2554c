"""Fewer files per date in a gold table that micro-batches feed.

A date's folders of micro-batches are rewritten as one, registered under the negative number -(m + 1) if they
go through micro-batch m. Such a partition stands for all of the date's that go no further; where both are
registered, in the moment between two catalog commands or after a run that stopped there, ``read_table``
leaves the older ones out and the next run drops them. Readers that were planned before keep their
files: a run removes only what the run before it replaced.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cratelake.model import ARRIVAL_DATE
from cratelake.sources import files
from cratelake.sources.gold import BATCH, GOLD_SCHEMA, partitions, repair_table

COMPACTED = "_compacted"  # below the table's folder; readers by path do not look into it


def through(batch: int) -> int:
    """The last micro-batch a partition holds."""
    return batch if batch >= 0 else -batch - 1


def registered(spark: SparkSession, table: str) -> dict[str, list[int]]:
    """The numbers of each date's partitions. The catalog's list, which compaction keeps short."""
    found: dict[str, list[int]] = {}
    for row in partitions(spark, table).collect():
        date, batch = (x.split("=", 1)[1] for x in row[0].split("/"))
        found.setdefault(date, []).append(int(batch))
    return found


def replaced(numbers: list[int]) -> list[int]:
    """Those of a date's partitions whose rows its newest compacted one holds as well."""
    newest = max((through(n) for n in numbers if n < 0), default=-1)
    return [n for n in numbers if through(n) <= newest and n != -newest - 1]


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """The table's rows, each once also while a compaction is under way."""
    rows = spark.table(table)
    for date, numbers in registered(spark, table).items():
        if old := replaced(numbers):
            rows = rows.where(~((F.col(ARRIVAL_DATE) == F.lit(date).cast("date")) & F.col(BATCH).isin(old)))
    return rows.select(*GOLD_SCHEMA.names)


def drop_replaced(spark: SparkSession, table: str) -> None:
    """Drop partitions that a compacted one stands for, as after a repair that found their folders again."""
    listed = [(d, n) for d, numbers in registered(spark, table).items() for n in replaced(numbers)]
    if listed:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(_spec(d, n) for d, n in listed)}")


def repair(spark: SparkSession, table: str) -> None:
    """Register every folder of a micro-batch but those that were compacted."""
    repair_table(spark, table)
    drop_replaced(spark, table)


def compact(spark: SparkSession, table: str, path: str, most: int = 8, committed: int | None = None) -> list[str]:
    """Rewrite the dates with more than ``most`` partitions as one each; returns them.

    Only micro-batches through ``committed``, if given, take part: one that may still run again
    must keep its folder. All dates are read and written by one job, rebalanced by date, so that a small date is
    one file and a large one is split by size. The table's folder keeps the old files until the next
    run, which removes them; from then on the table is to be read by its name.
    """
    drop_replaced(spark, table)
    _remove_old(spark, table, path)
    settled = {
        date: [n for n in numbers if committed is None or through(n) <= committed]
        for date, numbers in registered(spark, table).items()
    }
    chosen = {date: numbers for date, numbers in settled.items() if len(numbers) > most}
    if not chosen:
        return []
    last = max(through(n) for numbers in chosen.values() for n in numbers)
    dates = sorted(chosen)
    rows = spark.table(table).where(F.col(ARRIVAL_DATE).isin([F.lit(d).cast("date") for d in dates]))
    if committed is not None:
        rows = rows.where(F.col(BATCH) <= committed)
    target = f"{path}/{COMPACTED}/through={last}-{uuid.uuid4().hex}"
    rows.drop(BATCH).hint("rebalance", ARRIVAL_DATE).write.partitionBy(ARRIVAL_DATE).parquet(target)
    added = " ".join(f"{_spec(d, -last - 1)} LOCATION '{target}/{ARRIVAL_DATE}={d}'" for d in dates)
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {added}")
    drop_replaced(spark, table)
    return dates


def _spec(date: str, batch: int) -> str:
    return f"PARTITION ({ARRIVAL_DATE}=DATE'{date}', {BATCH}={batch})"


def _remove_old(spark: SparkSession, table: str, path: str) -> None:
    """Remove the folders of what compacted partitions of earlier runs stand for."""
    for date, numbers in registered(spark, table).items():
        newest = max((through(n) for n in numbers if n < 0), default=-1)
        if newest < 0:
            continue
        for folder in files.folders(spark, f"{path}/{ARRIVAL_DATE}={date}/{BATCH}=*"):
            if int(folder.rsplit("=", 1)[1]) <= newest:
                files.delete(spark, folder)
        for folder in files.folders(spark, f"{path}/{COMPACTED}/through=*/{ARRIVAL_DATE}={date}"):
            if int(folder.split("through=")[1].split("-")[0]) < newest:
                files.delete(spark, folder)
