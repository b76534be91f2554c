"""The landing zones and the gold table of the benchmark crates, written once per session."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from cratelake.model import CRATE_FIELDS
from cratelake.operators.ordered import store_order
from cratelake.plans import fixtures
from cratelake.session import shared_path
from cratelake.sources.csvfiles import write_raw, write_routed
from cratelake.sources.gold import create_table, write_gold
from cratelake.sources.messages import send_messages
from cratelake.sources.rollups import Rollup
from cratelake.streaming.flows import ingest_files

_written: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, zone: str, write) -> str:
    slot = (spark.sparkContext.applicationId, sf_dir, zone)
    if slot not in _written:
        path = shared_path(spark, zone)
        write(path)
        _written[slot] = path
    return _written[slot]


def queue(spark: SparkSession, sf_dir: str) -> str:
    return _once(
        spark, sf_dir, "queue", lambda p: send_messages(fixtures.messages(spark, sf_dir), p)
    )


def ragged_queue(spark: SparkSession, sf_dir: str) -> str:
    return _once(
        spark, sf_dir, "ragged",
        lambda p: send_messages(fixtures.ragged_messages(spark, sf_dir), p),
    )


def forms(spark: SparkSession, sf_dir: str) -> str:
    """Submitted forms, faulty ones among them."""
    return _once(
        spark, sf_dir, "forms",
        lambda p: fixtures.faulty_crates(spark, sf_dir).select(*CRATE_FIELDS).write.parquet(p),
    )


def raw(spark: SparkSession, sf_dir: str) -> str:
    return _once(spark, sf_dir, "raw", lambda p: write_raw(fixtures.crates(spark, sf_dir), p))


def silver(spark: SparkSession, sf_dir: str) -> str:
    def write(path: str) -> None:
        write_routed(fixtures.crates(spark, sf_dir), F.col("arrival_date"), path)

    return _once(spark, sf_dir, "unprocessed", write)


def inventory(spark: SparkSession, sf_dir: str) -> str:
    """Name of the table that the routed crates were ingested into."""
    def ingest(path: str) -> None:
        name = path.rsplit("/", 1)[-1].replace("-", "_")
        create_table(spark, name, path, batched=True)
        ingest_files(spark, silver(spark, sf_dir), path, f"{path}-checkpoint", table=name)

    return _once(spark, sf_dir, "crate_inventory", ingest).rsplit("/", 1)[-1].replace("-", "_")


def gold(spark: SparkSession, sf_dir: str) -> str:
    return _once(
        spark, sf_dir, "gold", lambda p: write_gold(fixtures.gold_crates(spark, sf_dir), p)
    )


def rollup(spark: SparkSession, sf_dir: str, by) -> str:
    """Counts of the crates by the columns ``by``, added in four micro-batches."""
    def write(path: str) -> None:
        kept = Rollup(spark, path, by)
        rows = fixtures.crates(spark, sf_dir).withColumn("day", F.to_date("sent_ts"))
        for turn in range(4):
            kept.add(rows.where(F.pmod(F.xxhash64("crate_id"), F.lit(4)) == turn), turn)

    return _once(spark, sf_dir, "rollup", write)


def cell_order(spark: SparkSession, sf_dir: str, cells) -> str:
    return _once(spark, sf_dir, "cell-order", lambda p: store_order(cells, p, "cell", row_key="event_id"))
