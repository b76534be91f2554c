"""Crate data mapped from the benchmark tables, so that every query has real input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cratelake.functions.keys import bronze_key
from cratelake.functions.text import quantity_text, zero_padded
from cratelake.model import CRATE_FIELDS
from cratelake.sources.messages import as_messages

# Own words for the free-text fields; one holds a comma.
CONTENTS = ["Paper, Card", "Copper wire", "Glass jars"]
NOTES = ["Leave upright", "Two labels", "Count on arrival"]
HANDLING = ["Keep dry", "Leave upright"]
TRANSPORT = ["Rail, Closed", "Barge"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: list[str]) -> Column:
    chosen = F.when(F.col("o_orderkey") % len(values) == 0, values[0])
    for i, value in enumerate(values[1:], start=1):
        chosen = chosen.when(F.col("o_orderkey") % len(values) == i, value)
    return chosen


def _order_fields() -> list[Column]:
    """The crate fields that an order gives by itself, of the columns of ``orders``."""
    key, day, status = F.col("o_orderkey"), F.to_date("o_orderdate"), F.col("o_orderstatus")
    day_text, week_later = day.cast("string"), F.date_add(day, 7).cast("string")
    return [
        key.cast("string").alias("crate_id"),
        F.concat(F.lit("CUST"), zero_padded(F.col("o_custkey").cast("string")))
        .alias("customer_id"),
        F.concat(F.col("o_custkey").cast("string"), F.lit(" Depot Road"))
        .alias("delivery_address"),
        day_text.alias("delivery_date"),
        F.lit("08:30:00").alias("delivery_time"),
        week_later.alias("return_date"),
        F.lit("17:15").alias("return_time"),
        _pick(CONTENTS).alias("contents"),
        F.concat(F.lit("ORD"), zero_padded((key % 100 + 1).cast("string")))
        .alias("batch_order_number"),
        _pick(TRANSPORT).alias("transportation_details"),
        F.when(status == "F", "Returned").when(status == "O", "In Transit")
        .when(status == "P", "Delivered").alias("return_status"),
        day_text.alias("qr_code_generation_date"),
        _pick(NOTES).alias("additional_notes"),
        quantity_text((key % 1000).cast("decimal(6,2)") / 100, "C", 6).alias("temperature"),
        quantity_text(F.col("o_totalprice"), "kg", 12).alias("weight"),
        week_later.alias("expiration_date"),
        _pick(HANDLING).alias("handling_instructions"),
        F.when(status == "F", "Delivered").otherwise("In Transit").alias("shipment_status"),
        day_text.alias("creation_date"),
        F.add_months(F.trunc(day, "month"), 1).alias("arrival_date"),
        key.alias("seq"),
        F.col("o_orderdate").alias("sent_ts"),
    ]


def order_crates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The crate fields an order gives by itself, plus ``arrival_date``, ``seq``, ``sent_ts``.

    Crates arrive on the first of the month after their order, so that even a small set
    fills its partitions.
    """
    return table(spark, sf_dir, "orders").select("o_custkey", *_order_fields())


def crates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One full crate record per order, plus ``arrival_date``, ``seq`` and ``sent_ts``.

    Nation and region are fixed at 25 and 5 rows, hence the broadcasts. Customers grow with the
    orders and are never collected; orders meet them as they are, a few numbers each, and the
    texts of a crate are made afterwards.
    """
    places = table(spark, sf_dir, "nation").join(
        F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customers = table(spark, sf_dir, "customer").hint("merge")
    joined = (
        table(spark, sf_dir, "orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .withColumnsRenamed({
            "c_name": "customer_name", "n_name": "city", "r_name": "state",
            "c_mktsegment": "company_name",
        })
    )
    return joined.select("customer_name", "city", "state", "company_name", *_order_fields()).select(
        *CRATE_FIELDS, "arrival_date", "seq", "sent_ts"
    )


def sent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The queue's messages without their bodies."""
    return order_crates(spark, sf_dir).select(
        F.col("crate_id").alias("message_id"), F.col("sent_ts").cast("timestamp"), "seq"
    )


def gold_crates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crates as they stand in the gold table: dated by arrival."""
    return crates(spark, sf_dir).select(
        *CRATE_FIELDS[:-1], F.col("arrival_date").alias("creation_date")
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_messages(crates(spark, sf_dir), "crate_id", "sent_ts", "seq")


def ragged_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages, where every seventh body lacks a field and every fifth has a null."""
    records = crates(spark, sf_dir)
    name = F.when(F.col("seq") % 7 != 0, F.col("customer_name"))
    body = F.to_json(F.struct(
        *[(name if c == "customer_name" else F.col(c)).alias(c) for c in CRATE_FIELDS]
    ))
    nulled = F.when(
        F.col("seq") % 5 == 0,
        F.replace("body", F.lit('"return_time":"17:15"'), F.lit('"return_time":null')),
    ).otherwise(F.col("body"))
    return records.select(
        F.col("crate_id").alias("message_id"), F.col("sent_ts").cast("timestamp"), "seq",
        body.alias("body"),
    ).withColumn("body", nulled)


def acks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Acknowledged messages: orders with a returned line."""
    return table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(
        F.col("l_orderkey").cast("string").alias("message_id")
    )


def contents(events: DataFrame) -> DataFrame:
    """Events as messages to deduplicate: content is who did what."""
    return events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.sha2(F.concat_ws("|", "user_id", "event_type"), 256).alias("dedup_key"),
    )


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An arrived object per event, named after its time."""
    return table(spark, sf_dir, "events").select(
        "event_id", bronze_key(F.col("ts")).alias("object_key"), "ts"
    )


def form(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crates as the form sends them: other order, the city under the form's name."""
    fields = sorted(CRATE_FIELDS)
    return crates(spark, sf_dir).select(*fields).withColumnRenamed("city", "delivery_city")


def faulty_crates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crates with missing, blank and badly typed fields among them."""
    seq = F.col("seq")
    return crates(spark, sf_dir).withColumns({
        "customer_name": F.when(seq % 11 != 0, F.col("customer_name")),
        "contents": F.when(seq % 13 == 0, "").otherwise(F.col("contents")),
        "delivery_date": F.when(seq % 17 == 0, "2001-02-30").otherwise(F.col("delivery_date")),
        "return_date": F.when(seq % 19 == 0, "07/31/2001").otherwise(F.col("return_date")),
        "delivery_time": F.when(seq % 23 == 0, "25:00").otherwise(F.col("delivery_time")),
        "additional_notes": F.when(seq % 29 == 0, " ").otherwise(F.col("additional_notes")),
    })
