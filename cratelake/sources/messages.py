"""The message queue as a folder of JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cratelake.functions.payload import record_json, record_of
from cratelake.model import CRATE_FIELDS, MESSAGE_SCHEMA
from cratelake.sources.files import MAX_FILE_AGE, folders

HOUR = "hour"  # hours since 1970, whatever the session's zone
HOUR_MICROS = 3_600_000_000
_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
# A compressed file is read by one task; this keeps files small.
FILE_ROWS = 100_000
_FILES = {"compression": "gzip", "maxRecordsPerFile": FILE_ROWS}


def as_messages(records: DataFrame, message_id: str, sent_ts: str, seq: str) -> DataFrame:
    """Messages whose body is the crate record."""
    return records.select(
        F.col(message_id).cast("string").alias("message_id"),
        F.col(sent_ts).cast("timestamp").alias("sent_ts"),
        F.col(seq).cast("long").alias("seq"),
        record_json(CRATE_FIELDS).alias("body"),
    )


def send_messages(messages: DataFrame, path: str, by_hour: bool = False, apart: str | None = None) -> None:
    """Append to the queue; ``by_hour`` with a folder per hour sent, which ``read_since`` picks from.

    Messages that differ in the column ``apart``, which is not sent, go to files of their own.
    """
    writer = messages.write.partitionBy(*([apart] if apart else []))
    if by_hour:
        hour = F.call_function("div", F.unix_micros("sent_ts"), F.lit(HOUR_MICROS))
        writer = messages.withColumn(HOUR, hour).hint("rebalance", HOUR).write.partitionBy(HOUR, *([apart] if apart else []))
    writer.mode("append").options(**_TIMES, **_FILES).json(path)


def read_messages(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.schema(MESSAGE_SCHEMA).options(**_TIMES).option("recursiveFileLookup", "true").json(list(paths))


def read_since(spark: SparkSession, paths: list[str], micros: int) -> DataFrame:
    """Messages of the folders ``paths`` sent in the hour of ``micros`` since 1970 or later.

    Only the names of the hours' folders are listed, and only those hours are opened; files that
    lie in no hour's folder are opened too.
    """
    first = micros // HOUR_MICROS
    found = []
    for path in paths:
        hours = ((x.rsplit("=", 1)[1], x) for x in folders(spark, f"{path}/{HOUR}=*"))
        found += [x for hour, x in hours if hour.lstrip("-").isdigit() and int(hour) >= first]
        found += folders(spark, f"{path}/part-*")
    return read_messages(spark, *found) if found else spark.createDataFrame([], MESSAGE_SCHEMA)


def stream_messages(
    spark: SparkSession, path: str, max_files: int = 1000, max_age: str = MAX_FILE_AGE
) -> DataFrame:
    return (
        spark.readStream.schema(MESSAGE_SCHEMA).options(**_TIMES).option("maxFileAge", max_age)
        .option("recursiveFileLookup", "true").option("maxFilesPerTrigger", max_files).json(path)
    )


def parsed(messages: DataFrame) -> DataFrame:
    """Messages with their body's crate fields as columns; absent fields are null."""
    record = messages.withColumn("_record", record_of(F.col("body")))
    return record.select("message_id", "sent_ts", "seq", "_record.*")


def save_bucketed(rows: DataFrame, table: str, buckets: int) -> None:
    """A table of messages or acknowledgements in ``buckets`` by message id, sorted in each.

    Two such tables of as many buckets meet without a shuffle; ``queue.pending`` takes them as they are.
    """
    (rows.repartition(buckets, "message_id").write.mode("overwrite").format("parquet")
     .bucketBy(buckets, "message_id").sortBy("message_id").saveAsTable(table))
