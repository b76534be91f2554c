"""The lake's streams: scan, route, ingest, and the count-triggered gate.

Each one has a checkpoint and takes what has arrived since its last run, each file once;
with nothing new it does nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cratelake.functions.payload import readable, record_of
from cratelake.model import (
    ARRIVAL_DATE, CRATE_FIELDS, DECLARED_DATE, LANDED_SCHEMA, MESSAGE_SCHEMA,
)
from cratelake.operators.batches import full_batches
from cratelake.operators.numbering import with_position
from cratelake.operators.queue import arrival_notifications, idle_acks, scan_notifications, settled_files
from cratelake.sources.csvfiles import (
    FILE_ROWS, WRITE_OPTIONS, stream_crate_csv, with_arrival, write_raw,
)
from cratelake.sources.files import (
    MAX_FILE_AGE, drop_emptied, ensure_folder, exists, list_files, move_below, plain,
)
from cratelake.sources.gold import read_batch, write_batch
from cratelake.sources.messages import read_messages
from cratelake.sources.rollups import Rollup
from cratelake.streaming.intake import FILE, Intake, file_of

_GATE = "came:bigint,waiting:bigint,fired:boolean"


def _finish(query: StreamingQuery) -> None:
    query.awaitTermination()


def _seed(spark: SparkSession, path: str, fields: str) -> None:
    """An empty part of a batched folder, so that it can be read before the first batch."""
    first = f"{path}/batch=-1"
    if not _written(spark, first):
        spark.createDataFrame([], fields.replace(":", " ")).write.mode("overwrite").parquet(first)


def _written(spark: SparkSession, path: str) -> bool:
    return exists(spark, f"{path}/_SUCCESS")


def scan_messages(
    messages: DataFrame, raw: str, acks: str, checkpoint: str, rejects: str | None = None,
    notices: str | None = None,
) -> None:
    """Land each message's record, put a notice in ``notices`` if given, acknowledge the message.

    A message whose body is no JSON object is neither landed nor acknowledged; it goes to the
    folder ``rejects`` (by default beside ``acks``) with its body. A micro-batch that is run again
    leaves alone what its first run completed.
    """
    rejects = rejects or f"{acks}-rejects"

    def scan(batch: DataFrame, batch_id: int) -> None:
        landing, acked = f"{raw}/batch={batch_id}", f"{acks}/batch={batch_id}"
        refused = f"{rejects}/batch={batch_id}"
        if not _written(batch.sparkSession, refused):
            batch.where(~readable(F.col("body"))).select("message_id", "sent_ts", "seq", "body").write.mode(
                "overwrite"
            ).parquet(refused)
        batch = batch.where(readable(F.col("body")))
        if not _written(batch.sparkSession, landing):
            record = batch.select(record_of(F.col("body")).alias("r")).select("r.*")
            write_raw(record, landing, mode="overwrite")
        if notices and not _written(batch.sparkSession, f"{notices}/batch={batch_id}"):
            crates = batch.select(record_of(F.col("body"))["crate_id"].alias("crate_id"))
            scan_notifications(crates).write.mode("overwrite").parquet(f"{notices}/batch={batch_id}")
        if not _written(batch.sparkSession, acked):
            batch.select("message_id").write.mode("overwrite").parquet(acked)

    _finish(
        messages.writeStream.foreachBatch(scan).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def retire_files(spark: SparkSession, queue: str, acks: str, retired: str, most: int = 10_000) -> int:
    """Take message files whose messages are all acknowledged out of ``queue``, and then files of
    acknowledgements that no message in the queue needs out of ``acks``, into ``retired/queue`` and ``retired/acks``;
    returns how many went, ``most`` of each at most.

    Files never change, so one that is settled stays so. A run that stops anywhere leaves files where
    they were or where they belong, and what is pending the same.
    """
    def with_file(rows: DataFrame) -> DataFrame:
        return rows.select("message_id", F.col("_metadata.file_path").alias("file"))

    def take(listed: DataFrame, folder: str, name: str) -> int:
        uris = [plain(spark, r["file"]) for r in listed.select("file").limit(most).collect()]
        return move_below(spark, uris, folder, f"{retired}/{name}")

    acked = with_file(read_acks(spark, acks))
    gone = take(settled_files(with_file(read_messages(spark, queue)), acked).where("settled"), queue, "queue")
    gone += take(idle_acks(acked, read_messages(spark, queue)).where("idle"), acks, "acks")
    drop_emptied(spark, acks)
    return gone


def read_rejects(spark: SparkSession, rejects: str) -> DataFrame:
    """Messages that could not be read, as they came."""
    return spark.read.schema(MESSAGE_SCHEMA).option("recursiveFileLookup", "true").parquet(rejects)


def read_acks(spark: SparkSession, acks: str) -> DataFrame:
    return spark.read.schema("message_id STRING").option("recursiveFileLookup", "true").parquet(acks)


def read_notices(spark: SparkSession, notices: str) -> DataFrame:
    return spark.read.schema("crate_id STRING, subject STRING, message STRING").option(
        "recursiveFileLookup", "true"
    ).parquet(notices)


def announce_files(spark: SparkSession, silver: str, arrivals: str) -> None:
    """Append a message for every routed file that has none yet; ``arrivals`` is a folder of them."""
    listed = list_files(spark, silver).select("uri")
    new = listed.join(read_arrivals(spark, arrivals), "uri", "left_anti")
    key = F.regexp_extract("uri", f"[^/]+/{ARRIVAL_DATE}=.*$", 0)
    told = arrival_notifications(new.withColumn("object_key", F.coalesce(F.nullif(key, F.lit("")), "uri")), "uri")
    told.write.mode("append").parquet(arrivals)


def read_arrivals(spark: SparkSession, arrivals: str) -> DataFrame:
    return spark.read.schema("uri STRING, object_key STRING, body STRING").parquet(arrivals)


def stream_arrivals(spark: SparkSession, arrivals: str, max_files: int = 1000) -> DataFrame:
    """Announced files, as a stream."""
    return (
        spark.readStream.schema("uri STRING, object_key STRING, body STRING").option("maxFilesPerTrigger", max_files)
        .option("maxFileAge", MAX_FILE_AGE).parquet(arrivals)
    )


def route_files(
    spark: SparkSession, raw: str, silver: str, checkpoint: str,
    arrival: Column | None = None, max_files: int = 1000, archive: str | None = None,
) -> None:
    """Route landed records to their arrival date, by default the day the file was written.

    Below a date each micro-batch has a folder of its own, which a repeated run replaces. With
    ``archive`` the landed files move there: those a stopped run left first, its own at the end, so
    that ``raw`` holds what is not routed yet and its listing stays short.
    """
    arrival = F.col("_metadata.file_modification_time") if arrival is None else arrival
    ensure_folder(spark, raw)
    intake = Intake(spark, raw, f"{archive}/_taken", checkpoint, archive) if archive else None
    if intake:
        intake.sweep()
    records = stream_crate_csv(spark, raw, max_files=max_files)
    routed = records.select("*", F.to_date(arrival).alias("_arrival"), *([file_of()] if intake else [])).select(
        *CRATE_FIELDS[:-1],
        F.col(ARRIVAL_DATE).alias(DECLARED_DATE),
        F.col("_arrival").alias(ARRIVAL_DATE),
        *([FILE] if intake else []),
    )

    def route(batch: DataFrame, batch_id: int) -> None:
        if intake:
            intake.note(batch, batch_id)
        (batch.drop(FILE).withColumn("batch", F.lit(batch_id)).hint("rebalance", ARRIVAL_DATE)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .options(**WRITE_OPTIONS).option("maxRecordsPerFile", FILE_ROWS)
         .partitionBy(ARRIVAL_DATE, "batch").csv(silver))

    ensure_folder(spark, silver)
    _finish(
        routed.writeStream.foreachBatch(route).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    if intake:
        intake.sweep()
        intake.sweep_bare(len(",".join(CRATE_FIELDS)) + 2)


def ingest_files(
    spark: SparkSession, silver: str, gold: str, checkpoint: str,
    archive: str | None = None, max_files: int = 1000, schema=LANDED_SCHEMA,
    keep_declared: bool = False, table: str | None = None, taken: str | None = None,
    rollup: Rollup | None = None,
) -> None:
    """Routed CSV to the gold Parquet folder, each file once, and its new partitions to ``table``.

    ``archive`` takes the consumed files, so that the folder that is listed stays short. The folder ``taken``
    gets the URIs of each micro-batch's files; ``read_taken`` gives them. ``rollup`` gets each micro-batch's
    dated rows, read back from gold.
    """
    ensure_folder(spark, silver)
    ensure_folder(spark, gold)
    landed = stream_crate_csv(spark, silver, schema, max_files, archive)

    notes = Intake(spark, silver, taken, checkpoint) if taken else None

    def ingest(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch.drop(FILE), gold, batch_id, table)
        if rollup:
            rollup.add(read_batch(batch.sparkSession, gold, batch_id), batch_id)
        if notes:
            notes.note(batch, batch_id)

    _finish(
        with_arrival(landed, keep_declared, *([file_of()] if notes else [])).writeStream.foreachBatch(ingest)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def number_arrivals(
    arrivals: DataFrame, *order: str, path: str, checkpoint: str
) -> None:
    """Number a stream of arrivals; each micro-batch goes on where the last one ended.

    A micro-batch is numbered in parallel and written to a folder of its own together with
    the total so far, which is all the next one reads. Running it again rewrites the same.
    """
    _seed(arrivals.sparkSession, f"{path}/arrivals", arrivals.schema.simpleString()[7:-1] + ",arrival_no:bigint")
    _seed(arrivals.sparkSession, f"{path}/totals", "total:bigint")

    def number(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = 0
        if batch_id > 0:
            before = spark.read.parquet(f"{path}/totals/batch={batch_id - 1}").first()["total"]
        numbered = with_position(batch, *order, name="arrival_no").withColumn(
            "arrival_no", F.col("arrival_no") + F.lit(before)
        )
        rows = f"{path}/arrivals/batch={batch_id}"
        numbered.write.mode("overwrite").parquet(rows)
        total = spark.read.parquet(rows).count() + before
        spark.range(1).select(F.lit(total).alias("total")).write.mode("overwrite").parquet(
            f"{path}/totals/batch={batch_id}"
        )

    _finish(
        arrivals.writeStream.foreachBatch(number).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def fired_batches(spark: SparkSession, path: str, threshold: int = 10) -> DataFrame:
    """The numbered arrivals whose batch has fired."""
    numbered = spark.read.parquet(f"{path}/arrivals").drop("batch")
    total = spark.read.parquet(f"{path}/totals").agg(F.coalesce(F.max("total"), F.lit(0))).scalar()
    return full_batches(numbered, total, threshold)


def fire_when_full(
    arrivals: DataFrame, job: Callable[[], None], path: str, checkpoint: str,
    threshold: int = 10, trigger: dict | None = None,
) -> StreamingQuery:
    """A stream that counts arrivals as they come and runs ``job`` once more than ``threshold`` wait.

    After the job nothing waits: it takes all that has arrived. What a micro-batch leaves waiting is
    written to a folder of its own, after the job, so a micro-batch that is run again counts from the
    same number and runs a job that must bear being repeated; ``gate_state`` gives the counts. Without
    ``trigger``, the arguments of the stream writer's trigger, the query ends when all arrivals are counted.
    """
    _seed(arrivals.sparkSession, f"{path}/gate", _GATE)

    def count(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = 0
        if batch_id > 0:
            before = spark.read.parquet(f"{path}/gate/batch={batch_id - 1}").first()["waiting"]
        came = batch.count()
        fired = before + came > threshold
        if fired:
            job()
        state = spark.range(1).select(
            F.lit(came).cast("bigint").alias("came"), F.lit(0 if fired else before + came).cast("bigint").alias("waiting"),
            F.lit(fired).alias("fired"),
        )
        state.write.mode("overwrite").parquet(f"{path}/gate/batch={batch_id}")

    return arrivals.writeStream.foreachBatch(count).option("checkpointLocation", checkpoint).trigger(
        **(trigger or {"availableNow": True})
    ).start()


def gate_state(spark: SparkSession, path: str) -> DataFrame:
    """``batch, came, waiting, fired`` of each micro-batch of the gate."""
    return spark.read.schema(f"{_GATE.replace(':', ' ')}, batch int").parquet(f"{path}/gate").where("batch >= 0")


def run_when_due(
    waiting: DataFrame, job: Callable[[], None], clear: Callable[[], None], threshold: int = 10
) -> bool:
    """Run ``job`` and ``clear`` the waiting list if more than ``threshold`` wait."""
    due = waiting.limit(threshold + 1).count() > threshold
    if due:
        job()
        clear()
    return due
