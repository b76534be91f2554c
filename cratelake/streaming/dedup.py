"""FIFO deduplication of a stream: by state per content, or micro-batch by micro-batch."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from cratelake.operators.dedup import accepted_after
from cratelake.sources.files import delete, ensure_folder, exists, folders

BUCKETS = 256  # parts of the folded state, at most
BUCKET_ROWS = 100_000  # contents of a part, at least
SLOTS = 16_384  # groups by hash that hold the state of a stream's contents; fixed, as checkpoints depend on it
FOLD_EVERY = 8  # micro-batches whose accepted messages are read beside the folded state


def deduplicate_stream(
    messages: DataFrame,
    interval: dt.timedelta,
    *,
    key: str,
    ts: str,
    tie: str,
    lateness: dt.timedelta | None = None,
) -> DataFrame:
    """``(key, ts, tie)`` of the accepted messages, batch by batch in arrival order.

    The state of a content is the time of its last accepted message. Without ``lateness``
    it is kept for good and no message is lost however late it comes. With it, a content's
    state goes once the stream has moved past the interval, at the latest with that of the contents it
    shares a slot with, and messages later than that are lost; give it only where arrival order is guaranteed.

    Contents share ``SLOTS`` groups by hash, each with one state, so that a micro-batch of very many
    contents is not as many calls. One task handles a slot's messages of one micro-batch, narrow columns
    each; the source's maxFilesPerTrigger or maxBytesPerTrigger bounds them. For large
    micro-batches use deduplicate_batches. Contents of types that a hash table may tell apart otherwise
    than Spark does have a group each.
    """
    step = int(interval.total_seconds() * 1_000_000)
    rows = messages.select(
        F.col(key).alias("key"), F.col(ts).cast("timestamp").alias("ts"), F.col(tie).alias("tie")
    ).dropna().withColumn("us", F.unix_micros("ts"))
    out = T.StructType(list(rows.schema)[:3])
    kind = rows.schema["key"].dataType
    shared = kind == T.StringType() or isinstance(kind, (T.BinaryType, T.IntegralType, T.DateType))
    rows = rows.withColumn("slot", F.pmod(F.xxhash64("key"), F.lit(SLOTS)) if shared else F.col("key"))
    timeout = GroupStateTimeout.NoTimeout
    if lateness is not None:
        rows = rows.withWatermark("ts", f"{int(lateness.total_seconds())} seconds")
        timeout = GroupStateTimeout.EventTimeTimeout

    def fold(
        slot: tuple, parts: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        first, *more = parts
        arrived = pd.concat([first, *more], ignore_index=True) if more else first
        codes, names = np.zeros(len(arrived), np.int64), [0]
        if shared:
            codes, names = pd.factorize(arrived["key"])
            names = names.tolist()
        last = _read_times(state.get[0]) if state.exists else {}
        micros = arrived["us"].to_numpy()  # times as the session shows them may repeat an hour
        order = np.lexsort((arrived["tie"].to_numpy(), micros, codes))
        kept, here, due = [], -1, 0
        for at, code, us in zip(order.tolist(), codes[order].tolist(), micros[order].tolist()):
            if code != here:
                here, name = code, names[code]
                due = last[name] + step if name in last else us
            if us >= due:
                kept.append(at)
                last[name] = us
                due = us + step
        if lateness is not None:
            passed = state.getCurrentWatermarkMs()
            last = {name: us for name, us in last.items() if (us + step) // 1000 + 1 > passed}
        if last:
            state.update((_written_times(last),))
            if lateness is not None:
                state.setTimeoutTimestamp((max(last.values()) + step) // 1000 + 1)
        elif state.exists:
            state.remove()
        if kept:
            yield arrived[["key", "ts", "tie"]].iloc[kept]

    return rows.groupBy("slot").applyInPandasWithState(
        fold,
        out,
        "last BINARY",
        "append",
        timeout,
    ).select(F.col("key").alias(key), F.col("ts").alias(ts), F.col("tie").alias(tie))


def _written_times(last: dict) -> bytes:
    """Contents and the times they were last accepted, as an Arrow stream."""
    batch = pa.record_batch([pa.array(list(last)), pa.array(list(last.values()), pa.int64())], ["key", "us"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as stream:
        stream.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _read_times(written: bytes) -> dict:
    table = pa.ipc.open_stream(bytes(written)).read_all()
    return dict(zip(table["key"].to_pylist(), table["us"].to_pylist()))


def deduplicate_batches(
    messages: DataFrame,
    interval: dt.timedelta,
    *,
    key: str,
    ts: str,
    tie: str,
    path: str,
    checkpoint: str,
    lateness: dt.timedelta | None = None,
    **options: int,
) -> None:
    """The same for large micro-batches, which may hold one content very often.

    Each micro-batch is stored, stripped of what the last accepted messages rule out, and
    folded like a table. What it accepts is also the log of the state: the last accepted time of a
    content is the latest in the folded state and in what was accepted since. Every ``FOLD_EVERY``
    micro-batches the log is folded into a new state, with ``lateness`` leaving out times that can
    no longer matter. Every step writes a folder of the micro-batch's own, so running it again
    changes nothing, and what it has accepted is not worked out again. What no later run can ask for is removed.

    The rows are stored first because they are read several times. A message later than
    ``lateness`` is not lost here; at worst it is accepted again.
    """
    start_batches(
        messages, interval, key=key, ts=ts, tie=tie, path=path, checkpoint=checkpoint, lateness=lateness, **options
    ).awaitTermination()


def start_batches(
    messages: DataFrame,
    interval: dt.timedelta,
    *,
    key: str,
    ts: str,
    tie: str,
    path: str,
    checkpoint: str,
    lateness: dt.timedelta | None = None,
    trigger: dict | None = None,
    **options: int,
) -> StreamingQuery:
    """``deduplicate_batches`` as a running query, by default until all that has arrived is taken.

    ``trigger`` holds the arguments of the stream writer's trigger, so ``{"processingTime": "1 minute"}`` goes on;
    ``stream_accepted`` gives what is accepted to the streams that follow.
    """
    spark = messages.sparkSession
    if not folders(spark, f"{path}/accepted"):
        empty = spark.createDataFrame([], messages.select(key, ts, tie).schema)
        _store(spark, empty, f"{path}/accepted/batch=-1")

    def accept(batch: DataFrame, batch_id: int) -> None:
        if exists(spark, f"{path}/accepted/batch={batch_id}/_SUCCESS"):
            return  # done by a run that stopped before it was committed; streams may have read it
        arrived = _store(spark, batch.select(
            F.col(key).alias("key"), F.col(ts).alias("ts"), F.col(tie).alias("tie")
        ).dropna(), f"{path}/arrived/batch={batch_id}")
        state = _State(spark, path, interval, lateness, key, ts)
        kept = accepted_after(
            arrived, state.before(batch_id, arrived), interval, key="key", ts="ts", tie="tie", at_rest=True, **options
        )
        _store(spark, kept.select(
            F.col("key").alias(key), F.col("ts").alias(ts), F.col("tie").alias(tie)
        ), f"{path}/accepted/batch={batch_id}")
        delete(spark, f"{path}/arrived/batch={batch_id - 1}")

    return messages.writeStream.foreachBatch(accept).option("checkpointLocation", checkpoint).trigger(
        **(trigger or {"availableNow": True})
    ).start()


def read_accepted(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/accepted").drop("batch")


def stream_accepted(spark: SparkSession, path: str, schema: T.StructType, max_files: int = 1000) -> DataFrame:
    """What ``start_batches`` accepts below ``path``, as a stream: each message once, as a completed
    micro-batch is never written again."""
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
        .option("recursiveFileLookup", "true").parquet(f"{path}/accepted")
    )


class _State:
    """The last accepted time of each content: a folded part, and what was accepted since.

    The folded part through micro-batch n lies in ``last/batch=n``, cut into as many buckets by hash as
    its size asks for, so that a small micro-batch reads few of them.
    """

    def __init__(
        self, spark: SparkSession, path: str, interval: dt.timedelta, lateness: dt.timedelta | None, key: str, ts: str
    ):
        self.spark, self.path, self.key, self.ts = spark, path, key, ts
        self.keep = None if lateness is None else interval + lateness

    def before(self, batch_id: int, arrived: DataFrame) -> DataFrame:
        """``key, ts`` of what was accepted before the micro-batch, the contents of ``arrived`` among them."""
        folded = self._folded(batch_id)
        through = max(folded, default=-1)
        if batch_id - 1 - through >= FOLD_EVERY:
            through = self._fold(through, batch_id - 1, arrived)
            folded.append(through)
        for old in sorted(folded)[:-1]:  # the newest is complete, and no later micro-batch asks for others
            delete(self.spark, f"{self.path}/last/batch={old}")
        touched = None
        if through >= 0 and (parts := self._parts(through)) > 1:
            touched = [r[0] for r in arrived.select(_bucket(parts)).distinct().collect()]  # BUCKETS at most
        return self._read(through, batch_id, arrived, touched)

    def _folded(self, batch_id: int) -> list[int]:
        """The earlier micro-batches through which a complete folded part goes."""
        found = (int(x.split("=")[-1]) for x in folders(self.spark, f"{self.path}/last/batch=*"))
        return [x for x in found if x < batch_id and exists(self.spark, f"{self.path}/last/batch={x}/_SUCCESS")]

    def _parts(self, through: int) -> int:
        return int(folders(self.spark, f"{self.path}/last/batch={through}/_of-*")[0].rsplit("-", 1)[1])

    def _read(self, through: int, batch_id: int, like: DataFrame, touched: list[int] | None) -> DataFrame:
        schema = like.select("key", "ts").schema
        rows = self.spark.createDataFrame([], schema)
        numbers = range(max(through, -1) + 1, batch_id)
        accepted = [x for n in numbers for x in folders(self.spark, f"{self.path}/accepted/batch={n}")]
        if accepted:
            names = T.StructType([T.StructField(self.key, schema["key"].dataType), T.StructField(self.ts, schema["ts"].dataType)])
            rows = self.spark.read.schema(names).parquet(*accepted).toDF("key", "ts")
        if through >= 0:
            wanted = "*" if touched is None else "{" + ",".join(map(str, touched)) + "}"
            if parts := folders(self.spark, f"{self.path}/last/batch={through}/bucket={wanted}"):
                rows = rows.unionByName(self.spark.read.schema(schema).parquet(*parts))
        return rows

    def _fold(self, through: int, upto: int, like: DataFrame) -> int:
        target = f"{self.path}/last/batch={upto}"
        rows = self._read(through, upto + 1, like, None).groupBy("key").agg(F.max("ts").alias("ts"))
        if self.keep is not None:
            newest = rows.agg(F.max("ts")).first()[0]
            if newest is not None:
                rows = rows.where(F.col("ts") > F.lit(newest - self.keep))
        known = _store(self.spark, rows, f"{self.path}/folding")
        parts = max(1, min(BUCKETS, known.count() // BUCKET_ROWS))
        delete(self.spark, target)  # of a run that stopped here
        ensure_folder(self.spark, f"{target}/_of-{parts}")
        known.withColumn("bucket", _bucket(parts)).hint("rebalance", "bucket").write.mode("append").partitionBy(
            "bucket"
        ).parquet(target)
        delete(self.spark, f"{self.path}/folding")
        return upto


def _bucket(parts: int):
    return F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int").alias("bucket")


def _store(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
