"""FIFO deduplication: a message whose content was accepted less than ``interval`` ago is
dropped; once the interval has passed it is accepted again.

Whether a message counts depends on the last accepted one, so the rule is a fold in time
order. Contents are sorted and folded as they stream by, with nothing kept but the last accepted
time. A content with very many messages, which may be a large part of the table, is not left to
one task: each of its messages gets a pointer to the message accepted next if it is accepted
itself, and doubling the pointers reaches all accepted messages in about
log2(time span / interval) joins.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cratelake.session import cut, stored

GROUP_ROWS = 1_000_000  # messages of one content that a single task may fold
BROADCAST_KEYS = 10_000  # long contents up to this many are broadcast to split them off
TICKS = 16              # time slices per interval in which the next message is looked up


def span(interval: dt.timedelta) -> Column:
    """``interval`` as a literal to add to timestamps."""
    return F.make_dt_interval(secs=F.lit(interval.total_seconds()).cast("decimal(18,6)"))


def accepted_messages(
    messages: DataFrame,
    interval: dt.timedelta,
    *,
    key: str,
    ts: str,
    tie: str,
    group_rows: int = GROUP_ROWS,
    scratch: str | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """``(key, ts, tie)`` of the accepted messages. Equal times are ordered by ``tie``.

    ``tie`` identifies a message. A message without content, time or ``tie`` cannot be ordered
    and is not accepted, here and in streams alike; ``incomplete`` gives these. The three
    columns are stored once, in the folder ``scratch`` if given, which may go once the result is written.
    Where ``counted`` gives a stored table that has the messages' contents at least as often, long contents are
    found there, and the messages are stored only if there are any.
    """
    if interval <= dt.timedelta(0):
        raise ValueError("interval must be positive")
    rows = messages.select(
        F.col(key).alias("key"), F.col(ts).alias("ts"), F.col(tie).alias("tie")
    ).dropna()
    if counted is None:
        counted = rows = stored(rows, "messages", scratch)
    else:
        counted = counted.select(F.col(key).alias("key"))
    # Counting by a 64-bit hash moves little; a collision only sends a short content the
    # long way, which is exact too.
    hashed = F.xxhash64("key")
    found = 0
    if counted.count() > group_rows:
        long_keys = cut(
            counted.groupBy(hashed.alias("hash")).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > group_rows).select("hash")
        )
        found = long_keys.limit(BROADCAST_KEYS + 1).count()
    if found == 0:
        kept = _fold_sorted(rows, interval)
    else:
        if counted is not rows:
            rows = stored(rows, "messages", scratch)
        listed = F.broadcast(long_keys) if found <= BROADCAST_KEYS else long_keys
        marked = rows.withColumn("hash", hashed)
        short = marked.join(listed, "hash", "left_anti").drop("hash")
        long = marked.join(listed, "hash", "left_semi").drop("hash")
        kept = _fold_sorted(short, interval).unionByName(_fold_long(long, interval))
    return kept.select(
        F.col("key").alias(key), F.col("ts").alias(ts), F.col("tie").alias(tie)
    )


def incomplete(messages: DataFrame, *, key: str, ts: str, tie: str) -> DataFrame:
    """Messages that deduplication leaves out because one of the three is null."""
    return messages.where(F.col(key).isNull() | F.col(ts).isNull() | F.col(tie).isNull())


def deduplicate(
    messages: DataFrame, interval: dt.timedelta, *, key: str, ts: str, tie: str, **options
) -> DataFrame:
    """The accepted messages with all their columns; ``tie`` identifies a message."""
    kept = accepted_messages(messages, interval, key=key, ts=ts, tie=tie, **options)
    return messages.join(kept.select(tie), tie, "left_semi")


def _fold_sorted(rows: DataFrame, interval: dt.timedelta) -> DataFrame:
    """Fold of contents that are sorted into one task each, an Arrow batch at a time."""
    step = interval // dt.timedelta(microseconds=1)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, due = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            names, times = batch.column("key"), batch.column("ts")
            if not pa.types.is_timestamp(times.type):
                times = times.cast(pa.timestamp("us"))
            first = np.ones(batch.num_rows, bool)
            first[0] = last is None or names[0] != last
            first[1:] = names[1:].to_numpy(zero_copy_only=False) != names[:-1].to_numpy(zero_copy_only=False)
            last = names[-1]
            kept = []
            for at, (new, micros) in enumerate(zip(first.tolist(), times.cast(pa.int64()).to_pylist())):
                if new or micros >= due:
                    kept.append(at)
                    due = micros + step
            yield batch.take(pa.array(kept, pa.int64()))

    return rows.repartition("key").sortWithinPartitions("key", "ts", "tie").mapInArrow(fold, rows.schema)


def accepted_after(
    messages: DataFrame, earlier: DataFrame, interval: dt.timedelta,
    *, key: str, ts: str, tie: str, at_rest: bool = False, **options,
) -> DataFrame:
    """``(key, ts, tie)`` of ``messages`` accepted when the messages ``earlier`` were accepted before.

    Arrival counts: a message less than the interval after the last one accepted of its content is
    dropped, also if its time lies before that one. ``at_rest`` says that ``messages`` is a stored table.
    """
    last = earlier.groupBy(F.col(key)).agg(F.max(ts).alias("_last"))
    fresh = messages.select(key, ts, tie).join(last, key, "left").where(
        F.col("_last").isNull() | (F.col(ts) >= F.col("_last") + span(interval))
    )
    return accepted_messages(
        fresh, interval, key=key, ts=ts, tie=tie, counted=messages if at_rest else None, **options
    )


def _next_pointers(base: DataFrame, interval: dt.timedelta) -> DataFrame:
    """``(key, src, dst)``: the first message at least ``interval`` after each message.

    Messages and the times looked for meet per (key, tick); a group is bounded by the
    distinct times within one tick. Where the tick has no later message, the next tick that
    has one gives its first, found in a list of ticks that the time span bounds.
    """
    width = max(1, int(interval.total_seconds() * 1_000_000) // TICKS)
    tick = F.floor(F.unix_micros(F.col("at").cast("timestamp")) / width)
    points = base.select("key", F.col("ts").alias("at"), F.col("ts").alias("hit"),
                         F.lit(None).cast(base.schema["ts"].dataType).alias("src"))
    probes = base.select("key", (F.col("ts") + span(interval)).alias("at"),
                         F.lit(None).cast(base.schema["ts"].dataType).alias("hit"),
                         F.col("ts").alias("src"))
    mixed = points.unionByName(probes).withColumn("tick", tick)
    # Going back in time, a message comes before the probe for the same instant.
    backwards = Window.partitionBy("key", "tick").orderBy(
        F.col("at").desc(), F.col("src").asc_nulls_first()
    ).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    looked_up = mixed.withColumn("dst", F.min("hit").over(backwards)).where("src is not null")
    later = Window.partitionBy("key").orderBy(F.col("tick").desc()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    ticks = (
        mixed.groupBy("key", "tick").agg(F.min("hit").alias("first"))
        .select("key", "tick", F.min("first").over(later).alias("fallback"))
    )
    return (
        looked_up.join(ticks, ["key", "tick"])
        .select("key", "src", F.coalesce("dst", "fallback").alias("dst"))
        .where("dst is not null")
    )


def _fold_long(rows: DataFrame, interval: dt.timedelta) -> DataFrame:
    """Fold of contents with any number of messages, spread over time.

    ``jumps[j]`` goes 2**j accepted messages ahead. A jump is kept only for the first
    message of a content and for places the shorter jump can land on: later steps start
    nowhere else, and there are fewer such places at each level. No message has a longer
    chain than the first one, so the levels end when the first messages run out.
    """
    base = cut(rows.groupBy("key", "ts").agg(F.min("tie").alias("tie")))
    firsts = base.groupBy("key").agg(F.min("ts").alias("src"))
    started = firsts.withColumn("start", F.lit(True))
    level = cut(
        _next_pointers(base, interval).join(started, ["key", "src"], "left")
        .withColumn("start", F.coalesce("start", F.lit(False)))
    )
    jumps = []
    while not level.isEmpty():
        jumps.append(level)
        landing = level.select("key", F.col("dst").alias("src")).distinct()
        sources = level.where("start").unionByName(
            level.where("not start").join(landing, ["key", "src"], "left_semi")
        )
        onward = level.select("key", F.col("src").alias("dst"), F.col("dst").alias("to"))
        level = cut(
            sources.join(onward, ["key", "dst"])
            .select("key", "src", F.col("to").alias("dst"), "start")
        )
    reached = firsts.select("key", F.col("src").alias("ts"))
    for level in reversed(jumps):
        ahead = level.select("key", F.col("src").alias("ts"), "dst")
        reached = reached.join(ahead, ["key", "ts"], "left").select(
            "key", F.explode(F.array_compact(F.array("ts", "dst"))).alias("ts")
        )
    return base.join(reached, ["key", "ts"], "left_semi").select("key", "ts", "tie")
