import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cratelake.operators import batches, dedup
from cratelake.streaming import flows
from cratelake.streaming.dedup import deduplicate_batches, deduplicate_stream, read_accepted

START = dt.datetime(2024, 1, 1)


def brute(rows, interval):
    """The rule, row by row."""
    last, kept = {}, set()
    for key, ts, tie in sorted(rows, key=lambda r: (r[1], r[2])):
        if key not in last or ts >= last[key] + interval:
            last[key] = ts
            kept.add(tie)
    return kept


def make(seed, n, span_s, keys=5, step_s=1):
    rng = random.Random(seed)
    return [
        # The first key has about half of all rows.
        (f"k{rng.choice([0] * keys + list(range(keys)))}",
         START + dt.timedelta(seconds=rng.randrange(0, span_s, step_s)), i)
        for i in range(n)
    ]


def frame(spark, rows):
    return spark.createDataFrame(rows, "content string, ts timestamp, id int")


@pytest.mark.parametrize("group_rows, span_s, step_s, minutes", [
    (4096, 86_400, 1, 5), (4096, 3_600, 60, 5), (4096, 60, 1, 5), (4096, 100_000, 300, 10),
    (150, 86_400, 1, 5), (150, 600, 1, 5),
    (0, 3_600, 1, 5), (0, 3_600, 60, 5), (0, 100_000, 300, 10), (0, 60, 1, 5),
])
def test_fold_equals_the_rule(spark, group_rows, span_s, step_s, minutes):
    rows = make(span_s + minutes, 800, span_s, step_s=step_s)
    interval = dt.timedelta(minutes=minutes)
    found = dedup.accepted_messages(
        frame(spark, rows), interval, key="content", ts="ts", tie="id", group_rows=group_rows
    )
    assert sorted(r["id"] for r in found.collect()) == sorted(brute(rows, interval))


@pytest.mark.parametrize("group_rows", [4096, 0])
def test_interval_end_is_accepted_and_ties_go_to_the_first(spark, group_rows):
    five = dt.timedelta(minutes=5)
    rows = [("a", START, 2), ("a", START, 1), ("a", START + five - dt.timedelta(microseconds=1), 3),
            ("a", START + five, 4), ("a", START + five, 5), ("b", START, 6)]
    found = dedup.deduplicate(
        frame(spark, rows), five, key="content", ts="ts", tie="id", group_rows=group_rows
    )
    assert found.columns == ["id", "content", "ts"]
    assert sorted(r["id"] for r in found.collect()) == [1, 4, 6]


def test_evenly_spaced_messages_do_not_merge(spark):
    """Chains that never meet: the slowest case for pointer doubling."""
    rows = [("a", START + dt.timedelta(seconds=7 * i), i) for i in range(600)]
    interval = dt.timedelta(seconds=40)
    found = dedup.accepted_messages(
        frame(spark, rows), interval, key="content", ts="ts", tie="id", group_rows=0
    )
    assert sorted(r["id"] for r in found.collect()) == sorted(brute(rows, interval))


def test_interval_must_be_positive(spark):
    with pytest.raises(ValueError):
        dedup.accepted_messages(
            frame(spark, []), dt.timedelta(0), key="content", ts="ts", tie="id"
        )


def _write_in_order(spark, rows, path, files):
    """One file after another, in arrival order."""
    rows = sorted(rows, key=lambda r: (r[1], r[2]))
    size = -(-len(rows) // files)
    for i in range(files):
        part = frame(spark, rows[i * size:(i + 1) * size]).coalesce(1)
        part.write.mode("append").parquet(path)
    return spark.readStream.schema("content string, ts timestamp, id int").option(
        "maxFilesPerTrigger", 1
    ).parquet(path)


@pytest.mark.parametrize("lateness", [None, dt.timedelta(hours=1)])
def test_stream_equals_the_rule_over_several_batches(spark, tmp_path, lateness):
    rows = make(3, 600, 7_200)
    interval = dt.timedelta(minutes=5)
    stream = _write_in_order(spark, rows, str(tmp_path / "in"), 4)
    kept = deduplicate_stream(
        stream, interval, key="content", ts="ts", tie="id", lateness=lateness
    )
    out = str(tmp_path / "out")
    kept.writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", str(tmp_path / "ck")
    ).trigger(availableNow=True).start().awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == sorted(brute(rows, interval))


@pytest.mark.parametrize("lateness", [None, dt.timedelta(0)])
@pytest.mark.parametrize("group_rows", [4096, 0])
def test_micro_batches_equal_the_rule(spark, tmp_path, lateness, group_rows):
    rows = make(5, 300, 3_600)
    interval = dt.timedelta(minutes=5)
    stream = _write_in_order(spark, rows, str(tmp_path / "in"), 3)
    path, checkpoint = str(tmp_path / "out"), str(tmp_path / "ck")
    for _ in range(2):
        deduplicate_batches(
            stream, interval, key="content", ts="ts", tie="id", path=path,
            checkpoint=checkpoint, lateness=lateness, group_rows=group_rows,
        )
    assert sorted(r["id"] for r in read_accepted(spark, path).collect()) == sorted(brute(rows, interval))


def test_both_streams_drop_a_late_message_that_is_within_the_interval(spark, tmp_path):
    """Arrival decides, not the time stated: a late message meets what was accepted before."""
    minute = dt.timedelta(minutes=1)
    batches_in = [[("a", START + 10 * minute, 1)], [("a", START, 2), ("a", START + 15 * minute, 3)]]
    for part in batches_in:
        frame(spark, part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("content string, ts timestamp, id int").option(
        "maxFilesPerTrigger", 1
    ).parquet(str(tmp_path / "in"))
    names = {"key": "content", "ts": "ts", "tie": "id"}
    deduplicate_batches(
        stream, 5 * minute, **names, path=str(tmp_path / "b"), checkpoint=str(tmp_path / "c1")
    )
    deduplicate_stream(stream, 5 * minute, **names).writeStream.format("parquet").option(
        "path", str(tmp_path / "s")
    ).option("checkpointLocation", str(tmp_path / "c2")).trigger(
        availableNow=True
    ).start().awaitTermination()
    for found in (read_accepted(spark, str(tmp_path / "b")), spark.read.parquet(str(tmp_path / "s"))):
        assert sorted(r["id"] for r in found.collect()) == [1, 3]


@pytest.mark.parametrize("n, fired", [(0, 0), (10, 0), (11, 1), (35, 3)])
def test_batches_fire_at_eleven(spark, n, fired):
    df = frame(spark, [("a", START, i) for i in range(n)])
    found = batches.count_batches(df, "ts", "id").collect()
    assert len(found) == 11 * fired
    assert {r["batch_id"] for r in found} == set(range(fired))
    assert all(r["batch_id"] == r["id"] // 11 for r in found)


def test_batches_of_a_stream_go_on_across_micro_batches(spark, tmp_path):
    rows = make(4, 100, 1_000)
    stream = _write_in_order(spark, rows, str(tmp_path / "in"), 3)
    path, checkpoint = str(tmp_path / "numbered"), str(tmp_path / "ck")
    flows.number_arrivals(stream, "ts", "id", path=path, checkpoint=checkpoint)
    flows.number_arrivals(stream, "ts", "id", path=path, checkpoint=checkpoint)
    found = flows.fired_batches(spark, path).orderBy("arrival_no").collect()
    expected = [r[2] for r in sorted(rows, key=lambda r: (r[1], r[2]))][:99]
    assert [r["id"] for r in found] == expected
    assert [r["batch_id"] for r in found] == [i // 11 for i in range(99)]


def test_gate_runs_only_above_the_threshold(spark):
    calls = []
    for n in (10, 11):
        due = flows.run_when_due(
            spark.range(n), lambda: calls.append("job"), lambda: calls.append("clear")
        )
        assert due == (n == 11)
    assert calls == ["job", "clear"]


@pytest.mark.parametrize("rows_per_batch", [1, 7])
def test_fold_goes_on_across_arrow_batches(spark, rows_per_batch):
    rows = make(8, 500, 3_600)
    interval = dt.timedelta(minutes=5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows_per_batch)
    try:
        found = dedup.accepted_messages(frame(spark, rows), interval, key="content", ts="ts", tie="id")
        assert sorted(r["id"] for r in found.collect()) == sorted(brute(rows, interval))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_micro_batches_leave_no_more_state_the_longer_they_run(spark, tmp_path):
    rows = make(9, 200, 7_200)
    interval = dt.timedelta(minutes=5)
    stream = _write_in_order(spark, rows, str(tmp_path / "in"), 10)
    path = tmp_path / "out"
    deduplicate_batches(
        stream, interval, key="content", ts="ts", tie="id", path=str(path), checkpoint=str(tmp_path / "ck")
    )
    assert sorted(r["id"] for r in read_accepted(spark, str(path)).collect()) == sorted(brute(rows, interval))
    parts = [p.name for p in path.glob("last/batch=*/bucket=*")]
    assert parts and max(parts.count(p) for p in set(parts)) <= 2
    assert len(list(path.glob("arrived/batch=*"))) == 1


def test_accepted_is_empty_before_the_first_message(spark, tmp_path):
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema("content string, ts timestamp, id int").parquet(str(tmp_path / "in"))
    deduplicate_batches(
        stream, dt.timedelta(minutes=5), key="content", ts="ts", tie="id",
        path=str(tmp_path / "out"), checkpoint=str(tmp_path / "ck"),
    )
    assert read_accepted(spark, str(tmp_path / "out")).count() == 0
