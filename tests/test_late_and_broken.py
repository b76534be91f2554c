"""What arrives late or broken is neither lost nor taken for good."""

import datetime as dt
import os
import time
import urllib.parse

import pytest
from pyspark.sql import functions as F

from cratelake.functions import keys
from cratelake.operators import dedup, records
from cratelake.sources import csvfiles, events, gold, messages
from cratelake.streaming import flows
from cratelake.streaming.dedup import deduplicate_stream

WEEK = 8 * 86_400


def _age(folder, seconds):
    old = time.time() - seconds
    for name in os.listdir(folder):
        if name.startswith("part-"):
            os.utime(os.path.join(folder, name), (old, old))


def test_old_files_that_come_second_are_taken(spark, tmp_path, crate):
    silver, gold, check = (str(tmp_path / x) for x in ("silver", "gold", "check"))
    for n, age in ((1, 0), (2, WEEK)):
        part = spark.createDataFrame([crate(crate_id=str(n))], csvfiles.CRATE_SCHEMA)
        folder = f"{silver}/creation_date=2024-01-0{n}"
        csvfiles.write_raw(part, folder)
        _age(folder, age)
        flows.ingest_files(spark, silver, gold, check, schema=csvfiles.CRATE_SCHEMA)
    assert {r["crate_id"] for r in spark.read.parquet(gold).collect()} == {"1", "2"}


def test_old_messages_that_come_second_are_scanned(spark, tmp_path):
    queue, raw, acks, check = (str(tmp_path / x) for x in ("queue", "raw", "acks", "check"))
    for n, age in (("new", 0), ("old", WEEK)):
        body = '{"crate_id": "%s"}' % n
        sent = spark.createDataFrame([(n, dt.datetime(2024, 1, 1), 1, body), (n + "-bad", dt.datetime(2024, 1, 1), 2, "{not json"), (n + "-null", dt.datetime(2024, 1, 1), 3, None)],
                                     "message_id string, sent_ts timestamp, seq long, body string")
        before = set(os.listdir(queue)) if os.path.isdir(queue) else set()
        messages.send_messages(sent.coalesce(1), queue)
        for name in set(os.listdir(queue)) - before:
            old = time.time() - age
            os.utime(os.path.join(queue, name), (old, old))
        flows.scan_messages(messages.stream_messages(spark, queue), raw, acks, check)
    assert {r[0] for r in flows.read_acks(spark, acks).collect()} == {"new", "old"}
    assert {r["crate_id"] for r in csvfiles.read_crate_csv(spark, raw).collect()} == {"new", "old"}
    refused = {(r["message_id"], r["body"]) for r in flows.read_rejects(spark, f"{acks}-rejects").collect()}
    assert refused == {(n + e, b) for n in ("new", "old") for e, b in (("-bad", "{not json"), ("-null", None))}


def test_broken_events_are_given_back(spark):
    good = '{"Records":[{"eventTime":"2024-01-02T03:04:05.000000Z","s3":{"object":{"key":"raw/a.csv"}}},{"eventTime":"2024-01-02T03:04:05Z","s3":{"object":{"key":"raw/b.csv"}}}]}'
    df = spark.createDataFrame([(good,), ("{oops",), (None,), ('{"Records":[]}',)], "event string")
    assert [r["object_key"] for r in events.route_objects(df).collect()] == ["raw/a.csv"]
    left = sorted((r["object_key"] or "", r["reason"]) for r in events.route_rejects(df).collect())
    assert left == [("", "no object")] * 3 + [("raw/b.csv", "no event time")]


def test_url_decoding_takes_stray_signs(spark):
    texts = ["a%20b%zz", "%", "%%41", "a+b%2B", "100%", "%e4%bd%a0%g", "plain", "", "%2", "%25zz"]
    df = spark.createDataFrame([(t,) for t in texts], "k string")
    got = df.select("k", keys.url_decoded(F.col("k")).alias("d")).collect()
    assert {r["k"]: r["d"] for r in got} == {t: urllib.parse.unquote(t) for t in texts}


@pytest.mark.parametrize("group_rows", [0, 1, 4096])
def test_incomplete_messages_are_left_out_alike(spark, group_rows):
    at = dt.datetime(2024, 1, 1)
    rows = [("a", at, 1), ("a", None, 2), (None, at, 3), ("a", at, None), ("a", at + dt.timedelta(hours=1), 5), (None, None, 6)]
    df = spark.createDataFrame(rows, "k string, t timestamp, n int")
    got = dedup.accepted_messages(df, dt.timedelta(minutes=5), key="k", ts="t", tie="n", group_rows=group_rows)
    assert sorted(r["n"] for r in got.collect()) == [1, 5]
    assert dedup.incomplete(df, key="k", ts="t", tie="n").count() == 4


def test_stream_is_right_when_clocks_go_back(spark, tmp_path):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 31 messages, 6 minutes apart, over the hour that the clocks show twice.
        df = spark.range(31).select(F.lit("a").alias("k"), F.timestamp_seconds(F.lit(1730606400) + F.col("id") * 360).alias("t"), "id")
        df.write.parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
        found = deduplicate_stream(stream, dt.timedelta(minutes=5), key="k", ts="t", tie="id", lateness=dt.timedelta(hours=1))
        found.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
        assert spark.read.parquet(str(tmp_path / "out")).count() == 31
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_the_last_of_repeated_fields_counts_everywhere(spark):
    fields = ", ".join(f'"{x}": "v"' for x in records.QUEUE_VIEW_FIELDS[1:])
    name = records.QUEUE_VIEW_FIELDS[0]
    body = '{"%s": "1", %s, "%s": "2"}' % (name, fields, name)
    view = records.inprogress_view(spark.createDataFrame([("m", body)], "message_id string, body string")).collect()
    assert [r[name] for r in view] == ["2"]


def test_files_below_no_date_are_kept_apart(spark, tmp_path, crate):
    silver, target, check = (str(tmp_path / x) for x in ("silver", "gold", "check"))
    for n, folder in (("1", "creation_date=2024-01-01"), ("2", "lost"), ("3", "creation_date=soon")):
        csvfiles.write_raw(spark.createDataFrame([crate(crate_id=n)], csvfiles.CRATE_SCHEMA), f"{silver}/{folder}")
    gold.create_table(spark, "dated", target, batched=True)
    flows.ingest_files(spark, silver, target, check, schema=csvfiles.CRATE_SCHEMA, table="dated")
    assert [r["crate_id"] for r in spark.table("dated").collect()] == ["1"]
    assert {r["crate_id"] for r in gold.undated(spark, target).collect()} == {"2", "3"}


def test_a_file_without_line_breaks_reads_the_same_when_split(spark, tmp_path, crate):
    rows = [crate(crate_id=str(i), contents='a "quoted", word') for i in range(200)]
    csvfiles.write_raw(spark.createDataFrame(rows, csvfiles.CRATE_SCHEMA).coalesce(1), str(tmp_path / "raw"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        split = csvfiles.read_crate_csv(spark, str(tmp_path / "raw"), line_breaks=False)
        assert split.rdd.getNumPartitions() > 1
        assert sorted(map(tuple, split.collect())) == sorted(rows)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
