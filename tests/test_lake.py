"""Landing zones, routing, gold; and what goes wrong without their options."""

import csv
import datetime as dt
import io

import pytest
from pyspark.sql import functions as F

from cratelake.model import CRATE_FIELDS, CRATE_SCHEMA, LANDED_SCHEMA
from cratelake.operators.tracking import track_delivered
from cratelake.sources import csvfiles, events, files, gold, messages
from cratelake.streaming import flows


def _python_csv(path, records, fields=CRATE_FIELDS):
    """A file as Python's csv module writes it."""
    text = io.StringIO()
    writer = csv.writer(text)
    writer.writerow(fields)
    writer.writerows(records)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.getvalue().encode())


AWKWARD = {
    "crate_id": "000042", "contents": 'a "quoted", field', "additional_notes": "two\nlines",
    "customer_name": "  outer blanks  ", "temperature": "bad", "city": "Tucsón",
}


def test_foreign_files_keep_their_values(spark, crate, tmp_path):
    _python_csv(tmp_path / "unprocessed/creation_date=2023-12-08/a.csv",
                [crate(**AWKWARD, creation_date="1999-01-01")])
    landed = csvfiles.read_crate_csv(spark, str(tmp_path / "unprocessed"))
    row = csvfiles.with_arrival(landed, keep_declared=True).first()
    for name, value in AWKWARD.items():
        assert row[name] == value
    assert row["creation_date"] == dt.date(2023, 12, 8)
    assert row["declared_creation_date"] == "1999-01-01"


def test_raw_round_trip(spark, crate, tmp_path):
    records = [crate(**AWKWARD), crate(city=None), crate(city="")]
    df = spark.createDataFrame(records, CRATE_SCHEMA)
    csvfiles.write_raw(df, str(tmp_path / "raw"))
    back = csvfiles.read_crate_csv(spark, str(tmp_path / "raw")).collect()
    assert tuple(back[0]) == records[0]
    # Empty and missing cells look the same in CSV.
    assert [r["city"] for r in back[1:]] == [None, None]


def test_landing_twice_in_a_second_loses_nothing(spark, crate, tmp_path):
    df = spark.createDataFrame([crate()], CRATE_SCHEMA)
    for _ in range(2):
        csvfiles.write_raw(df, str(tmp_path / "raw"))
    assert csvfiles.read_crate_csv(spark, str(tmp_path / "raw")).count() == 2


def test_reordered_header_fails(spark, crate, tmp_path):
    _python_csv(tmp_path / "in/a.csv", [crate()], fields=CRATE_FIELDS[::-1])
    with pytest.raises(Exception, match="does not conform to the schema"):
        csvfiles.read_crate_csv(spark, str(tmp_path / "in")).collect()


def test_every_record_of_an_event_is_routed(spark):
    event = """{"Records": [
      {"eventTime": "2023-12-06T23:59:59.999Z", "s3": {"object": {"key": "raw/a.csv"}}},
      {"eventTime": "2023-12-07T00:00:00.000Z", "s3": {"object": {"key": "raw/x/b.csv"}}}]}"""
    routed = events.route_objects(spark.createDataFrame([(event,)], "event string"))
    assert [tuple(r) for r in routed.collect()] == [
        ("raw/a.csv", dt.date(2023, 12, 6), "unprocessed/creation_date=2023-12-06/a.csv"),
        ("raw/x/b.csv", dt.date(2023, 12, 7), "unprocessed/creation_date=2023-12-07/b.csv"),
    ]


def test_listing_finds_csv_files_at_any_depth(spark, crate, tmp_path):
    _python_csv(tmp_path / "in/x=1/a.csv", [crate()])
    _python_csv(tmp_path / "in/b.csv", [crate()])
    (tmp_path / "in/c.txt").write_text("no")
    found = files.list_files(spark, str(tmp_path / "in"))
    assert sorted(r["uri"].split("/in/")[1] for r in found.collect()) == ["b.csv", "x=1/a.csv"]
    assert found.columns == ["uri", "length", "modificationTime"]


def test_ingestion_is_incremental_and_exactly_once(spark, crate, tmp_path):
    silver, target, checkpoint = (str(tmp_path / n) for n in ("silver", "gold", "ck"))

    def ingest():
        flows.ingest_files(spark, silver, target, checkpoint, schema=CRATE_SCHEMA)

    ingest()  # nothing there yet
    _python_csv(tmp_path / "silver/creation_date=2023-12-08/a.csv", [crate()])
    ingest()
    ingest()
    assert gold.read_gold(spark, target).count() == 1
    _python_csv(tmp_path / "silver/creation_date=2023-12-08/b.csv", [crate(), crate()])
    _python_csv(tmp_path / "silver/creation_date=2023-12-09/a.csv", [crate(crate_id="x")])
    ingest()
    by_date = gold.read_gold(spark, target).groupBy("creation_date").count()
    assert {r[0].isoformat(): r[1] for r in by_date.collect()} == {
        "2023-12-08": 3, "2023-12-09": 1,
    }


def test_archive_takes_consumed_files(spark, crate, tmp_path):
    silver, target, checkpoint = (str(tmp_path / n) for n in ("silver", "gold", "ck"))
    for name in ("a", "b", "c"):
        _python_csv(tmp_path / f"silver/creation_date=2023-12-08/{name}.csv", [crate(crate_id=name)])
        flows.ingest_files(spark, silver, target, checkpoint, schema=CRATE_SCHEMA,
                           archive=str(tmp_path / "processed"))
    assert gold.read_gold(spark, target).count() == 3
    assert list((tmp_path / "processed").rglob("a.csv"))


def test_repair_makes_partitions_visible(spark, crate, tmp_path):
    path = str(tmp_path / "gold")
    day = F.col("creation_date").cast("date")
    df = spark.createDataFrame(
        [crate(creation_date=f"2023-12-0{d}") for d in (1, 2, 3)], CRATE_SCHEMA
    ).withColumn("creation_date", day)
    gold.write_gold(df, path)
    gold.create_table(spark, "repaired", path)
    assert spark.table("repaired").count() == 0
    gold.repair_table(spark, "repaired")
    assert spark.table("repaired").count() == 3
    gold.write_gold(df.limit(1).withColumn("creation_date", F.date_add("creation_date", 30)), path)
    gold.add_partitions(spark, "repaired", ["2023-12-31"])
    assert gold.partitions(spark, "repaired").count() == 4
    assert track_delivered(spark.table("repaired")).count() == 4


@pytest.fixture
def small_partitions(spark):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "300k")
    yield
    spark.conf.set(size, before)


def _skewed(spark, crate):
    """Four fifths of the rows on one date."""
    day = F.when(F.col("id") % 5 < 4, "2023-12-01").otherwise("2023-12-02").cast("date")
    record = dict(zip(CRATE_FIELDS, crate()))
    return spark.range(0, 40_000, 1, 8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("crate_id"),
        *[F.lit(record[name]).alias(name) for name in CRATE_FIELDS[1:-1]],
        day.alias("creation_date"),
    )


def _files_by_date(path):
    return [len(list((path / f"creation_date=2023-12-0{d}").rglob("*.parquet"))) for d in (1, 2)]


def test_a_date_with_most_rows_is_written_by_several_tasks(
    spark, crate, tmp_path, small_partitions
):
    gold.write_gold(_skewed(spark, crate), str(tmp_path / "gold"))
    hot, cold = _files_by_date(tmp_path / "gold")
    assert hot > cold >= 1
    assert gold.read_gold(spark, str(tmp_path / "gold")).count() == 40_000


def test_a_stream_splits_such_a_date_too(spark, crate, tmp_path, small_partitions):
    silver, target = str(tmp_path / "silver"), tmp_path / "gold"
    csvfiles.write_routed(_skewed(spark, crate), F.col("creation_date"), silver)
    flows.ingest_files(spark, silver, str(target), str(tmp_path / "ck"))
    hot, cold = _files_by_date(target)
    assert hot > cold >= 1
    assert gold.read_gold(spark, str(target)).count() == 40_000


def test_gold_scan_prunes_and_pushes_down(spark, crate, tmp_path):
    path = str(tmp_path / "gold")
    df = spark.createDataFrame([crate()], CRATE_SCHEMA).withColumn(
        "creation_date", F.col("creation_date").cast("date")
    )
    gold.write_gold(df, path)
    read = gold.read_gold(spark, path).where("creation_date = DATE'2023-12-01'")
    plan = track_delivered(read)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(shipment_status,Delivered)" in plan
    assert "PartitionFilters: [isnotnull(creation_date" in plan
    assert "handling_instructions" not in plan.split("ReadSchema")[1]


def test_schema_report(spark):
    report = gold.schema_report(spark.range(1).selectExpr("id", "'x' AS name"))
    assert [tuple(r) for r in report.collect()] == [(1, "id", "bigint"), (2, "name", "string")]


def test_scan_lands_and_acknowledges_each_message_once(spark, crate, tmp_path):
    queue, raw, acks, checkpoint = (str(tmp_path / n) for n in ("queue", "raw", "acks", "ck"))
    for batch in ("1", "2"):
        df = spark.createDataFrame([crate(crate_id=batch, **{"contents": 'x "y"'})], CRATE_SCHEMA)
        df = df.withColumns({"at": F.lit("2024-01-01"), "seq": F.col("crate_id")})
        messages.send_messages(messages.as_messages(df, "crate_id", "at", "seq"), queue)
        for _ in range(2):
            flows.scan_messages(messages.stream_messages(spark, queue), raw, acks, checkpoint)
    assert sorted(r[0] for r in flows.read_acks(spark, acks).collect()) == ["1", "2"]
    landed = csvfiles.read_crate_csv(spark, raw)
    assert sorted((r["crate_id"], r["contents"]) for r in landed.collect()) == [
        ("1", 'x "y"'), ("2", 'x "y"'),
    ]


def test_pipeline_from_queue_to_gold(spark, crate, tmp_path):
    queue, raw, acks, silver, target = (
        str(tmp_path / n) for n in ("queue", "raw", "acks", "silver", "gold")
    )
    df = spark.createDataFrame(
        [crate(crate_id=str(i), shipment_status="Delivered" if i % 2 else "In Transit")
         for i in range(20)], CRATE_SCHEMA,
    )
    queued = df.withColumns({"at": F.lit("2024-01-01"), "seq": F.col("crate_id")})
    messages.send_messages(messages.as_messages(queued, "crate_id", "at", "seq"), queue)
    for _ in range(2):
        flows.scan_messages(messages.stream_messages(spark, queue), raw, acks, str(tmp_path / "c1"))
        flows.route_files(spark, raw, silver, str(tmp_path / "c2"))
        flows.ingest_files(spark, silver, target, str(tmp_path / "c3"), schema=LANDED_SCHEMA)
    stored = gold.read_gold(spark, target)
    assert {r[0] for r in stored.select("creation_date").distinct().collect()} <= {
        dt.datetime.now(dt.timezone.utc).date(),
        dt.datetime.now(dt.timezone.utc).date() - dt.timedelta(days=1),
    }
    direct, through = track_delivered(df), track_delivered(stored)
    assert sorted(through.collect()) == sorted(direct.collect())
