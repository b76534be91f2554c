import json

from pyspark.sql import functions as F

from cratelake.model import CRATE_FIELDS, CRATE_SCHEMA, QUEUE_VIEW_FIELDS
from cratelake.operators import queue, records, tracking
from cratelake.sources import messages


def _crates(spark, *crates):
    return spark.createDataFrame(list(crates), CRATE_SCHEMA)


def test_canonical_record_renames_and_orders(spark, crate):
    form = _crates(spark, crate()).withColumnRenamed("city", "delivery_city")
    form = form.withColumn("submit", F.lit("x")).select(*sorted([*form.columns, "submit"]))
    result = records.canonical_record(form)
    assert result.columns == CRATE_FIELDS
    assert tuple(result.first()) == crate()


def test_strict_view_tells_missing_from_null(spark):
    full = {name: name for name in QUEUE_VIEW_FIELDS}
    bodies = {
        "ok": full, "null": {**full, "city": None}, "number": {**full, "crate_id": 5},
        "missing": {k: v for k, v in full.items() if k not in ("city", "state")},
    }
    sent = spark.createDataFrame(
        [(k, json.dumps(v, indent=2)) for k, v in bodies.items()] + [("broken", "{not json")],
        "message_id string, body string",
    )
    view = {r["message_id"]: r for r in records.inprogress_view(sent).collect()}
    assert set(view) == {"ok", "null", "number"}
    assert view["null"]["city"] is None
    assert view["number"]["crate_id"] == "5"
    rejects = {r["message_id"]: r["missing"] for r in records.inprogress_rejects(sent).collect()}
    assert rejects["missing"] == ["city", "state"]
    assert rejects["broken"] == QUEUE_VIEW_FIELDS


def test_validation_splits_every_record_once(spark, crate):
    cases = {
        "ok": {}, "blank": {"additional_notes": " "}, "short time": {"delivery_time": "10:20"},
        "empty": {"city": ""}, "null": {"weight": None}, "no day": {"return_date": "2023-02-30"},
        "slashes": {"creation_date": "12/01/2023"}, "hour": {"return_time": "24:00"},
    }
    df = _crates(spark, *[crate(crate_id=k, **v) for k, v in cases.items()])
    good = [r["crate_id"] for r in records.accepted(df).collect()]
    bad = {r["crate_id"]: r["reason"] for r in records.rejected(df).collect()}
    assert good == ["ok", "blank", "short time"]
    assert bad == {
        "empty": ["city is missing"], "null": ["weight is missing"],
        "no day": ["return_date is not a date"], "slashes": ["creation_date is not a date"],
        "hour": ["return_time is not a time"],
    }


def test_tracking_matches_the_status_to_the_letter(spark, crate):
    df = _crates(spark, crate(), crate(shipment_status="delivered"), crate(shipment_status=None))
    assert tracking.track_delivered(df).count() == 1
    assert tracking.track_delivered(df.union(df), limit=1).count() == 1


def test_result_as_text_keeps_nulls(spark):
    df = spark.sql("SELECT 1 AS a, DATE'2024-01-02' AS b, CAST(NULL AS INT) AS c")
    assert tuple(records.result_as_text(df).first()) == ("1", "2024-01-02", None)


def test_typed_view_turns_bad_text_into_null(spark, crate):
    df = _crates(spark, crate(temperature="bad", return_date="x"))
    row = records.typed_view(df).first()
    assert row["temperature"] is None and row["return_date"] is None
    assert str(row["weight"]) == "250.00" and row["crate_id"] == "000123"


def test_queue_round_trip_and_order(spark, crate, tmp_path):
    df = _crates(spark, crate(crate_id="2", contents='say "hi",\nÖ'), crate(crate_id="1"))
    df = df.withColumns({"seq": F.col("crate_id").cast("long"), "at": F.lit("2024-01-01 00:00:00.123456")})
    sent = messages.as_messages(df, "crate_id", "at", "seq")
    path = str(tmp_path / "queue")
    messages.send_messages(sent, path)
    read = messages.read_messages(spark, path)
    assert sorted(read.collect()) == sorted(sent.collect())
    acked = spark.createDataFrame([("1",)] * 3, "message_id string")
    assert [r["message_id"] for r in queue.peek(read).collect()] == ["1", "2"]
    assert [r["message_id"] for r in queue.head(queue.pending(read, acked)).collect()] == ["2"]
    parsed = messages.parsed(read).where("message_id = '2'").first()
    assert parsed["contents"] == 'say "hi",\nÖ'


def test_empty_queue(spark, crate):
    none = _crates(spark, crate()).limit(0)
    note = queue.scan_notifications(none)
    assert note.count() == 0
    assert tuple(queue.waiting(note).first()) == (0, False)
