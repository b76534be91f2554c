import datetime as dt
import urllib.parse
from base64 import b64encode

import pytest
from pyspark.sql import functions as F

from cratelake.functions import dates, keys, payload, text


def value(spark, column, **inputs):
    row = spark.range(1).select(*[
        F.lit(v).cast("string" if v is None else None or _kind(v)).alias(k)
        for k, v in inputs.items()
    ] or ["id"])
    return row.select(column.alias("v")).first()["v"]


def _kind(v):
    return {str: "string", dt.datetime: "timestamp", int: "int", float: "double"}[type(v)]


def test_timestamp_text(spark):
    ts = dt.datetime(2023, 12, 6, 18, 52, 57)
    assert value(spark, dates.timestamp_text(F.col("t")), t=ts) == "2023-12-06 18:52:57"
    assert value(spark, dates.timestamp_text(F.col("t"), "%Y-%m-%d"), t=ts) == "2023-12-06"
    assert value(spark, dates.compact_timestamp(F.col("t")), t=ts) == "20231206185257"
    assert value(spark, dates.timestamp_text(F.col("t").cast("timestamp")), t=None) is None


@pytest.mark.parametrize("given, day", [
    ("2023-12-06T23:59:59.123Z", dt.date(2023, 12, 6)),
    ("2023-12-06T00:00:00.123456Z", dt.date(2023, 12, 6)),
    ("2023-12-06 00:00:00", None),
    ("soon", None),
    (None, None),
])
def test_event_date(spark, given, day):
    assert value(spark, dates.event_date(F.col("t")), t=given) == day


def test_week_later(spark):
    assert value(spark, dates.days_later(F.to_date(F.lit("2023-12-27")))) == dt.date(2024, 1, 3)


@pytest.mark.parametrize("key", ["raw/a.csv", "a.csv", "raw/b/c d.csv", "raw/"])
def test_key_parts(spark, key):
    assert value(spark, keys.basename(F.col("k")), k=key) == key.split("/")[-1]
    assert value(spark, keys.archive_key(F.col("k")), k=key) == (
        "processed/" + "/".join(key.split("/")[1:])
    )


def test_uri_parts(spark):
    uri = "s3://silver/unprocessed/creation_date=2023-12-08/a.csv"
    assert value(spark, keys.uri_bucket(F.col("u")), u=uri) == "silver"
    assert value(spark, keys.uri_key(F.col("u")), u=uri) == uri.removeprefix("s3://silver/")
    assert value(spark, keys.uri_key(F.col("u")), u="file:/x") is None


@pytest.mark.parametrize("key", ["a%20b.csv", "a+b.csv", "a%2Bb%C3%A9.csv", "100%.csv", "plain"])
def test_url_decoding_keeps_plus_and_bad_sequences(spark, key):
    assert value(spark, keys.url_decoded(F.col("k")), k=key) == urllib.parse.unquote(key)


def test_silver_and_bronze_keys(spark):
    silver = keys.silver_key(F.lit("2023-12-08"), F.col("k"))
    assert value(spark, silver, k="raw/a.csv") == "unprocessed/creation_date=2023-12-08/a.csv"
    ts = dt.datetime(2023, 12, 6, 18, 52, 57)
    assert value(spark, keys.bronze_key(F.col("t")), t=ts) == "raw/csv_data_20231206185257.csv"


@pytest.mark.parametrize("given", ["1", "12", "123", "1234", ""])
def test_zero_padding_never_truncates(spark, given):
    assert value(spark, text.zero_padded(F.col("s")), s=given) == given.zfill(3)


def test_base64_is_one_line(spark):
    given = "é and more " * 30
    expected = b64encode(given.encode()).decode()
    assert value(spark, text.base64_text(F.col("s")), s=given) == expected


@pytest.mark.parametrize("given, expected", [
    ("3.45 C", "3.45"), ("-1 C", "-1.00"), ("bad", None), ("3.45 kg", None), (None, None),
])
def test_quantity_value(spark, given, expected):
    found = value(spark, text.quantity_value(F.col("s"), "C", 6), s=given)
    assert (None if found is None else str(found)) == expected


def test_quantity_text(spark):
    assert value(spark, text.quantity_text(F.col("x"), "kg"), x=250.0) == "250.00 kg"
    assert value(spark, text.quantity_text(F.col("x"), "C", 6), x=3.456) == "3.46 C"


def test_content_hash_is_stable(spark):
    assert value(spark, text.content_hash(F.col("s")), s="{}") == (
        "44136fa355b3678a1146ad16f7e8649e94fb4fc21fe77e8310c060f61caaff8a"
    )


def test_messages(spark):
    scan = text.scan_completed_text(F.col("s"))
    assert value(spark, scan, s="9") == "QR Code Scan Completed for Crate id: 9"
    assert value(spark, scan, s=None) == "QR Code Scan Completed for Crate id: None"
    assert value(spark, text.arrival_text(F.col("s")), s="raw/a.csv") == (
        "New file 'raw/a.csv' uploaded to S3"
    )


@pytest.mark.parametrize("body, label", [
    ('{"crate_id": "1", "customer_id": "C", "customer_name": "N", "city": "X"}',
     '{"crate_id":"1","customer_id":"C","customer_name":"N"}'),
    ('{"crate_id": "1"}', '{"crate_id":"1","customer_id":null,"customer_name":null}'),
])
def test_label_payload_has_nulls_for_absent_fields(spark, body, label):
    assert value(spark, payload.label_json(F.col("b")), b=body) == label


def test_json_with_a_number_is_read_as_text(spark):
    assert value(spark, payload.record_of(F.col("b"))["crate_id"], b='{"crate_id": 123456}') == (
        "123456"
    )
