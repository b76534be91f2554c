import datetime as dt

from pyspark.sql import functions as F

from cratelake.model import CRATE_SCHEMA
from cratelake.plans.pipeline import CrateLake


def test_files_wait_until_there_are_enough(spark, crate, tmp_path):
    lake = CrateLake(spark, str(tmp_path / "lake"), name="stock")
    assert lake.pending().count() == 0
    assert not lake.ingest_if_due()
    for start, days in ((0, 10), (10, 1), (11, 3)):
        records = spark.createDataFrame(
            [crate(crate_id=f"{i:03}", creation_date=f"2023-12-{i + 1:02}")
             for i in range(start, start + days)], CRATE_SCHEMA,
        ).withColumns({"at": F.current_timestamp(), "seq": F.col("crate_id").cast("long")})
        lake.send(records, "crate_id", "at", "seq")
        assert lake.pending().count() == days
        lake.scan()
        assert lake.pending().count() == 0
        # One file per day: every record arrives on the day it states.
        lake.route(F.col("creation_date").cast("date"))
        due = lake.waiting_files().count() > 10
        assert due == (start == 10)
        assert lake.ingest_if_due() == due
    # The first eleven were taken as one batch, the last three wait.
    assert lake.delivered().count() == 11
    assert lake.waiting_files().count() == 3
    assert lake.landed().count() == 14
    lake.ingest()
    assert lake.table().count() == 14
    assert lake.delivered(limit=5).count() == 5
    # Each scanned crate and each routed file was announced once.
    assert lake.notices().count() == 14
    assert spark.sql("SELECT count(DISTINCT crate_id) FROM stock").first()[0] == 14
    lake.ingest()  # the archive is one run behind
    assert lake.table().count() == 14
    assert list((tmp_path / "lake").glob("archive/**/*.csv"))


def test_a_record_sent_again_within_five_minutes_is_dropped(spark, crate, tmp_path):
    lake = CrateLake(spark, str(tmp_path / "lake"), name="stock_again")
    at = dt.datetime(2024, 1, 1)

    def send(*minutes):
        rows = [crate(crate_id="a") + (at + dt.timedelta(minutes=m), m, f"m{m}") for m in minutes]
        fields = ", ".join(f"{n} string" for n in CRATE_SCHEMA.names)
        lake.send(spark.createDataFrame(rows, f"{fields}, at timestamp, seq long, id string"), "id", "at", "seq")

    send()
    send(0, 1, 4)
    send(3, 5, 9)
    send(14, 10)
    assert {r["message_id"] for r in lake.pending().collect()} == {"m0", "m5", "m10"}
    assert [r["crate_id"] for r in lake.in_progress(2).collect()] == ["a", "a"]
