"""Routed files leave the raw folder, whatever a run was stopped by; ingested ones stop waiting."""

import pytest
from pyspark.sql import functions as F

from cratelake.model import CRATE_SCHEMA, LANDED_SCHEMA
from cratelake.plans.pipeline import CrateLake
from cratelake.sources import csvfiles, files
from cratelake.streaming import flows
from cratelake.streaming.intake import Intake, file_of, read_taken


@pytest.fixture
def zones(tmp_path):
    return {x: str(tmp_path / x) for x in ("raw", "silver", "check", "done")}


def land(spark, crate, zones, *ids, batch):
    rows = spark.createDataFrame([crate(crate_id=i) for i in ids], CRATE_SCHEMA)
    csvfiles.write_raw(rows.coalesce(1), f"{zones['raw']}/batch={batch}", mode="overwrite")


def route(spark, zones):
    flows.route_files(spark, zones["raw"], zones["silver"], zones["check"], archive=zones["done"])


def csvs(path):
    return sorted(p.name for p in path.rglob("*.csv"))


def ids_in(spark, path, schema):
    return sorted(r["crate_id"] for r in csvfiles.read_crate_csv(spark, path, schema).collect())


def test_raw_is_empty_after_each_route(spark, crate, zones, tmp_path):
    files.ensure_folder(spark, zones["raw"])
    route(spark, zones)  # nothing there yet
    for batch, ids in enumerate((("a", "b c"), ("d",), ())):
        land(spark, crate, zones, *ids, batch=batch)
        route(spark, zones)
        assert csvs(tmp_path / "raw") == []
    assert ids_in(spark, zones["silver"], LANDED_SCHEMA) == ["a", "b c", "d"]
    assert ids_in(spark, zones["done"], CRATE_SCHEMA) == ["a", "b c", "d"]
    # Only the newest landing keeps its folder, whose mark tells the scan that it is complete.
    assert [p.name for p in (tmp_path / "raw").glob("batch=*")] == ["batch=2"]
    assert not list((tmp_path / "done/_taken").glob("batch=*"))


def test_a_run_stopped_between_write_and_move_loses_and_doubles_nothing(spark, crate, zones, tmp_path, monkeypatch):
    land(spark, crate, zones, "a", "b", batch=0)
    with monkeypatch.context() as m:
        m.setattr(Intake, "sweep", lambda self: 0)
        route(spark, zones)
    assert len(csvs(tmp_path / "raw")) and ids_in(spark, zones["silver"], LANDED_SCHEMA) == ["a", "b"]
    land(spark, crate, zones, "c", batch=1)
    route(spark, zones)
    assert csvs(tmp_path / "raw") == []
    assert ids_in(spark, zones["silver"], LANDED_SCHEMA) == ["a", "b", "c"]
    assert ids_in(spark, zones["done"], CRATE_SCHEMA) == ["a", "b", "c"]


def test_a_run_stopped_halfway_through_the_moves_goes_on(spark, crate, zones, tmp_path, monkeypatch):
    for batch, name in enumerate("abc"):
        land(spark, crate, zones, name, batch=batch)
    moved = []

    def fails_second(spark, path, target, old=files.move):
        if moved:
            raise OSError("stopped")
        moved.append(path)
        return old(spark, path, target)

    with monkeypatch.context() as m:
        m.setattr(files, "MOVERS", 1)
        m.setattr(files, "move", fails_second)
        with pytest.raises(OSError):
            route(spark, zones)
    assert len(csvs(tmp_path / "raw")) == 2
    route(spark, zones)
    assert csvs(tmp_path / "raw") == [] and len(csvs(tmp_path / "done")) == 3
    assert ids_in(spark, zones["silver"], LANDED_SCHEMA) == ["a", "b", "c"]


def test_a_micro_batch_that_was_not_committed_keeps_its_files(spark, crate, zones, tmp_path):
    land(spark, crate, zones, "a", batch=0)
    route(spark, zones)
    land(spark, crate, zones, "b", batch=1)
    # The second micro-batch noted and wrote, then stopped: its commit is missing.
    route_without_sweep = Intake(spark, zones["raw"], f"{zones['done']}/_taken", zones["check"], zones["done"])
    source = spark.read.schema(CRATE_SCHEMA).options(**csvfiles.READ_OPTIONS).csv(zones["raw"])
    route_without_sweep.note(source.select("*", file_of()), 1)
    assert route_without_sweep.sweep() == 0 and len(csvs(tmp_path / "raw")) == 1
    route(spark, zones)
    assert csvs(tmp_path / "raw") == []
    assert ids_in(spark, zones["silver"], LANDED_SCHEMA) == ["a", "b"]


def test_files_outside_the_source_are_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        files.below(spark, str(tmp_path / "rawer/x.csv"), str(tmp_path / "raw"))


def test_what_an_ingest_took_no_longer_waits(spark, crate, tmp_path):
    """Files routed after the gate was read, but before the ingest, are ingested and do not wait."""
    lake = CrateLake(spark, str(tmp_path / "lake"), threshold=2, name="stock_taken")

    def arrive(*days):
        rows = spark.createDataFrame([crate(crate_id=str(d), creation_date=f"2023-12-{d:02}") for d in days], CRATE_SCHEMA)
        csvfiles.write_raw(rows, f"{tmp_path}/lake/raw/batch={days[0]}")
        lake.route(F.col("creation_date").cast("date"))

    arrive(1, 2, 3)
    assert lake.waiting_files().count() == 3
    gate = lake.ingest
    lake.ingest = lambda: (arrive(4, 5), gate())
    assert lake.ingest_if_due()
    assert lake.waiting_files().count() == 0
    assert lake.table().count() == 5
    assert not csvs(tmp_path / "lake/raw") and len(csvs(tmp_path / "lake/routed")) >= 2
    assert read_taken(spark, f"{tmp_path}/lake/taken").count() == 5


def test_the_gate_counts_as_files_come(spark, crate, tmp_path):
    lake = CrateLake(spark, str(tmp_path / "lake"), threshold=3, name="stock_gate")
    seen = []
    for days in ((1, 2), (3,), (4, 5), (6,), (7, 8, 9, 10, 11)):
        rows = spark.createDataFrame([crate(crate_id=str(d), creation_date=f"2023-12-{d:02}") for d in days], CRATE_SCHEMA)
        csvfiles.write_raw(rows, f"{tmp_path}/lake/raw/batch={days[0]}")
        lake.route(F.col("creation_date").cast("date"))
        lake.ingest_as_they_come().awaitTermination()
        seen.append(lake.table().count())
    # Five files wait after the third time, six after the last.
    assert seen == [0, 0, 5, 5, 11]
    gate = flows.gate_state(spark, f"{tmp_path}/lake/gate").orderBy("batch").collect()
    assert [(r["came"], r["waiting"], r["fired"]) for r in gate] == [
        (2, 2, False), (1, 3, False), (2, 0, True), (1, 1, False), (5, 0, True)]
    assert lake.waiting_files().count() == 0
    lake.ingest_as_they_come().awaitTermination()
    assert lake.table().count() == 11


def test_a_gate_that_stopped_in_its_job_counts_again(spark, tmp_path):
    (tmp_path / "in").mkdir()
    spark.range(4).write.mode("append").parquet(str(tmp_path / "in"))
    calls = []

    def job():
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("stopped")

    def gate():
        stream = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
        flows.fire_when_full(stream, job, str(tmp_path / "g"), str(tmp_path / "c"), threshold=3).awaitTermination()

    with pytest.raises(Exception, match="stopped"):
        gate()
    gate()
    gate()
    assert len(calls) == 2
    assert [tuple(r) for r in flows.gate_state(spark, str(tmp_path / "g")).select("came", "waiting", "fired").collect()] == [(4, 0, True)]


def test_a_compacted_lake_reads_the_same(spark, crate, tmp_path):
    lake = CrateLake(spark, str(tmp_path / "lake"), name="stock_compact")
    for n in range(4):
        rows = spark.createDataFrame([crate(crate_id=str(n))], CRATE_SCHEMA)
        csvfiles.write_raw(rows, f"{tmp_path}/lake/raw/batch={n}")
        lake.route(F.col("creation_date").cast("date"))
        lake.ingest()
    assert lake.compact(most=2) == ["2023-12-01"]
    assert sorted(r["crate_id"] for r in lake.table().collect()) == ["0", "1", "2", "3"]
    again = CrateLake(spark, str(tmp_path / "lake"), name="stock_compact")
    assert again.delivered().count() == 4
