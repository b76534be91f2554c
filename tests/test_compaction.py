"""A gold table that many micro-batches fed, rewritten a date at a time while it is read."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cratelake.model import CRATE_SCHEMA
from cratelake.sources import compaction, gold


@pytest.fixture
def table(spark, crate, tmp_path):
    """A function that adds micro-batches; each row's id tells its day and micro-batch."""
    name, path = f"gold_{tmp_path.name.replace('-', '_')}", str(tmp_path / "gold")
    gold.create_table(spark, name, path, batched=True)

    def feed(*numbers, days=(1, 2)):
        for n in numbers:
            rows = [crate(crate_id=f"{d}-{n}", creation_date=f"2024-01-0{d}") for d in days]
            df = spark.createDataFrame(rows, CRATE_SCHEMA).withColumn("creation_date", F.col("creation_date").cast("date"))
            gold.write_batch(df, path, n, name)

    return name, path, feed


def ids(df):
    return sorted(r["crate_id"] for r in df.collect())


def expected(*numbers, days=(1, 2)):
    return sorted(f"{d}-{n}" for n in numbers for d in days)


def test_fifty_micro_batches_leave_a_bounded_number_of_files(spark, table):
    name, path, feed = table
    for n in range(0, 50, 10):
        feed(*range(n, n + 10))
        assert compaction.compact(spark, name, path) == ["2024-01-01", "2024-01-02"]
        assert ids(spark.table(name)) == expected(*range(n + 10))
        assert all(len(x) == 1 for x in compaction.registered(spark, name).values())
        assert len(spark.table(name).where("creation_date = DATE'2024-01-01'").inputFiles()) == 1
    assert compaction.compact(spark, name, path) == []
    # The folder holds the newest rewriting of each date and nothing that it replaced.
    on_disk = spark.read.option("recursiveFileLookup", "true").schema(gold.GOLD_SCHEMA).parquet(f"{path}/_compacted")
    assert on_disk.count() == 100
    assert not [x for d in (1, 2) for x in gold.folders(spark, f"{path}/creation_date=2024-01-0{d}/batch=*")]


def test_a_reader_planned_before_keeps_its_rows(spark, table):
    name, path, feed = table
    feed(*range(4))
    planned = spark.table(name).select("crate_id")
    planned._jdf.queryExecution().executedPlan()
    compaction.compact(spark, name, path, most=2)
    assert ids(planned) == expected(*range(4))
    assert ids(compaction.read_table(spark, name)) == ids(spark.table(name)) == expected(*range(4))


def test_a_run_stopped_between_its_two_commands(spark, table, monkeypatch):
    name, path, feed = table
    feed(*range(4))
    with monkeypatch.context() as m:
        m.setattr(compaction, "drop_replaced", lambda *a: None)
        compaction.compact(spark, name, path, most=2)
    assert spark.table(name).count() == 16  # both forms are registered
    assert ids(compaction.read_table(spark, name)) == expected(*range(4))
    feed(4, days=(2,))
    assert ids(compaction.read_table(spark, name)) == sorted(expected(*range(4)) + ["2-4"])
    assert compaction.compact(spark, name, path, most=2) == []
    assert ids(spark.table(name)) == sorted(expected(*range(4)) + ["2-4"])


def test_a_run_stopped_before_it_registered(spark, table, monkeypatch):
    name, path, feed = table
    feed(*range(4))
    with monkeypatch.context() as m:
        m.setattr(compaction, "_spec", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            compaction.compact(spark, name, path, most=2)
    assert ids(spark.table(name)) == expected(*range(4))
    compaction.compact(spark, name, path, most=2)
    assert ids(spark.table(name)) == expected(*range(4))


def test_a_repair_does_not_bring_replaced_rows_back(spark, table):
    name, path, feed = table
    feed(*range(4))
    compaction.compact(spark, name, path, most=2)
    compaction.repair(spark, name)
    assert ids(spark.table(name)) == expected(*range(4))


def test_a_micro_batch_that_may_run_again_is_left_alone(spark, table):
    name, path, feed = table
    feed(*range(5))
    compaction.compact(spark, name, path, most=2, committed=3)
    assert sorted(compaction.registered(spark, name)["2024-01-01"]) == [-4, 4]
    feed(4)  # it does run again
    feed(5, days=(1,))
    assert ids(spark.table(name)) == sorted(expected(*range(5)) + ["1-5"])


def test_only_dates_with_many_partitions_are_rewritten(spark, table):
    name, path, feed = table
    feed(0, 1, 2)
    feed(3, days=(1,))
    assert compaction.compact(spark, name, path, most=3) == ["2024-01-01"]
    assert len(compaction.registered(spark, name)["2024-01-02"]) == 3
    assert ids(spark.table(name)) == sorted(expected(0, 1, 2) + ["1-3"])


def test_runs_through_the_same_micro_batch_keep_apart(spark, table):
    name, path, feed = table
    feed(0, 1, 2, 3, days=(1,))
    feed(0, 1, 3)
    assert compaction.compact(spark, name, path, most=3) == ["2024-01-01"]
    assert compaction.compact(spark, name, path, most=2) == ["2024-01-02"]
    assert compaction.compact(spark, name, path, most=2) == []
    assert ids(spark.table(name)) == sorted(expected(0, 1, 2, 3, days=(1,)) + expected(0, 1, 3, days=(2,)))


def test_null_fields_and_dates_pass_through(spark, table, crate):
    name, path, feed = table
    rows = [crate(crate_id="x", city=None, creation_date=d) for d in ("2024-01-01", None)]
    df = spark.createDataFrame(rows, CRATE_SCHEMA).withColumn("creation_date", F.col("creation_date").cast("date"))
    for n in range(3):
        gold.write_batch(df, path, n, name)
    compaction.compact(spark, name, path, most=2)
    assert [(r["city"], r["creation_date"]) for r in spark.table(name).collect()] == [(None, dt.date(2024, 1, 1))] * 3
    assert gold.undated(spark, path).count() == 3
