"""Rollups that go with the ingest, stored orders, and tables that meet without a shuffle."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cratelake.model import CRATE_SCHEMA
from cratelake.operators import browse, dashboard, ordered, queue
from cratelake.plans.pipeline import CrateLake
from cratelake.sources import csvfiles, messages, rollups

BY = "day date, kind string"
IDS = [None, "", "7", "007", "32768", "32769", "0", "-3", "x", "9223372036854775807", "99999999999999999999", " 7", "1.0"]


@pytest.fixture
def rollup(spark, tmp_path):
    return rollups.Rollup(spark, str(tmp_path / "rollup"), spark.createDataFrame([], BY).schema)


def rows(spark, n, seed):
    rng = random.Random(seed)
    days = [None, dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    listed = [(rng.choice(IDS + [str(rng.randrange(200_000)) for _ in range(9)]), rng.choice(days), rng.choice(["a", "b", None])) for _ in range(n)]
    return spark.createDataFrame(listed, "crate_id string, day date, kind string")


def same(rollup, whole):
    want = {(r["day"], r["kind"]): r["n"] for r in whole.groupBy("day", "kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert {(r["day"], r["kind"]): r["n"] for r in rollup.counts().collect()} == want
    assert rollup.crates().first()[0] == whole.agg(F.count_distinct("crate_id")).first()[0]


def test_a_rollup_equals_the_scan(spark, rollup, tmp_path, monkeypatch):
    monkeypatch.setattr(rollups, "FOLD_EVERY", 3)
    whole = rows(spark, 0, 0)
    assert rollup.crates().first()[0] == 0 and rollup.counts().count() == 0 and not rollup.started()
    for n in range(9):
        part = rows(spark, 40, n)
        whole = whole.union(part)
        rollup.add(part, n)
        rollup.add(part, n)  # a micro-batch that runs again
        if n in (0, 4, 8):
            same(rollup, whole)
    assert rollup.started()
    # Folded folders replace those of micro-batches, which the fold after next removes.
    assert len(list((tmp_path / "rollup/counts").glob("through=*"))) <= 2
    assert len(list((tmp_path / "rollup/ids").glob("batch=*"))) <= 7


def test_a_rollup_of_a_table_that_had_none(spark, rollup):
    before, after = rows(spark, 60, 1), rows(spark, 30, 2)
    rollup.rebuild(before, 4)
    same(rollup, before)
    rollup.add(after, 5)
    same(rollup, before.union(after))


def test_cards_and_series_from_counted_rows(spark, rollup):
    part = rows(spark, 200, 5)
    rollup.add(part, 0)
    flag, day, end = F.col("kind") == "a", F.col("day"), dt.date(2024, 1, 3)
    assert dashboard.kpi_cards_of(rollup.counts(), rollup.crates(), flag).collect() == dashboard.kpi_cards(part, flag).collect()
    one = dashboard.requested_vs_flagged(rollup.counts(), day, end, flag, 4, "n").orderBy("day").collect()
    assert one == dashboard.requested_vs_flagged(part, day, end, flag, 4).orderBy("day").collect()
    assert sorted(dashboard.category_share(rollup.counts(), "kind", "n").collect(), key=str) == sorted(
        dashboard.category_share(part, "kind").collect(), key=str)
    empty = dashboard.kpi_cards_of(rollup.counts().limit(0), rollup.crates(), flag).first()
    assert (empty["total_requests"], empty["total_flagged"]) == (0, 0)


def test_a_lake_keeps_its_rollup(spark, crate, tmp_path):
    lake = CrateLake(spark, str(tmp_path / "lake"), name="stock_rollup")
    for n in range(3):
        listed = [crate(crate_id=str(i), return_status="Returned" if i % 2 else "Lost", creation_date=f"2023-12-0{n + 1}") for i in range(n + 2)]
        csvfiles.write_raw(spark.createDataFrame(listed, CRATE_SCHEMA), f"{tmp_path}/lake/raw/batch={n}")
        lake.route(F.col("creation_date").cast("date"))
        lake.ingest()
    flag = F.col("return_status") == "Returned"
    assert lake.kpi_cards(flag).collect() == dashboard.kpi_cards(lake.table(), flag).collect()
    assert [r["n"] for r in lake.requests_per_day(dt.date(2023, 12, 3), 4).orderBy("day").collect()] == [0, 2, 3, 4]


def test_a_second_far_page_sorts_nothing(spark, tmp_path):
    cells = spark.range(20_000).select(F.col("id"), F.when(F.col("id") % 3 > 0, (F.col("id") * 7919 % 5_000).cast("string")).alias("cell"))
    path = str(tmp_path / "order")
    ordered.store_order(cells, path, "cell", row_key="id", ascending=False)
    for page in (1, 40, 399, 800, 801):
        want = browse.table_page(cells, "cell", row_key="id", ascending=False, page=page, size=25).collect()
        assert ordered.stored_page(spark, path, page, 25).collect() == want
    plan = ordered.stored_page(spark, path, 700, 25)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(_position" in plan
    assert ordered.stored_rows(spark, path) == 20_000
    with pytest.raises(ValueError):
        ordered.stored_page(spark, path, 0)


def test_bucketed_tables_meet_without_a_shuffle(spark):
    sent = spark.range(1_000).select(F.col("id").cast("string").alias("message_id"), F.col("id").alias("seq"))
    acked = spark.range(0, 900, 2).select(F.col("id").cast("string").alias("message_id")).union(
        spark.range(50).select(F.lit("8").alias("message_id")))
    messages.save_bucketed(sent, "bucketed_sent", 4)
    messages.save_bucketed(acked, "bucketed_acked", 4)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = queue.pending(spark.table("bucketed_sent"), spark.table("bucketed_acked"))
        assert sorted(r["seq"] for r in left.collect()) == [i for i in range(1_000) if i % 2 or i >= 900]
        assert "Exchange" not in left._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
