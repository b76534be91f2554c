"""What is moved and written for a row, which sets what larger tables cost."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cratelake.plans import fixtures, queries
from cratelake.sources import messages
from cratelake.streaming import dedup


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _messages(spark, n):
    return spark.range(n).select(
        F.col("id").cast("string").alias("message_id"), F.timestamp_seconds("id").alias("sent_ts"),
        F.col("id").alias("seq"), F.lit('{"crate_id": "1"}').alias("body"),
    )


def test_customers_are_not_collected_and_texts_are_made_after_the_join(spark, sf):
    plan = _plan(fixtures.crates(spark, sf))
    assert plan.count("BroadcastExchange") == 2  # nation and region
    assert "Depot Road" not in plan[plan.index("SortMergeJoin"):]


def test_queue_files_are_compressed_and_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(messages._FILES, "maxRecordsPerFile", 40)
    sent = _messages(spark, 100).coalesce(1)
    messages.send_messages(sent, str(tmp_path / "q"))
    found = [x.name for x in (tmp_path / "q").glob("part-*")]
    assert len(found) == 3 and all(x.endswith(".json.gz") for x in found)
    assert messages.read_messages(spark, str(tmp_path / "q")).exceptAll(sent).isEmpty()


def test_bodies_do_not_take_part_in_the_join_of_the_view(spark, sf):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(queries.inprogress_view(spark, sf))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "from_json" in plan[plan.index("SortMergeJoin"):]  # below the join, so before its shuffle


def test_messages_sent_apart_share_no_file(spark, tmp_path):
    path, sent = str(tmp_path / "q"), _messages(spark, 100)
    messages.send_messages(sent.withColumn("old", F.col("seq") < 30), path, apart="old")
    back = messages.read_messages(spark, path)
    assert back.columns == sent.columns and back.count() == 100 and back.exceptAll(sent).isEmpty()
    kinds = back.groupBy(F.col("_metadata.file_path")).agg(F.count_distinct(F.col("seq") < 30).alias("n"))
    assert {r["n"] for r in kinds.collect()} == {1}


@pytest.mark.parametrize("lateness", [None, dt.timedelta(hours=1)])
def test_contents_of_a_stream_share_calls_and_states(spark, tmp_path, monkeypatch, lateness):
    """3,000 contents in three slots, some again after the interval, in two micro-batches."""
    monkeypatch.setattr(dedup, "SLOTS", 3)
    n, turn = F.col("id") % 3000, F.floor(F.col("id") / 3000)
    rows = spark.range(6000).select(n.cast("string").alias("k"), F.timestamp_seconds(1_700_000_000 + n % 2 * turn * 600).alias("t"), "id")
    for i in range(2):
        rows.where(turn == i).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    kept = dedup.deduplicate_stream(stream, dt.timedelta(minutes=5), key="k", ts="t", tie="id", lateness=lateness)
    query = kept.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "c")
    ).trigger(availableNow=True).start()
    query.awaitTermination()
    got = {r["id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {*range(3000)} | {x for x in range(3000, 6000) if x % 2}
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) <= 3
