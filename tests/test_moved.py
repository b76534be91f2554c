"""What a query shuffles grows as its tables do, also where they pass the size that Spark broadcasts; what it collects does not."""

import pytest
from pyspark.sql.readwriter import DataFrameWriter

from cratelake.plans import lakes, queries

SIZES = "/root/testdata/sf0.01", "/root/testdata/sf0.1"
# Between the sizes of the two tables of customers, as 10 MB lies between those of larger tables.
THRESHOLD = "150000"


def _nodes(plan):
    """The nodes of a plan that has run, those of its stages in place of the stages."""
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan":
        yield from _nodes(plan.executedPlan())
    elif name.endswith("QueryStage"):
        yield from _nodes(plan.plan())
    else:
        yield plan
        for i in range(plan.children().size()):
            yield from _nodes(plan.children().apply(i))


def _run(df):
    """Bytes shuffled and bytes collected for a broadcast when ``df`` is made."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    shuffled = collected = 0
    for node in _nodes(execution.executedPlan()):
        if node.nodeName() == "Exchange":
            shuffled += node.metrics().apply("shuffleBytesWritten").value()
        if node.nodeName() == "BroadcastExchange":
            collected += node.metrics().apply("dataSize").value()
    return shuffled, collected


@pytest.fixture
def moved(spark, monkeypatch):
    """Runs a query with zones of its own; gives the bytes that the crates it writes have shuffled and collected."""
    crates = []

    def recording(write):
        def record(self, *args, **kwargs):
            if "c_custkey" in self._df._jdf.queryExecution().executedPlan().toString():
                crates.append(self._df)
            return write(self, *args, **kwargs)

        return record

    def run(name, sf_dir):
        monkeypatch.setattr(lakes, "_written", {})
        crates.clear()
        queries.QUERIES[name](spark, sf_dir).collect()
        assert crates
        return [sum(x) for x in zip(*map(_run, crates))]

    for kind in ("csv", "json", "parquet"):
        monkeypatch.setattr(DataFrameWriter, kind, recording(getattr(DataFrameWriter, kind)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", THRESHOLD)
    yield run
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _in_proportion(moved, name):
    small, large = (moved(name, sf_dir) for sf_dir in SIZES)
    assert large[0] <= 12 * small[0]  # ten times the rows
    assert large[1] == small[1]  # nation and region


def test_routed_files_that_are_listed(moved):
    _in_proportion(moved, "list_files")


def test_routed_files_that_are_ingested(moved):
    _in_proportion(moved, "track_delivered")


def test_landed_files(moved):
    _in_proportion(moved, "sink_bronze_csv")


def test_rollup_collects_no_customers(spark, moved):
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")  # customers of either size lie below Spark's own
    (_, small), (_, large) = (moved("fulfilled_by_month_rollup", sf_dir) for sf_dir in SIZES)
    assert large == small


def test_queue_that_is_scanned(moved):
    _in_proportion(moved, "pending_after_scan")


def test_gold(moved):
    _in_proportion(moved, "gold_write")
