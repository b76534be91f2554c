"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the cores. Each query runs once to warm up
and then BENCH_RUNS times; the median counts. Results go to Spark's no-op sink, so that every
row and column is computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from cratelake import build_session
from cratelake.plans import lakes
from cratelake.plans.queries import QUERIES

HEADLINE = [
    "track_delivered", "track_delivered_gold", "src_messages", "scan_silver_csv",
    "gold_incremental", "silver_route", "silver_route_stream", "inprogress_view",
    "validate_reject", "pending", "queue_peek10", "pending_after_scan", "dedup_fifo",
    "dedup_fifo_stream", "dedup_fifo_batches", "count_batches", "count_batches_stream", "table_search",
    "table_sort_asc", "table_page", "table_page_far", "kpi_cards", "requests_7d",
    "fulfilled_by_month", "category_share", "key_scalars", "json_scalars", "kpi_cards_rollup", "table_page_stored",
]
# Tables whose rows a query takes in, for a rate next to the time.
RATES = {"gold_incremental": "orders", "dedup_fifo": "events", "dedup_fifo_stream": "events",
         "dedup_fifo_batches": "events",
         "count_batches": "events"}


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench", f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    for prepare in (lakes.queue, lakes.ragged_queue, lakes.forms, lakes.raw, lakes.silver, lakes.gold, lakes.inventory):
        prepare(spark, sf_dir)
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        run(spark, name, sf_dir)
        times = [run(spark, name, sf_dir) for _ in range(runs)]
        seconds[name] = round(statistics.median(times), 3)
    rates = {
        name: round(spark.read.parquet(f"{sf_dir}/{table}.parquet").count() / seconds[name])
        for name, table in RATES.items() if name in seconds
    }
    print(json.dumps({
        "metric": "sum of query medians, warm",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "rows_per_sec": rates,
        "sf": Path(sf_dir).name,
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
