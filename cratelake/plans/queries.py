"""One query per operator over the benchmark tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cratelake.functions import dates, keys, payload, text
from cratelake.model import CRATE_FIELDS, CRATE_SCHEMA, DECLARED_DATE, LANDED_SCHEMA, TRACKING_FIELDS
from cratelake.operators import (
    batches, browse, dashboard, dedup, ordered, queue, records, tracking,
)
from cratelake.plans import fixtures, lakes
from cratelake.session import shared_path
from cratelake.sources import compaction, csvfiles, events, files, gold, messages, rollups
from cratelake.streaming import flows
from cratelake.streaming.dedup import (
    deduplicate_batches, deduplicate_stream, read_accepted, start_batches, stream_accepted,
)

Query = Callable[[SparkSession, str], DataFrame]

INTERVAL = dt.timedelta(days=2)
WEEK_END = dt.date(1998, 10, 7)
YEAR = 1998


def _plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the tables have them."""
    return df.withColumns({
        name: F.col(name).cast("timestamp_ntz")
        for name, kind in df.dtypes if kind == "timestamp"
    })


# --- sources and sinks


def src_messages(spark, sf_dir):
    return _plain_times(messages.parsed(messages.read_messages(spark, lakes.queue(spark, sf_dir))))


def sink_messages(spark, sf_dir):
    return _plain_times(messages.read_messages(spark, lakes.queue(spark, sf_dir)))


def sink_bronze_csv(spark, sf_dir):
    return csvfiles.read_crate_csv(spark, lakes.raw(spark, sf_dir))


def bronze_key(spark, sf_dir):
    return fixtures.objects(spark, sf_dir).select("event_id", "object_key")


def _object_events(spark, sf_dir):
    """An event per object, with a second record for a copy that arrives a day later."""
    at = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"

    def record(ts, key):
        return F.struct(
            F.date_format(ts, at).alias("eventTime"),
            F.struct(F.struct(key.alias("key")).alias("object")).alias("s3"),
        )

    copy = F.concat(F.lit("raw/copies/"), F.col("event_id").cast("string"), F.lit(".csv"))
    return fixtures.objects(spark, sf_dir).select(F.to_json(F.struct(F.array(
        record(F.col("ts"), F.col("object_key")),
        record(F.col("ts") + F.expr("interval 1 day"), copy),
    ).alias("Records"))).alias("event"))


def silver_route(spark, sf_dir):
    return events.route_objects(_object_events(spark, sf_dir))


def _odd_events(spark, sf_dir):
    """Object events as they come, some of them broken in a way of their own."""
    n, event = F.col("event_id") % 5, F.col("event")
    return fixtures.table(spark, sf_dir, "events").select(
        "event_id",
        F.to_json(F.struct(F.array(F.struct(
            F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.when(F.col("event_id") % 5 == 1, "Z").otherwise(".000000Z")).alias("eventTime"),
            F.struct(F.struct(F.concat(F.lit("raw/"), F.col("event_id").cast("string"), F.lit(".csv")).alias("key")).alias("object")).alias("s3"),
        )).alias("Records"))).alias("event"),
    ).select(
        "event_id", F.when(n == 2, F.lit('{"Records": []}')).when(n == 3, F.lit("{broken")).otherwise(event).alias("event")
    )


def route_rejects(spark, sf_dir):
    return events.route_rejects(_odd_events(spark, sf_dir)).groupBy("object_key", "reason").count().withColumnRenamed(
        "count", "n"
    )


def scan_rejects(spark, sf_dir):
    """Scans a queue of which every seventh body is cut short and every eleventh null."""
    queue_path = shared_path(spark, "odd-queue")
    seq, body = F.col("seq"), F.col("body")
    odd = F.when(seq % 11 == 0, F.lit(None)).when(seq % 7 == 0, F.substring(body, 1, 20)).otherwise(body)
    messages.send_messages(fixtures.messages(spark, sf_dir).withColumn("body", odd), queue_path)
    raw, acked, refused = (shared_path(spark, x) for x in ("odd-raw", "odd-acks", "odd-rejects"))
    flows.scan_messages(
        messages.stream_messages(spark, queue_path), raw, acked, shared_path(spark, "odd-checkpoint"), refused
    )
    state = lambda df, name: df.select("message_id", F.lit(name).alias("state"))
    return state(flows.read_rejects(spark, refused), "rejected").unionByName(
        state(flows.read_acks(spark, acked), "acknowledged")
    ).unionByName(state(csvfiles.read_crate_csv(spark, raw).withColumnRenamed("crate_id", "message_id"), "landed"))


def silver_route_stream(spark, sf_dir):
    silver = shared_path(spark, "routed")
    flows.route_files(
        spark, lakes.raw(spark, sf_dir), silver, shared_path(spark, "route-checkpoint"),
        arrival=F.add_months(F.trunc(F.col("creation_date").cast("date"), "month"), 1),
    )
    landed = csvfiles.read_crate_csv(spark, silver, LANDED_SCHEMA)
    return csvfiles.with_arrival(landed, keep_declared=True)


def raw_moved(spark, sf_dir):
    """Lands and routes twice; the routed files leave the raw folder."""
    raw, silver, done, checkpoint = (shared_path(spark, x) for x in ("raw", "routed", "raw-done", "route-checkpoint"))
    for turn in range(2):
        part = fixtures.crates(spark, sf_dir).where(F.col("seq") % 2 == turn)
        csvfiles.write_raw(part, f"{raw}/batch={turn}")
        flows.route_files(
            spark, raw, silver, checkpoint, archive=done,
            arrival=F.add_months(F.trunc(F.col("creation_date").cast("date"), "month"), 1),
        )
    landed = csvfiles.with_arrival(csvfiles.read_crate_csv(spark, silver, LANDED_SCHEMA))
    return landed.groupBy("creation_date").agg(F.count(F.lit(1)).alias("n_routed")).withColumn(
        "left_in_raw", F.lit(files.list_files(spark, raw).count())
    )


def list_files(spark, sf_dir):
    uri = F.col("uri")
    directory = F.element_at(F.split(uri, "/"), -2)
    header = len(",".join(CRATE_FIELDS[:-1] + [DECLARED_DATE])) + 1
    # What a folder's files hold besides their headers does not depend on how many there are.
    return files.list_files(spark, lakes.silver(spark, sf_dir)).groupBy(directory.alias("directory")).agg(
        F.bool_and(keys.is_csv(uri)).alias("is_csv"), F.sum(F.col("length") - header).alias("row_bytes")
    )


def scan_silver_csv(spark, sf_dir):
    landed = csvfiles.read_crate_csv(spark, lakes.silver(spark, sf_dir), LANDED_SCHEMA)
    return csvfiles.with_arrival(landed, keep_declared=True)


def gold_write(spark, sf_dir):
    return gold.read_gold(spark, lakes.gold(spark, sf_dir))


def gold_partitions(spark, sf_dir):
    name = f"crate_inventory_{uuid.uuid4().hex}"
    gold.create_table(spark, name, lakes.gold(spark, sf_dir))
    gold.repair_table(spark, name)
    found = gold.partitions(spark, name)  # the command runs at once
    spark.sql(f"DROP TABLE {name}")
    return found


def gold_incremental(spark, sf_dir):
    """Ingests twice; the second run finds nothing new."""
    target, checkpoint = shared_path(spark, "ingested"), shared_path(spark, "ingest-checkpoint")
    for _ in range(2):
        flows.ingest_files(spark, lakes.silver(spark, sf_dir), target, checkpoint)
    return gold.read_gold(spark, target)


def gold_compacted(spark, sf_dir):
    """Four micro-batches touch every date; each date is then rewritten as one folder."""
    name, path = f"crate_compacted_{uuid.uuid4().hex}", shared_path(spark, "compacted")
    gold.create_table(spark, name, path, batched=True)
    rows = fixtures.gold_crates(spark, sf_dir)
    for turn in range(4):
        part = rows.where(F.pmod(F.xxhash64("crate_id"), F.lit(4)) == turn)
        gold.write_batch(part, path, turn, name)
    compaction.compact(spark, name, path, most=2)
    return compaction.read_table(spark, name)


def schema_report(spark, sf_dir):
    """The schema that the gold files themselves state."""
    return gold.schema_report(spark.read.parquet(lakes.gold(spark, sf_dir)))


def notify_scanned(spark, sf_dir):
    crates = fixtures.order_crates(spark, sf_dir).withColumn("message_id", F.col("crate_id"))
    return queue.scan_notifications(queue.scanned(crates, fixtures.acks(spark, sf_dir)))


def notify_arrival(spark, sf_dir):
    return queue.arrival_notifications(fixtures.objects(spark, sf_dir))


# --- projections and filters


def canonical_record(spark, sf_dir):
    return records.canonical_record(fixtures.form(spark, sf_dir))


def label_payload_full(spark, sf_dir):
    return fixtures.crates(spark, sf_dir).select("crate_id", payload.record_json().alias("payload"))


def _ragged(spark, sf_dir):
    return messages.read_messages(spark, lakes.ragged_queue(spark, sf_dir))


def label_payload_scan(spark, sf_dir):
    return _ragged(spark, sf_dir).select(
        "message_id", payload.label_json(F.col("body")).alias("payload")
    )


def inprogress_view(spark, sf_dir):
    """What the view shows of each message, before the join that needs only its id."""
    return queue.pending(records.inprogress_view(_ragged(spark, sf_dir)), fixtures.acks(spark, sf_dir))


def inprogress_rejects(spark, sf_dir):
    sent = _ragged(spark, sf_dir)
    rejects = records.inprogress_rejects(queue.pending(sent, fixtures.acks(spark, sf_dir)))
    return rejects.withColumn("missing", F.array_join("missing", ", "))


def track_delivered(spark, sf_dir):
    """The table that the ingest stream fills, found by its name."""
    return tracking.track_delivered(spark.table(lakes.inventory(spark, sf_dir)))


def track_delivered_gold(spark, sf_dir):
    return tracking.track_delivered(gold.read_gold(spark, lakes.gold(spark, sf_dir)))


def result_as_text(spark, sf_dir):
    typed = records.typed_view(fixtures.crates(spark, sf_dir).select(*CRATE_FIELDS))
    return records.result_as_text(typed)


def _forms(spark, sf_dir):
    return spark.read.schema(CRATE_SCHEMA).parquet(lakes.forms(spark, sf_dir))


def validate_accept(spark, sf_dir):
    return records.accepted(_forms(spark, sf_dir))


def validate_reject(spark, sf_dir):
    bad = records.rejected(_forms(spark, sf_dir))
    return bad.select("crate_id", F.array_join("reason", "; ").alias("reason"))


# --- queue


def pending(spark, sf_dir):
    sent = fixtures.sent(spark, sf_dir)
    return _plain_times(queue.pending(sent, fixtures.acks(spark, sf_dir)))


def pending_after_scan(spark, sf_dir):
    """Scans the acknowledged part of the queue as a stream; what is left is pending."""
    raw, acked = shared_path(spark, "scanned"), shared_path(spark, "acks")
    path = lakes.queue(spark, sf_dir)
    to_scan = fixtures.acks(spark, sf_dir).distinct()
    stream = messages.stream_messages(spark, path).join(to_scan, "message_id", "left_semi")
    flows.scan_messages(stream, raw, acked, shared_path(spark, "scan-checkpoint"))
    left = queue.pending(messages.read_messages(spark, path), flows.read_acks(spark, acked))
    landed = csvfiles.read_crate_csv(spark, raw)
    state = left.select("message_id", F.lit("pending").alias("state")).unionByName(
        landed.select(F.col("crate_id").alias("message_id"), F.lit("landed").alias("state"))
    )
    return state


def queue_retired(spark, sf_dir):
    """Acknowledged messages were sent apart; their files leave the queue, the others stay pending."""
    sent, acked, retired = (shared_path(spark, x) for x in ("retiring", "retiring-acks", "retired"))
    rows, done = messages.read_messages(spark, lakes.queue(spark, sf_dir)), fixtures.acks(spark, sf_dir).distinct()
    marked = rows.join(done.withColumn("settled", F.lit(True)), "message_id", "left")
    messages.send_messages(marked.withColumn("settled", F.col("settled").isNotNull()), sent, apart="settled")
    done.write.parquet(f"{acked}/batch=0")
    flows.retire_files(spark, sent, acked, retired)
    left = queue.pending(messages.read_messages(spark, sent), flows.read_acks(spark, acked))
    state = lambda df, name: df.select("message_id", F.lit(name).alias("state"))
    return state(left, "pending").unionByName(state(messages.read_messages(spark, f"{retired}/queue"), "retired"))


def pending_bucketed(spark, sf_dir):
    """What is pending, from tables of messages and acknowledgements that are bucketed alike."""
    name = f"queue_{uuid.uuid4().hex}"
    messages.save_bucketed(fixtures.sent(spark, sf_dir), f"{name}_sent", 8)
    messages.save_bucketed(fixtures.acks(spark, sf_dir), f"{name}_acked", 8)
    return _plain_times(queue.pending(spark.table(f"{name}_sent"), spark.table(f"{name}_acked")))


def queue_head(spark, sf_dir):
    sent = messages.read_messages(spark, lakes.queue(spark, sf_dir))
    return _plain_times(queue.peek_pending(sent, fixtures.acks(spark, sf_dir), 1))


def queue_peek10(spark, sf_dir):
    sent = messages.read_messages(spark, lakes.queue(spark, sf_dir))
    return _plain_times(queue.peek_pending(sent, fixtures.acks(spark, sf_dir)))


def inprogress_page(spark, sf_dir):
    """The first ten pending messages, those of them that have every field of the view."""
    first = queue.peek_pending(_ragged(spark, sf_dir), fixtures.acks(spark, sf_dir))
    return records.inprogress_view(first)


def waiting_files(spark, sf_dir):
    return queue.waiting(queue.arrival_notifications(fixtures.objects(spark, sf_dir)))


# --- dashboard


def kpi_cards(spark, sf_dir):
    crates = fixtures.order_crates(spark, sf_dir)
    return dashboard.kpi_cards(crates, F.col("return_status") == "Returned")


def _requests(spark, sf_dir):
    return fixtures.order_crates(spark, sf_dir).withColumn("day", F.to_date("sent_ts"))


def requests_7d(spark, sf_dir):
    return dashboard.requests_per_day(_requests(spark, sf_dir), F.col("day"), WEEK_END)


def fulfilled_by_month(spark, sf_dir):
    return dashboard.fulfilled_by_month(
        _requests(spark, sf_dir), F.col("day"), YEAR, F.col("shipment_status") == "Delivered"
    )


def series_max(spark, sf_dir):
    week = dashboard.series_max(requests_7d(spark, sf_dir))
    year = dashboard.series_max(fulfilled_by_month(spark, sf_dir))
    return week.select(F.lit("week").alias("series"), "series_max").unionByName(
        year.select(F.lit("year").alias("series"), "series_max")
    )


def requested_vs_flagged(spark, sf_dir):
    return dashboard.requested_vs_flagged(
        _requests(spark, sf_dir), F.col("day"), WEEK_END, F.col("return_status") == "Returned"
    )


def category_share(spark, sf_dir):
    return dashboard.category_share(fixtures.crates(spark, sf_dir), "company_name")


def _rollup(spark, sf_dir):
    """Crates counted by the columns of the dashboard, in four micro-batches."""
    rows = fixtures.crates(spark, sf_dir).withColumn("day", F.to_date("sent_ts"))
    by = rows.select("day", "company_name", "return_status", "shipment_status").schema
    kept = rollups.Rollup(spark, lakes.rollup(spark, sf_dir, by), by)
    return kept, kept.counts()


def kpi_cards_rollup(spark, sf_dir):
    kept, counts = _rollup(spark, sf_dir)
    return dashboard.kpi_cards_of(counts, kept.crates(), F.col("return_status") == "Returned")


def requested_vs_flagged_rollup(spark, sf_dir):
    _, counts = _rollup(spark, sf_dir)
    return dashboard.requested_vs_flagged(
        counts, F.col("day"), WEEK_END, F.col("return_status") == "Returned", weight="n"
    )


def fulfilled_by_month_rollup(spark, sf_dir):
    _, counts = _rollup(spark, sf_dir)
    return dashboard.fulfilled_by_month(counts, F.col("day"), YEAR, F.col("shipment_status") == "Delivered", "n")


def category_share_rollup(spark, sf_dir):
    _, counts = _rollup(spark, sf_dir)
    return dashboard.category_share(counts, "company_name", "n")


# --- table browsing


def table_search(spark, sf_dir):
    return browse.table_search(
        fixtures.crates(spark, sf_dir).select(*TRACKING_FIELDS), "ASIA glass"
    )


def _cells(spark, sf_dir):
    """Events with a column of prices, percentages, words and gaps."""
    value = F.col("value").cast("decimal(12,2)").cast("string")
    pick = F.col("event_id") % 4
    return fixtures.table(spark, sf_dir, "events").select(
        "event_id",
        F.when(pick == 0, F.concat(F.lit("$"), value))
        .when(pick == 1, F.concat(value, F.lit(" %")))
        .when(pick == 2, F.concat(F.initcap("event_type"), F.lit(" "), value)).alias("cell"),
    )


def table_sort_asc(spark, sf_dir):
    return browse.table_sort(_cells(spark, sf_dir), "cell", row_key="event_id")


def table_sort_desc(spark, sf_dir):
    return browse.table_sort(_cells(spark, sf_dir), "cell", row_key="event_id", ascending=False)


def table_page(spark, sf_dir):
    """Third page of a search, sorted by a column."""
    found = browse.table_search(
        fixtures.crates(spark, sf_dir).select(*TRACKING_FIELDS, "seq"), "asia glass"
    )
    return browse.table_page(found, "return_date", row_key="seq", ascending=False, page=3)


def table_page_far(spark, sf_dir):
    """A page located by position, as pages far into a large table are."""
    return browse.table_page(
        _cells(spark, sf_dir), "cell", row_key="event_id", page=30, size=25, near_rows=0
    )


def table_page_stored(spark, sf_dir):
    """A far page of an order that was sorted once."""
    return ordered.stored_page(spark, lakes.cell_order(spark, sf_dir, _cells(spark, sf_dir)), page=30, size=25)


def table_page_count(spark, sf_dir):
    return browse.page_count(fixtures.order_crates(spark, sf_dir))


# --- scalar functions


def date_scalars(spark, sf_dir):
    ts = F.col("ts")
    event_text = dates.timestamp_text(ts, "%Y-%m-%dT%H:%M:%S.%fZ")
    some = F.when(F.col("event_id") % 3 != 0, ts)
    return _plain_times(fixtures.table(spark, sf_dir, "events").select(
        "event_id",
        dates.timestamp_text(some).alias("default_text"),
        dates.timestamp_text(ts, "%Y-%m-%d").alias("date_text"),
        dates.compact_timestamp(ts).alias("compact_text"),
        dates.event_timestamp(event_text).alias("parsed_ts"),
        dates.event_timestamp(dates.compact_timestamp(ts)).alias("unparsed_ts"),
        dates.event_date(event_text).alias("event_date"),
        dates.days_later(F.to_date(ts)).alias("week_later"),
    ))


def key_scalars(spark, sf_dir):
    suffix = F.when(F.col("page_id") % 2 == 0, ".csv").otherwise(".parquet")
    # Every third key has escapes, a plus sign and signs that escape nothing.
    odd = F.when(F.col("page_id") % 3 == 0, "/a%20b+c%2Bd%C3%A9%zz100%").otherwise("")
    uri = F.concat(F.regexp_replace("url", "^https?://", "s3://"), odd, suffix)
    pages = fixtures.table(spark, sf_dir, "pages").select("page_id", uri.alias("uri"))
    key = keys.uri_key(F.col("uri"))
    return pages.select(
        "page_id",
        keys.uri_bucket(F.col("uri")).alias("bucket"),
        key.alias("object_key"),
        keys.basename(F.col("uri")).alias("basename"),
        keys.archive_key(key).alias("archive_key"),
        keys.url_decoded(F.col("uri")).alias("decoded"),
        keys.silver_key(F.lit(dt.date(2023, 12, 8)), F.col("uri")).alias("silver_key"),
        keys.is_csv(F.col("uri")).alias("is_csv"),
    )


def string_scalars(spark, sf_dir):
    body = F.concat_ws(" | ", "c_name", "c_mktsegment", F.lit("é, ü and some more text " * 4))
    return fixtures.table(spark, sf_dir, "customer").select(
        "c_custkey",
        text.zero_padded(F.col("c_custkey").cast("string")).alias("padded"),
        text.base64_text(body).alias("base64"),
        text.content_hash(body).alias("hash"),
        text.scan_completed_text(F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")))
        .alias("message"),
    )


def unit_scalars(spark, sf_dir):
    crates = fixtures.order_crates(spark, sf_dir)
    return crates.select(
        "crate_id",
        "weight",
        text.quantity_value(F.col("weight"), "kg").alias("kilograms"),
        text.quantity_value(F.col("temperature"), "C", 6).alias("celsius"),
        text.quantity_value(F.col("weight"), "C", 6).alias("wrong_unit"),
    )


def json_scalars(spark, sf_dir):
    fields = payload.fields_of(F.col("props"))
    k, absent = fields["k"], fields["absent"]
    return fixtures.table(spark, sf_dir, "events").select(
        "event_id",
        k.alias("k"),
        absent.alias("absent"),
        F.map_contains_key(fields, "absent").alias("has_absent"),
        F.to_json(F.struct(k.alias("k"), absent.alias("absent")), {"ignoreNullFields": "false"})
        .alias("encoded"),
    )


# --- deduplication and batches


def dedup_fifo(spark, sf_dir):
    sent = fixtures.contents(fixtures.table(spark, sf_dir, "events"))
    return _plain_times(dedup.accepted_messages(
        sent, INTERVAL, key="dedup_key", ts="ts", tie="event_id"
    ))


def _event_stream(spark, sf_dir):
    schema = fixtures.table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def dedup_fifo_stream(spark, sf_dir):
    target = shared_path(spark, "accepted")
    kept = deduplicate_stream(
        fixtures.contents(_event_stream(spark, sf_dir)), INTERVAL,
        key="dedup_key", ts="ts", tie="event_id",
    )
    kept.writeStream.format("parquet").option("path", target).option(
        "checkpointLocation", shared_path(spark, "dedup-checkpoint")
    ).trigger(availableNow=True).start().awaitTermination()
    return _plain_times(spark.read.schema(kept.schema).parquet(target))


def dedup_fifo_batches(spark, sf_dir):
    path = shared_path(spark, "accepted-batches")
    deduplicate_batches(
        fixtures.contents(_event_stream(spark, sf_dir)), INTERVAL,
        key="dedup_key", ts="ts", tie="event_id",
        path=path, checkpoint=shared_path(spark, "dedup-batches-checkpoint"),
    )
    return _plain_times(read_accepted(spark, path))


def dedup_fifo_chained(spark, sf_dir):
    """What the micro-batches accept, taken on by a stream that follows them."""
    path, target = shared_path(spark, "accepted-chained"), shared_path(spark, "followed")
    events = fixtures.contents(_event_stream(spark, sf_dir))
    names = {"key": "dedup_key", "ts": "ts", "tie": "event_id"}
    start_batches(
        events, INTERVAL, **names, path=path, checkpoint=shared_path(spark, "chained-checkpoint")
    ).awaitTermination()
    schema = events.select("dedup_key", "ts", "event_id").schema
    stream_accepted(spark, path, schema).writeStream.format("parquet").option("path", target).option(
        "checkpointLocation", shared_path(spark, "followed-checkpoint")
    ).trigger(availableNow=True).start().awaitTermination()
    return _plain_times(spark.read.schema(schema).parquet(target))


def count_batches(spark, sf_dir):
    arrivals = fixtures.table(spark, sf_dir, "events").select("event_id", "ts")
    return batches.count_batches(arrivals, "ts", "event_id")


def count_batches_stream(spark, sf_dir):
    path = shared_path(spark, "arrivals")
    flows.number_arrivals(
        _event_stream(spark, sf_dir).select("event_id", "ts"), "ts", "event_id",
        path=path, checkpoint=shared_path(spark, "arrivals-checkpoint"),
    )
    return flows.fired_batches(spark, path)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        src_messages, sink_messages, sink_bronze_csv, bronze_key, silver_route,
        silver_route_stream, route_rejects, scan_rejects, list_files, scan_silver_csv, gold_write, gold_partitions,
        gold_incremental, schema_report, notify_scanned, notify_arrival, canonical_record,
        label_payload_full, label_payload_scan, inprogress_view, inprogress_rejects,
        track_delivered, track_delivered_gold, result_as_text, validate_accept,
        validate_reject, pending, pending_after_scan, queue_head, queue_peek10, inprogress_page,
        waiting_files, kpi_cards, requests_7d, fulfilled_by_month, series_max,
        requested_vs_flagged, category_share, table_search, table_sort_asc, table_sort_desc,
        table_page, table_page_far, table_page_count, date_scalars, key_scalars,
        string_scalars, unit_scalars, json_scalars, dedup_fifo, dedup_fifo_stream, dedup_fifo_batches,
        count_batches, count_batches_stream, raw_moved, gold_compacted, queue_retired, dedup_fifo_chained,
        pending_bucketed, table_page_stored, kpi_cards_rollup, requested_vs_flagged_rollup, fulfilled_by_month_rollup,
        category_share_rollup,
    )
}
