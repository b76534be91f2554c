"""The whole lake below one folder: queue, landing zones, gold."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cratelake import session
from cratelake.functions.text import content_hash
from cratelake.model import LANDED_SCHEMA
from cratelake.operators import dashboard, dedup, queue, records, tracking
from cratelake.sources import compaction, csvfiles, files, gold, messages
from cratelake.sources.rollups import Rollup
from cratelake.streaming import flows
from cratelake.streaming.intake import read_taken


REPEAT = dt.timedelta(minutes=5)  # a content sent again within this time is dropped
ROLLUP_BY = ["creation_date", "company_name", "return_status", "shipment_status"]  # what dashboards count by


class CrateLake:
    """Send crates, scan them, and read them back once they are in the gold table.

    ``name`` is the gold table's name in the catalog, by which SQL finds it.
    """

    def __init__(self, spark: SparkSession, root: str, threshold: int = 10, name: str = "crate_inventory"):
        self.spark = spark
        self.threshold = threshold
        self.name = name
        self._root = root.rstrip("/")
        for zone in ("queue", "acks", "rejects", "notices", "raw", "unprocessed", "arrivals", "taken", "gold"):
            files.ensure_folder(spark, self._at(zone))
        gold.create_table(spark, name, self._at("gold"), batched=True)
        compaction.repair(spark, name)
        by = T.StructType([gold.GOLD_SCHEMA[x] for x in ROLLUP_BY])
        self.rollup = Rollup(spark, self._at("rollup"), by)
        if (through := self._committed()) >= 0 and not self.rollup.started():
            self.rollup.rebuild(self.table(), through)

    def _at(self, name: str) -> str:
        return f"{self._root}/{name}"

    def send(self, crates: DataFrame, message_id: str, sent_ts: str, seq: str) -> None:
        """Queue crate records; one that was queued less than ``REPEAT`` before is dropped.

        Of what was sent before, only the hours from the first new record's on are opened.
        """
        new = messages.as_messages(crates, message_id, sent_ts, seq)
        hashed = {"_content": content_hash(F.col("body"))}
        place = F.struct("seq", "message_id")
        scratch = session.shared_path(self.spark, "sent")
        stored = session.stored(new.withColumns(hashed).withColumn("_place", place), "sent", f"{scratch}/new")
        since = stored.agg(F.unix_micros(F.min("sent_ts"))).first()[0]
        if since is None:
            files.delete(self.spark, scratch)
            return
        kept = dedup.accepted_after(
            stored, self.sent_since(since - REPEAT // dt.timedelta(microseconds=1)).withColumns(hashed), REPEAT,
            key="_content", ts="sent_ts", tie="_place", scratch=f"{scratch}/narrow",
        )
        place_names = ["_content", "sent_ts", "_place"]
        accepted = stored.join(kept, place_names, "left_semi").select(*new.columns)
        messages.send_messages(accepted, self._at("queue"), by_hour=True)
        files.delete(self.spark, scratch)

    def sent_since(self, micros: int) -> DataFrame:
        """Messages sent later than ``micros`` since 1970, retired ones among them."""
        found = messages.read_since(self.spark, [self._at("queue"), self._at("retired/queue")], micros)
        return found.where(F.unix_micros("sent_ts") > micros)

    def retire(self, most: int = 10_000) -> int:
        """Take settled files out of the queue, so that what is pending is found among the others only."""
        return flows.retire_files(self.spark, self._at("queue"), self._at("acks"), self._at("retired"), most)

    def pending(self) -> DataFrame:
        """Messages not scanned yet."""
        sent = messages.read_messages(self.spark, self._at("queue"))
        return queue.pending(sent, flows.read_acks(self.spark, self._at("acks")))

    def in_progress(self, n: int = 10) -> DataFrame:
        """The first ``n`` pending messages as the queue view shows them."""
        sent = messages.read_messages(self.spark, self._at("queue"))
        acked = flows.read_acks(self.spark, self._at("acks"))
        return records.inprogress_view(queue.peek_pending(sent, acked, n))

    def scan(self) -> None:
        """Land and acknowledge what the queue has received since the last scan."""
        flows.scan_messages(
            messages.stream_messages(self.spark, self._at("queue")),
            self._at("raw"), self._at("acks"), self._at("checkpoints/scan"), self._at("rejects"),
            self._at("notices"),
        )

    def notices(self) -> DataFrame:
        """What has been scanned, one notification per crate."""
        return flows.read_notices(self.spark, self._at("notices"))

    def rejected(self) -> DataFrame:
        """Messages a scan could not read; they stay pending."""
        return flows.read_rejects(self.spark, self._at("rejects"))

    def route(self, arrival: Column | None = None) -> None:
        """Move landed records to their arrival date and announce the files; raw files go to ``routed``."""
        flows.route_files(
            self.spark, self._at("raw"), self._at("unprocessed"),
            self._at("checkpoints/route"), arrival, archive=self._at("routed"),
        )
        flows.announce_files(self.spark, self._at("unprocessed"), self._at("arrivals"))

    def waiting_files(self) -> DataFrame:
        """Announced files that no batch has taken yet."""
        taken = read_taken(self.spark, self._at("taken"))
        return flows.read_arrivals(self.spark, self._at("arrivals")).join(taken, "uri", "left_anti").select("uri")

    def ingest(self) -> None:
        """Take the routed files into the gold table, each once; consumed ones go to the archive."""
        flows.ingest_files(
            self.spark, self._at("unprocessed"), self._at("gold"),
            self._at("checkpoints/ingest"), archive=self._at("archive"), schema=LANDED_SCHEMA,
            table=self.name, taken=self._at("taken"), rollup=self.rollup,
        )

    def ingest_if_due(self) -> bool:
        """Ingest once more than the threshold of files wait; returns whether it did.

        Nothing is left to clear: a file stops waiting once a micro-batch of the ingest has noted it, whenever it came.
        """
        return flows.run_when_due(self.waiting_files(), self.ingest, lambda: None, self.threshold)

    def ingest_as_they_come(self, max_files: int = 1000, **trigger) -> StreamingQuery:
        """Count announced files as they come, and ingest whenever more than the threshold wait.

        A query that runs on with ``processingTime="1 minute"``, say; without a trigger it takes what is announced and
        ends. Use it or ``ingest_if_due``: each counts for itself.
        """
        arrivals = flows.stream_arrivals(self.spark, self._at("arrivals"), max_files)
        return flows.fire_when_full(
            arrivals, self.ingest, self._at("gate"), self._at("checkpoints/gate"), self.threshold, trigger or None
        )

    def _committed(self) -> int:
        """The last micro-batch of the ingest that will not run again."""
        done = files.folders(self.spark, self._at("checkpoints/ingest/commits/[0-9]*"))
        return max((int(x.rsplit("/", 1)[1]) for x in done), default=-1)

    def compact(self, most: int = 8) -> list[str]:
        """Rewrite dates that more than ``most`` micro-batches fed as one folder each; returns the dates."""
        return compaction.compact(self.spark, self.name, self._at("gold"), most, self._committed())

    def kpi_cards(self, flagged: Column) -> DataFrame:
        """The dashboard's cards from the rollup; ``flagged`` is a predicate on ``ROLLUP_BY``."""
        return dashboard.kpi_cards_of(self.rollup.counts(), self.rollup.crates(), flagged)

    def requests_per_day(self, end: dt.date, days: int = 7) -> DataFrame:
        """Crates that arrived on each of ``days`` days up to ``end``, from the rollup."""
        return dashboard.requests_per_day(self.rollup.counts(), F.col("creation_date"), end, days, "n")

    def table(self) -> DataFrame:
        return compaction.read_table(self.spark, self.name)

    def delivered(self, limit: int | None = None) -> DataFrame:
        return tracking.track_delivered(self.table(), limit)

    def landed(self) -> DataFrame:
        """Routed records that are not in the archive yet, dated by arrival."""
        found = csvfiles.read_crate_csv(self.spark, self._at("unprocessed"), LANDED_SCHEMA)
        return csvfiles.with_arrival(found, keep_declared=True)
