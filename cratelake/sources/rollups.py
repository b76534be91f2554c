"""Counts and distinct crates kept with the ingest, so that dashboard numbers need no scan of gold.

A micro-batch adds one small folder: rows counted by the report's columns, and the crates it saw. Crates
with a plain number for an id are bits in bitmaps, 32,768 to a row; others are listed as they are.
Folders are merged when read; every so often the older ones are folded into one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cratelake.sources import files

FOLD_EVERY = 16  # micro-batches that are read beside the folded ones

_IDS = "slot BIGINT, bits BINARY, odd STRING"


class Rollup:
    """The rollup below ``path`` by the columns ``by``, of rows whose crate is ``key``."""

    def __init__(self, spark: SparkSession, path: str, by: T.StructType, key: str = "crate_id"):
        self.spark, self.path, self.by, self.key = spark, path.rstrip("/"), by, key

    def add(self, batch: DataFrame, batch_id: int) -> None:
        """Add a micro-batch's rows; again replaces the same. A null id is no crate but counts as a row."""
        counted = batch.groupBy(*self.by.names).agg(F.count(F.lit(1)).alias("n"))
        counted.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/counts/batch={batch_id}")
        self._bitmaps(batch).write.mode("overwrite").parquet(f"{self.path}/ids/batch={batch_id}")
        self._fold("counts", batch_id, self._merged_counts)
        self._fold("ids", batch_id, self._merged_ids)

    def rebuild(self, rows: DataFrame, through: int) -> None:
        """Take all rows there are through a micro-batch, for a table that was fed before it had a rollup."""
        counted = rows.groupBy(*self.by.names).agg(F.count(F.lit(1)).alias("n"))
        counted.write.mode("overwrite").parquet(f"{self.path}/counts/through={through}")
        self._bitmaps(rows).write.mode("overwrite").parquet(f"{self.path}/ids/through={through}")

    def started(self) -> bool:
        return all(self._complete(part, "through") or self._complete(part, "batch") for part in ("counts", "ids"))

    def counts(self) -> DataFrame:
        """The columns ``by`` and ``n``, the number of rows."""
        return self._merged_counts(self._read("counts"))

    def crates(self) -> DataFrame:
        """One row: ``total_crates``, the exact number of distinct ids."""
        ids = self._merged_ids(self._read("ids"))
        return ids.agg(
            (F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)) + F.count("odd")).cast("long").alias("total_crates")
        )

    def _bitmaps(self, rows: DataFrame) -> DataFrame:
        key = F.col(self.key).cast("string")
        number = key.try_cast("long")
        plain = F.when((number.cast("string") == key) & (number > 0), number)
        told = rows.where(key.isNotNull()).select(plain.alias("number"), F.when(plain.isNull(), key).alias("odd"))
        bits = told.where("number is not null").groupBy(F.bitmap_bucket_number("number").alias("slot")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")
        )
        odd = told.where("odd is not null").select("odd").distinct()
        return bits.select("slot", "bits", F.lit(None).cast("string").alias("odd")).unionByName(
            odd.select(F.lit(None).cast("long").alias("slot"), F.lit(None).cast("binary").alias("bits"), "odd")
        )

    def _merged_counts(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.by.names).agg(F.sum("n").alias("n"))

    def _merged_ids(self, rows: DataFrame) -> DataFrame:
        bits = rows.where("slot is not null").groupBy("slot").agg(F.bitmap_or_agg("bits").alias("bits"))
        odd = rows.where("odd is not null").select("odd").distinct()
        return bits.withColumn("odd", F.lit(None).cast("string")).unionByName(
            odd.select(F.lit(None).cast("long").alias("slot"), F.lit(None).cast("binary").alias("bits"), "odd")
        )

    def _schema(self, part: str) -> T.StructType | str:
        return T.StructType([*self.by, T.StructField("n", T.LongType())]) if part == "counts" else _IDS

    def _complete(self, part: str, kind: str) -> list[int]:
        found = (int(x.rsplit("=", 1)[1]) for x in files.folders(self.spark, f"{self.path}/{part}/{kind}=*"))
        return sorted(x for x in found if files.exists(self.spark, f"{self.path}/{part}/{kind}={x}/_SUCCESS"))

    def _read(self, part: str, upto: int | None = None) -> DataFrame:
        """The newest folded folder, if it goes no further than ``upto``, and the micro-batches after it."""
        last = lambda x: upto is None or x <= upto
        folded = max(filter(last, self._complete(part, "through")), default=None)
        paths = [] if folded is None else [f"{self.path}/{part}/through={folded}"]
        paths += [
            f"{self.path}/{part}/batch={x}" for x in self._complete(part, "batch")
            if last(x) and (folded is None or x > folded)
        ]
        if not paths:
            return self.spark.createDataFrame([], self._schema(part))
        return self.spark.read.schema(self._schema(part)).parquet(*paths)

    def _fold(self, part: str, batch_id: int, merged) -> None:
        """Fold all before this micro-batch, which may still run again, and remove what the fold before it held."""
        folded = self._complete(part, "through")
        done = folded[-1] if folded else -1
        if batch_id - 1 - done < FOLD_EVERY:
            return
        merged(self._read(part, batch_id - 1)).write.mode("overwrite").parquet(f"{self.path}/{part}/through={batch_id - 1}")
        for x in self._complete(part, "batch"):
            if x <= done:
                files.delete(self.spark, f"{self.path}/{part}/batch={x}")
        for x in folded[:-1]:
            files.delete(self.spark, f"{self.path}/{part}/through={x}")
