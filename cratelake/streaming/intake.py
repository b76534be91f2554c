"""Files that a stream has taken: noted with each micro-batch, moved away once it is committed.

A micro-batch writes its notes before its rows. Its files move only after the stream's checkpoint
has committed it, so a run that stops anywhere finds them again: uncommitted ones still lie in the
source and are taken again by the same micro-batch, committed ones are moved by the next sweep.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cratelake.sources import files

FILE = "_file"  # where a row of a noted stream comes from
_NOTES = "uri string"


def file_of() -> Column:
    """To be selected from a file stream itself."""
    return F.col("_metadata.file_path").alias(FILE)


class Intake:
    """What micro-batches of the stream with ``checkpoint`` took from the folder ``source``.

    Notes are one small Parquet folder per micro-batch, no longer than the files that the source's
    ``maxFilesPerTrigger`` lets in. With ``archive`` they last until their files are there; without, they are kept.
    """

    def __init__(self, spark: SparkSession, source: str, notes: str, checkpoint: str, archive: str | None = None):
        self.spark, self.source, self.notes = spark, source.rstrip("/"), notes.rstrip("/")
        self.checkpoint, self.archive = checkpoint.rstrip("/"), archive and archive.rstrip("/")

    def note(self, batch: DataFrame, batch_id: int) -> None:
        """Note the files that the rows of ``batch`` come from, by their column ``FILE``; again changes nothing."""
        taken = [(files.plain(self.spark, r[FILE]),) for r in batch.select(FILE).distinct().collect()]
        self.spark.createDataFrame(taken, _NOTES).coalesce(1).write.mode("overwrite").parquet(
            f"{self.notes}/batch={batch_id}"
        )

    def taken(self) -> DataFrame:
        """URIs of all noted files, those of a micro-batch that is not committed yet among them."""
        return read_taken(self.spark, self.notes)

    def sweep(self) -> int:
        """Move the files of committed micro-batches to the archive; returns how many were moved.

        A file that is gone was moved before. Folders the moves emptied go as well, but for the
        newest, whose mark tells its writer that it is complete.
        """
        if not self.archive:
            return 0
        moved = 0
        for folder in files.folders(self.spark, f"{self.notes}/batch=*"):
            batch_id = int(folder.rsplit("=", 1)[1])
            if not files.exists(self.spark, f"{self.checkpoint}/commits/{batch_id}"):
                continue
            noted = [r["uri"] for r in self.spark.read.schema(_NOTES).parquet(folder).collect()]
            moved += files.move_below(self.spark, noted, self.source, self.archive)
            files.delete(self.spark, folder)
        if moved:
            files.drop_emptied(self.spark, self.source)
        return moved


    def sweep_bare(self, longest: int) -> int:
        """Move files of ``longest`` bytes at most, which hold a header only. Files without a row are in no note;
        this is for a stream that has ended, when no micro-batch waits to read them."""
        if not self.archive:
            return 0
        bare = files.list_files(self.spark, self.source).where(F.col("length") <= longest)
        found = [r["uri"] for r in bare.select("uri").collect()]
        moved = files.move_below(self.spark, found, self.source, self.archive)
        files.drop_emptied(self.spark, self.source)
        return moved


def read_taken(spark: SparkSession, notes: str) -> DataFrame:
    return spark.read.schema(_NOTES).option("recursiveFileLookup", "true").parquet(notes)
