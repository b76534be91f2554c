"""Small helpers over the cluster's file system."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# A file stream forgets files this much older than its newest. Spark's own week would drop files
# that keep their change time when they are moved or restored.
MAX_FILE_AGE = "36500d"
MOVERS = 8  # files moved at a time; where a move is a copy, they wait on the store, not on the driver


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _path(spark, path)
    return fs.exists(hadoop_path)


def ensure_folder(spark: SparkSession, path: str) -> str:
    hadoop_path, fs = _path(spark, path)
    fs.mkdirs(hadoop_path)
    return path


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match ``pattern``; for folders whose number is bounded, not for data files."""
    hadoop_path, fs = _path(spark, pattern)
    return [status.getPath().toString() for status in fs.globStatus(hadoop_path) or []]


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder of our own; nothing happens if it is gone."""
    hadoop_path, fs = _path(spark, path)
    fs.delete(hadoop_path, True)


def plain(spark: SparkSession, uri: str) -> str:
    """A file's URI as ``list_files`` states it, without percent signs for its characters."""
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spark.sparkContext._jvm.java.net.URI(uri)).toString()


def below(spark: SparkSession, uri: str, folder: str) -> str:
    """The part of a plain URI that follows ``folder``, whatever scheme either states."""
    inner, outer = (_path(spark, x)[0].toUri().getPath() for x in (uri, folder))
    if not inner.startswith(outer + "/"):
        raise ValueError(f"{uri} does not lie in {folder}")
    return inner[len(outer) + 1:]


def move(spark: SparkSession, path: str, target: str) -> bool:
    """Move a file; False if it is gone. A move that the file system refuses fails."""
    source, fs = _path(spark, path)
    if not fs.exists(source):
        return False
    goal, _ = _path(spark, target)
    fs.mkdirs(goal.getParent())
    if not fs.rename(source, goal):
        raise OSError(f"cannot move {path} to {target}")
    return True


def move_below(spark: SparkSession, uris: list[str], source: str, target: str) -> int:
    """Move files of ``source``, given as plain URIs, to the same places below ``target``; returns how many were there."""
    with ThreadPoolExecutor(MOVERS) as pool:
        return sum(pool.map(lambda x: move(spark, x, f"{target}/{below(spark, x, source)}"), uris))


def drop_emptied(spark: SparkSession, path: str) -> None:
    """Remove folders of micro-batches that have only marks left, but not the newest: its mark tells that it is complete."""
    found = sorted((int(x.rsplit("=", 1)[1]), x) for x in folders(spark, f"{path}/batch=[0-9]*"))
    for _, folder in found[:-1]:
        hadoop_path, fs = _path(spark, folder)
        if all(x.getPath().getName().startswith(("_", ".")) for x in fs.listStatus(hadoop_path)):
            delete(spark, folder)


def list_files(spark: SparkSession, path: str, suffix: str = ".csv") -> DataFrame:
    """URI, size and change time of every file below ``path`` with that suffix.

    Only metadata: the content column is pruned, so no file is opened.
    """
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*{suffix}").option("recursiveFileLookup", "true")
        .load(path)
        .select(F.col("path").alias("uri"), "length", "modificationTime")
    )
