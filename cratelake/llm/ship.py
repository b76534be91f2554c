"""Gives the executors this package, for sessions that were started without --py-files."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_NAME = "cratelake_package"


def ship(spark: SparkSession) -> None:
    """Add the package to the session's Python files, once; Spark carries them to every executor."""
    context = spark.sparkContext
    if not any(x.endswith(f"{_NAME}.zip") for x in context.listFiles):
        package = Path(__file__).resolve().parents[1]
        base = Path(tempfile.mkdtemp(prefix="cratelake-")) / _NAME
        context.addPyFile(shutil.make_archive(str(base), "zip", package.parent, package.name))
