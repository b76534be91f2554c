"""CSV landing zones: ``raw/`` (as scanned) and ``unprocessed/creation_date=…/`` (routed)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cratelake.model import ARRIVAL_DATE, CRATE_FIELDS, CRATE_SCHEMA, DECLARED_DATE
from cratelake.sources.files import MAX_FILE_AGE

# Quotes are doubled, fields keep outer blanks and may hold line breaks.
WRITE_OPTIONS = {
    "header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
# Columns go by position, so a file whose header differs must fail, not shift.
READ_OPTIONS = {
    "header": "true", "escape": '"', "multiLine": "true", "enforceSchema": "false",
    "recursiveFileLookup": "true",
}
# A file with line breaks inside fields is read by one task; this keeps files small.
FILE_ROWS = 500_000


def write_raw(crates: DataFrame, path: str, mode: str = "append") -> None:
    """Land crate records; part names are unique, so no landing replaces another."""
    (crates.select(*CRATE_FIELDS).write.mode(mode).options(**WRITE_OPTIONS)
     .option("maxRecordsPerFile", FILE_ROWS).csv(path))


def read_crate_csv(
    spark: SparkSession, path: str, schema: T.StructType = CRATE_SCHEMA, line_breaks: bool = True,
) -> DataFrame:
    """All columns as text. The directory never supplies or renames a column.

    With ``line_breaks`` fields may hold them, and a file is read by one task; where no field does,
    say so, and large files of others are split.
    """
    options = {**READ_OPTIONS, "multiLine": str(line_breaks).lower()}
    return spark.read.schema(schema).options(**options).csv(path)


def stream_crate_csv(
    spark: SparkSession, path: str, schema: T.StructType = CRATE_SCHEMA,
    max_files: int = 1000, archive: str | None = None, max_age: str = MAX_FILE_AGE,
) -> DataFrame:
    """Each file once, however old. ``archive`` moves consumed files there, one batch behind."""
    reader = (
        spark.readStream.schema(schema).options(**READ_OPTIONS)
        .option("maxFilesPerTrigger", max_files).option("maxFileAge", max_age)
    )
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.csv(path)


def path_date(path: Column) -> Column:
    """Arrival date in a ``creation_date=…`` directory name."""
    text = F.regexp_extract(path, f"/{ARRIVAL_DATE}=([^/]+)/", 1)
    return F.nullif(text, F.lit("")).try_cast("date")


def with_arrival(landed: DataFrame, keep_declared: bool = False, *others: Column) -> DataFrame:
    """Routed records with the directory's date as ``creation_date``, and the columns ``others``.

    The record's own date is dropped or kept under another name.
    """
    declared = DECLARED_DATE if DECLARED_DATE in landed.columns else ARRIVAL_DATE
    fields = [
        *CRATE_FIELDS[:-1],
        *([F.col(declared).alias(DECLARED_DATE)] if keep_declared else []),
        path_date(F.col("_metadata.file_path")).alias(ARRIVAL_DATE), *others,
    ]
    return landed.select(*fields)


def write_routed(crates: DataFrame, arrival: Column, path: str) -> None:
    """Route records to their arrival date's directory.

    Rebalancing puts a date's rows together and splits a date with very many.
    """
    (crates.select(
        *CRATE_FIELDS[:-1], F.col(ARRIVAL_DATE).alias(DECLARED_DATE), arrival.alias(ARRIVAL_DATE)
     )
     .hint("rebalance", ARRIVAL_DATE)
     .write.mode("append").options(**WRITE_OPTIONS)
     .option("maxRecordsPerFile", FILE_ROWS).partitionBy(ARRIVAL_DATE).csv(path))
