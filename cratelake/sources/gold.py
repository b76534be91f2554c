"""The gold table: Parquet, one directory per arrival date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cratelake.model import ARRIVAL_DATE, CRATE_FIELDS
from cratelake.sources.files import folders

BATCH = "batch"  # second partition column of a table that a stream feeds

GOLD_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in CRATE_FIELDS[:-1]]
    + [T.StructField(ARRIVAL_DATE, T.DateType())]
)


def write_gold(crates: DataFrame, path: str) -> None:
    """Append. A date's rows share a file unless they are too many for one task."""
    (crates.hint("rebalance", ARRIVAL_DATE)
     .write.mode("append").partitionBy(ARRIVAL_DATE).parquet(path))


def write_batch(crates: DataFrame, path: str, batch_id: int, table: str | None = None) -> None:
    """Add a micro-batch: the dates it touches get a folder of its number, which a repeated run replaces.

    With ``table`` the new partitions are registered. Rows without a date go to the folder's
    null date, which no table shows; ``undated`` gives them.
    """
    (crates.withColumn(BATCH, F.lit(batch_id)).hint("rebalance", ARRIVAL_DATE)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(ARRIVAL_DATE, BATCH).parquet(path))
    if table:
        touched = folders(crates.sparkSession, f"{path}/{ARRIVAL_DATE}=[0-9]*/{BATCH}={batch_id}")
        dates = [folder.split("/")[-2].split("=")[1] for folder in touched]
        add_partitions(crates.sparkSession, table, dates, batch_id)


def read_gold(spark: SparkSession, path: str, schema: T.StructType = GOLD_SCHEMA) -> DataFrame:
    """By path, with no pass over the files to find their schema."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def read_batch(spark: SparkSession, path: str, batch_id: int) -> DataFrame:
    """The dated rows that ``write_batch`` wrote for one micro-batch."""
    found = folders(spark, f"{path}/{ARRIVAL_DATE}=[0-9]*/{BATCH}={batch_id}")
    if not found:
        return spark.createDataFrame([], GOLD_SCHEMA)
    return spark.read.schema(GOLD_SCHEMA).option("basePath", path).parquet(*found).select(*GOLD_SCHEMA.names)


def undated(spark: SparkSession, path: str) -> DataFrame:
    """Rows of files that lay below no date; they are kept, but stand under no date's partition."""
    return read_gold(spark, path).where(F.col(ARRIVAL_DATE).isNull())


def create_table(
    spark: SparkSession, table: str, path: str, schema: T.StructType = GOLD_SCHEMA,
    batched: bool = False,
) -> None:
    """Name the folder as a table, ``batched`` if ``write_batch`` fills it.

    Its partitions are not registered yet.
    """
    parts = ARRIVAL_DATE
    if batched:
        schema, parts = T.StructType([*schema, T.StructField(BATCH, T.IntegerType())]), f"{parts}, {BATCH}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING PARQUET "
        f"PARTITIONED BY ({parts}) LOCATION '{path}'"
    )


def repair_table(spark: SparkSession, table: str) -> None:
    """Register every partition found in the folder."""
    spark.sql(f"MSCK REPAIR TABLE {table}")


def add_partitions(
    spark: SparkSession, table: str, dates: list[str], batch_id: int | None = None
) -> None:
    """Register known new dates, or a micro-batch's, without listing the whole folder."""
    batch = "" if batch_id is None else f", {BATCH}={batch_id}"
    parts = " ".join(f"PARTITION ({ARRIVAL_DATE}=DATE'{date}'{batch})" for date in dates)
    if parts:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {parts}")


def partitions(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {table}")


def schema_report(df: DataFrame) -> DataFrame:
    """Column names and types, as rows."""
    rows = [(i, name, kind) for i, (name, kind) in enumerate(df.dtypes, start=1)]
    return df.sparkSession.createDataFrame(
        rows, "position INT, column_name STRING, data_type STRING"
    )
