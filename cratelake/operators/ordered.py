"""A sorted copy of a table under a name, from which pages are read without sorting again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cratelake.operators.browse import PAGE_SIZE, table_sort

POSITION = "_position"


def store_order(
    df: DataFrame, path: str, name: str, *, row_key: str, ascending: bool = True
) -> None:
    """Sort ``df`` by ``name`` once, as ``table_sort`` does, and keep the rows with their places.

    Files and row groups hold consecutive places, which their statistics state.
    """
    placed = table_sort(df, name, row_key=row_key, ascending=ascending).withColumnRenamed("pos", POSITION)
    placed.write.mode("overwrite").parquet(path)


def stored_page(spark: SparkSession, path: str, page: int = 1, size: int = PAGE_SIZE) -> DataFrame:
    """One page of a stored order: only row groups with its places are read, and only its rows are sorted."""
    if page < 1 or size < 1:
        raise ValueError("page and size start at 1")
    rows = spark.read.parquet(path)
    on_page = rows.where(F.col(POSITION).between((page - 1) * size + 1, page * size))
    return on_page.orderBy(POSITION).drop(POSITION)


def stored_rows(spark: SparkSession, path: str) -> int:
    """Rows of a stored order, from the files' footers."""
    return spark.read.parquet(path).count()
