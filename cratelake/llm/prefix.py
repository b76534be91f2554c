"""Running totals over a whole table in one order, without sorting it in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cratelake.llm.store import stored


def running_total(rows: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """``rows`` with ``name``: the sum of ``value`` over all rows before, in ``order``.

    Rows are range-sorted and stored with their range's number. Sums run within a range; the
    ranges' totals, one row each, are added up and broadcast. ``order`` should tell rows apart,
    so that no range gets more than its part; rows equal in it may come in any order. Neither
    ``value`` nor the columns of ``order`` may be null.
    """
    ranged = stored(
        rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranges"
    )
    upto = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_part").agg(F.sum(value).alias("_total"))
    offsets = totals.select("_part", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
    return (
        ranged.withColumn("_upto", F.sum(value).over(upto)).join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_upto") - F.col(value))
        .drop("_part", "_upto", "_offset")
    )
