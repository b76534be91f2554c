"""Count-triggered batches: more than ``threshold`` waiting arrivals make one batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratelake.operators.numbering import with_position


def batch_of(arrival_no: Column, threshold: int = 10) -> Column:
    """0-based batch of the 1-based arrival; a batch fires at threshold + 1 arrivals."""
    return F.call_function("div", arrival_no - 1, F.lit(threshold + 1))


def full_batches(numbered: DataFrame, total: int | Column, threshold: int = 10) -> DataFrame:
    """Arrivals whose batch has fired; the rest still wait."""
    total = total if isinstance(total, Column) else F.lit(total)
    fired = F.call_function("div", total, F.lit(threshold + 1))
    return numbered.withColumn("batch_id", batch_of(F.col("arrival_no"), threshold)).where(
        F.col("batch_id") < fired
    )


def count_batches(arrivals: DataFrame, *order: str, threshold: int = 10) -> DataFrame:
    """Every arrival of a fired batch with its number and batch, in ``order``."""
    numbered = with_position(arrivals, *order, name="arrival_no")
    total = numbered.agg(F.coalesce(F.max("arrival_no"), F.lit(0))).scalar()
    return full_batches(numbered, total, threshold)
