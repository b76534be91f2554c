"""Row numbers over a whole table without sorting it in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cratelake.session import stored

_ROW_BITS = 33  # of monotonically_increasing_id: the row within its partition


def with_position(
    df: DataFrame, *order: Column | str, name: str = "pos", keep: list[str] | None = None
) -> DataFrame:
    """``df``, or its columns ``keep``, with the 1-based place of each row in ``order``.

    ``order`` should end in a unique column, so that the place of equal rows is fixed and
    the range shuffle can split a value that many rows share. The sorted rows are stored
    once: counting them and numbering them must see the same partitions. The offsets are
    one row per partition, which bounds the window and the broadcast below.
    """
    slot = F.col("_slot")
    part = F.shiftright(slot, _ROW_BITS).alias("_part")
    numbered = stored(
        df.orderBy(*order).select(
            *(keep or df.columns), F.monotonically_increasing_id().alias("_slot")
        ),
        "sorted",
    )
    sizes = numbered.groupBy(part).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")
    )
    row = slot.bitwiseAND((1 << _ROW_BITS) - 1)
    return (
        numbered.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + row + 1)
        .drop("_part", "_before", "_slot")
    )
