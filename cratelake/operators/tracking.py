from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratelake.model import TRACKING_FIELDS


def track_delivered(crates: DataFrame, limit: int | None = None) -> DataFrame:
    """Delivered crates; the status must match to the letter. All rows unless limited."""
    found = crates.where(F.col("shipment_status") == "Delivered").select(*TRACKING_FIELDS)
    return found if limit is None else found.limit(limit)
