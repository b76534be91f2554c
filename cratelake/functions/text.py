from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The texts of the two notifications.
SCAN_COMPLETED = "QR Code Scan Completed for Crate id: "
ARRIVED = "New file '%s' uploaded to S3"


def zero_padded(text: Column, width: int = 3) -> Column:
    """Zeros in front up to ``width``; longer text is kept whole."""
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def base64_text(text: Column) -> Column:
    """Base64 of the UTF-8 bytes, in one line however long."""
    return F.translate(F.base64(F.encode(text, "UTF-8")), "\r\n", "")


def content_hash(body: Column) -> Column:
    """Stable hash of a message body, the same in every process."""
    return F.sha2(body, 256)


def quantity_text(value: Column, unit: str, precision: int = 12) -> Column:
    """``3.456`` and ``C`` give ``3.46 C``."""
    return F.concat(value.cast(f"decimal({precision},2)").cast("string"), F.lit(f" {unit}"))


def quantity_value(text: Column, unit: str, precision: int = 12) -> Column:
    """The number in ``3.46 C``; null when the text is not a number with that unit."""
    number = F.regexp_extract(text, rf"^\s*([+-]?\d+(?:\.\d+)?)\s*{unit}\s*$", 1)
    return number.try_cast(f"decimal({precision},2)")


def scan_completed_text(crate_id: Column) -> Column:
    return F.concat(F.lit(SCAN_COMPLETED), F.coalesce(crate_id, F.lit("None")))


def arrival_text(key: Column) -> Column:
    return F.format_string(ARRIVED, key)
