from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The date formats in use and their Spark patterns.
PATTERNS = {
    "%Y-%m-%d": "yyyy-MM-dd",
    "%Y-%m-%d %X": "yyyy-MM-dd HH:mm:ss",
    "%Y%m%d%H%M%S": "yyyyMMddHHmmss",
    "%Y-%m-%dT%H:%M:%S.%fZ": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'",
}


def timestamp_text(ts: Column, fmt: str = "%Y-%m-%d %X") -> Column:
    """Text of ``ts``; null stays null. ``fmt`` is one of PATTERNS or a Spark pattern."""
    return F.date_format(ts, PATTERNS.get(fmt, fmt))


def compact_timestamp(ts: Column) -> Column:
    return timestamp_text(ts, "%Y%m%d%H%M%S")


def event_timestamp(text: Column) -> Column:
    """Event time as a timestamp (session zone UTC); null when it does not parse."""
    return F.try_to_timestamp(text, F.lit(PATTERNS["%Y-%m-%dT%H:%M:%S.%fZ"]))


def event_date(text: Column) -> Column:
    return F.to_date(event_timestamp(text))


def days_later(date: Column, days: int = 7) -> Column:
    return F.date_add(date, days)
