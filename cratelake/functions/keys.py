"""Object keys and URIs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# URI pattern, and where objects land, wait and end up.
_URI = r"^s3://(.+?)/(.+)$"
LANDING = "raw/csv_data_"
WAITING = "unprocessed/creation_date="
DONE = "processed/"


def basename(key: Column) -> Column:
    return F.substring_index(key, "/", -1)


def uri_bucket(uri: Column) -> Column:
    return F.nullif(F.regexp_extract(uri, _URI, 1), F.lit(""))


def uri_key(uri: Column) -> Column:
    return F.nullif(F.regexp_extract(uri, _URI, 2), F.lit(""))


def archive_key(key: Column) -> Column:
    """The same key with its first segment replaced by ``processed``."""
    return F.concat(F.lit(DONE), F.regexp_replace(key, "^[^/]*/?", ""))


def url_decoded(key: Column) -> Column:
    """Percent-decoding that leaves ``+`` and every stray ``%`` alone."""
    plain = F.regexp_replace(F.replace(key, F.lit("+"), F.lit("%2B")), "%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(plain), key)


def silver_key(date: Column, key: Column) -> Column:
    """Where an object that arrived on ``date`` waits for ingestion."""
    return F.concat(F.lit(WAITING), date.cast("string"), F.lit("/"), basename(key))


def bronze_key(ts: Column) -> Column:
    """Landing name of a scan made at ``ts``."""
    return F.concat(F.lit(LANDING), F.date_format(ts, "yyyyMMddHHmmss"), F.lit(".csv"))


def is_csv(key: Column) -> Column:
    return key.endswith(".csv")
