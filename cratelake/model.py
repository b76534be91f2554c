"""The crate record, the queue message and the object-created event."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names and their order, which files and messages depend on.
CRATE_FIELDS = [
    "crate_id", "customer_id", "customer_name", "delivery_address", "city", "state",
    "delivery_date", "delivery_time", "return_date", "return_time", "contents",
    "batch_order_number", "transportation_details", "return_status",
    "qr_code_generation_date", "additional_notes", "temperature", "weight",
    "expiration_date", "handling_instructions", "shipment_status", "company_name",
    "creation_date",
]
TRACKING_FIELDS = [
    "crate_id", "customer_name", "company_name", "city", "state", "return_date",
    "contents", "transportation_details", "shipment_status",
]
QUEUE_VIEW_FIELDS = [
    "crate_id", "customer_id", "customer_name", "delivery_address", "city", "state",
    "delivery_date", "delivery_time", "return_date", "return_time", "contents",
    "company_name",
]
LABEL_FIELDS = ["crate_id", "customer_id", "customer_name"]
DATE_FIELDS = [
    "delivery_date", "return_date", "qr_code_generation_date", "expiration_date",
    "creation_date",
]
TIME_FIELDS = ["delivery_time", "return_time"]
FORM_NAMES = {"delivery_city": "city"}

# The date a crate record states for itself, once the arrival date has taken its name.
DECLARED_DATE = "declared_creation_date"
ARRIVAL_DATE = "creation_date"

CRATE_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in CRATE_FIELDS])

LANDED_FIELDS = CRATE_FIELDS[:-1] + [DECLARED_DATE]
LANDED_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in LANDED_FIELDS])

MESSAGE_SCHEMA = T.StructType([
    T.StructField("message_id", T.StringType()),
    T.StructField("sent_ts", T.TimestampType()),
    T.StructField("seq", T.LongType()),
    T.StructField("body", T.StringType()),
])

EVENT_SCHEMA = "Records ARRAY<STRUCT<eventTime: STRING, s3: STRUCT<object: STRUCT<key: STRING>>>>"
