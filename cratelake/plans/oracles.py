"""The same queries as DuckDB SQL over the benchmark tables."""

from __future__ import annotations

from cratelake.model import CRATE_FIELDS, LABEL_FIELDS, QUEUE_VIEW_FIELDS, TRACKING_FIELDS
from cratelake.plans.queries import WEEK_END, YEAR

_FIELDS = ", ".join(CRATE_FIELDS)
_GOLD_FIELDS = ", ".join(CRATE_FIELDS[:-1]) + ", arrival_date AS creation_date"
_TRACKING = ", ".join(TRACKING_FIELDS)
_ROUTED = (
    ", ".join(CRATE_FIELDS[:-1])
    + ", creation_date AS declared_creation_date, arrival_date AS creation_date"
)

CRATES = """
crates AS (
  SELECT
    CAST(o_orderkey AS VARCHAR) AS crate_id,
    'CUST' || CASE WHEN o_custkey < 1000 THEN lpad(CAST(o_custkey AS VARCHAR), 3, '0')
      ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
    c_name AS customer_name,
    CAST(o_custkey AS VARCHAR) || ' Depot Road' AS delivery_address,
    n_name AS city,
    r_name AS state,
    CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS delivery_date,
    '08:30:00' AS delivery_time,
    CAST(CAST(o_orderdate AS DATE) + 7 AS VARCHAR) AS return_date,
    '17:15' AS return_time,
    CASE o_orderkey % 3 WHEN 0 THEN 'Paper, Card' WHEN 1 THEN 'Copper wire'
      ELSE 'Glass jars' END AS contents,
    'ORD' || lpad(CAST(o_orderkey % 100 + 1 AS VARCHAR), 3, '0') AS batch_order_number,
    CASE o_orderkey % 2 WHEN 0 THEN 'Rail, Closed' ELSE 'Barge' END
      AS transportation_details,
    CASE o_orderstatus WHEN 'F' THEN 'Returned' WHEN 'O' THEN 'In Transit'
      WHEN 'P' THEN 'Delivered' END AS return_status,
    CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS qr_code_generation_date,
    CASE o_orderkey % 3 WHEN 0 THEN 'Leave upright' WHEN 1 THEN 'Two labels'
      ELSE 'Count on arrival' END AS additional_notes,
    CAST(CAST(o_orderkey % 1000 / 100.0 AS DECIMAL(6,2)) AS VARCHAR) || ' C' AS temperature,
    CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) || ' kg' AS weight,
    CAST(CAST(o_orderdate AS DATE) + 7 AS VARCHAR) AS expiration_date,
    CASE o_orderkey % 2 WHEN 0 THEN 'Keep dry' ELSE 'Leave upright' END
      AS handling_instructions,
    CASE o_orderstatus WHEN 'F' THEN 'Delivered' ELSE 'In Transit' END AS shipment_status,
    c_mktsegment AS company_name,
    CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS creation_date,
    CAST(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH AS DATE) AS arrival_date,
    o_orderkey AS seq,
    o_orderdate AS sent_ts
  FROM orders
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
)"""

_ACKS = """
acks AS (
  SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS message_id FROM lineitem WHERE l_returnflag = 'R'
)"""

_OBJECTS = """
objects AS (
  SELECT event_id, ts, 'raw/csv_data_' || strftime(ts, '%Y%m%d%H%M%S') || '.csv' AS object_key
  FROM events
)"""

_CELLS = r"""
cells AS (
  SELECT event_id, CASE event_id % 4
      WHEN 0 THEN '$' || CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR)
      WHEN 1 THEN CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) || ' %'
      WHEN 2 THEN upper(event_type[1]) || event_type[2:] || ' '
        || CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR)
    END AS cell
  FROM events
),
keyed AS (
  SELECT event_id, cell, lower(coalesce(cell, '')) AS txt,
    TRY_CAST(regexp_replace(coalesce(cell, ''), '[$,%\s]', '', 'g') AS DOUBLE) AS num
  FROM cells
)"""

_BODY = "to_json({" + ", ".join(f"'{f}': {f}" for f in CRATE_FIELDS) + "})"


def _object_without_nulls(fields: list[str], source: dict[str, str]) -> str:
    parts = [
        f"CASE WHEN {source.get(f, f)} IS NULL THEN '' ELSE ',\"{f}\":' || "
        f"CAST(to_json({source.get(f, f)}) AS VARCHAR) END"
        for f in fields
    ]
    return "'{' || substr(" + " || ".join(parts) + ", 2) || '}'"


def _missing_field_is_null(field: str) -> str:
    return "CASE WHEN seq % 7 <> 0 THEN customer_name END" if field == "customer_name" else field


_FAULTY = f"""
faulty AS (
  SELECT * REPLACE (
    CASE WHEN seq % 11 <> 0 THEN customer_name END AS customer_name,
    CASE WHEN seq % 13 = 0 THEN '' ELSE contents END AS contents,
    CASE WHEN seq % 17 = 0 THEN '2001-02-30' ELSE delivery_date END AS delivery_date,
    CASE WHEN seq % 19 = 0 THEN '07/31/2001' ELSE return_date END AS return_date,
    CASE WHEN seq % 23 = 0 THEN '25:00' ELSE delivery_time END AS delivery_time,
    CASE WHEN seq % 29 = 0 THEN ' ' ELSE additional_notes END AS additional_notes
  ) FROM crates
),
judged AS (
  SELECT *, array_to_string(list_filter([
    CASE WHEN customer_name IS NULL THEN 'customer_name is missing' END,
    CASE WHEN try_strptime(delivery_date, '%Y-%m-%d') IS NULL THEN 'delivery_date is not a date' END,
    CASE WHEN NOT regexp_full_match(delivery_time, '([01][0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9])?')
      THEN 'delivery_time is not a time' END,
    CASE WHEN try_strptime(return_date, '%Y-%m-%d') IS NULL THEN 'return_date is not a date' END,
    CASE WHEN contents = '' THEN 'contents is missing' END
  ], lambda x: x IS NOT NULL), '; ') AS reason
  FROM faulty
)"""

_DEDUP = """
WITH RECURSIVE sent AS (
  SELECT event_id, ts, sha256(CAST(user_id AS VARCHAR) || '|' || event_type) AS dedup_key FROM events
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY dedup_key ORDER BY ts, event_id) AS rn FROM sent
),
fold AS (
  SELECT dedup_key, event_id, ts, rn, ts AS last_ts, true AS kept FROM ranked WHERE rn = 1
  UNION ALL
  SELECT r.dedup_key, r.event_id, r.ts, r.rn,
    CASE WHEN r.ts >= f.last_ts + INTERVAL 2 DAY THEN r.ts ELSE f.last_ts END,
    r.ts >= f.last_ts + INTERVAL 2 DAY
  FROM fold f JOIN ranked r ON r.dedup_key = f.dedup_key AND r.rn = f.rn + 1
)
SELECT dedup_key, ts, event_id FROM fold WHERE kept
"""

_BATCHES = """
WITH numbered AS (
  SELECT event_id, ts, row_number() OVER (ORDER BY ts, event_id) AS arrival_no FROM events
)
SELECT event_id, ts, arrival_no, (arrival_no - 1) // 11 AS batch_id FROM numbered
WHERE (arrival_no - 1) // 11 < (SELECT count(*) // 11 FROM numbered)
"""

_WEEK = f"""
days AS (
  SELECT CAST(unnest(generate_series(DATE '{WEEK_END}' - 6, DATE '{WEEK_END}', INTERVAL 1 DAY)) AS DATE) AS day
),
week AS (
  SELECT day, count(seq) AS n, count(seq) FILTER (return_status = 'Returned') AS flagged
  FROM days LEFT JOIN crates ON CAST(sent_ts AS DATE) = day GROUP BY day
)"""

_MONTHS = f"""
months AS (SELECT CAST(unnest(range(1, 13)) AS INTEGER) AS month),
year AS (
  SELECT m.month, count(seq) AS n FROM months m
  LEFT JOIN crates ON month(sent_ts) = m.month AND year(sent_ts) = {YEAR}
    AND shipment_status = 'Delivered'
  GROUP BY m.month
)"""


def _cells_sorted(direction: str) -> str:
    return (
        f"WITH {_CELLS} SELECT event_id, cell, row_number() OVER (ORDER BY num IS NULL {direction}, "
        f"num {direction}, CASE WHEN num IS NULL THEN txt END {direction}, event_id) AS pos FROM keyed"
    )


_ROUTED_ROWS = f"WITH {CRATES} SELECT {_ROUTED} FROM crates"
_GOLD_ROWS = f"WITH {CRATES} SELECT {_GOLD_FIELDS} FROM crates"
_DELIVERED = f"WITH {CRATES} SELECT {_TRACKING} FROM crates WHERE shipment_status = 'Delivered'"
_ALL_CRATES = f"WITH {CRATES} SELECT {_FIELDS} FROM crates"
_PENDING = f"""
WITH {_ACKS}
SELECT CAST(o_orderkey AS VARCHAR) AS message_id, o_orderdate AS sent_ts, o_orderkey AS seq
FROM orders WHERE CAST(o_orderkey AS VARCHAR) NOT IN (SELECT message_id FROM acks)
"""
_PEEK = f"""
WITH {CRATES}, {_ACKS}
SELECT crate_id AS message_id, sent_ts, seq, CAST({_BODY} AS VARCHAR) AS body FROM crates
WHERE crate_id NOT IN (SELECT message_id FROM acks) ORDER BY sent_ts, seq"""
_QUEUE_VIEW = ", ".join(
    "CASE WHEN seq % 5 <> 0 THEN return_time END AS return_time" if f == "return_time" else f
    for f in QUEUE_VIEW_FIELDS
)
# Bytes of a record as a CSV line: commas and the line break, and quotes around what holds a comma.
_LINE = " + ".join(
    f"coalesce(strlen({f}) + CASE WHEN contains({f}, ',') THEN 2 ELSE 0 END, 0)" for f in CRATE_FIELDS
) + f" + {len(CRATE_FIELDS)}"

ORACLES: dict[str, str] = {
    "src_messages": f"WITH {CRATES} SELECT crate_id AS message_id, sent_ts, seq, {_FIELDS} FROM crates",
    "sink_messages": (
        f"WITH {CRATES} SELECT crate_id AS message_id, sent_ts, seq, "
        f"CAST({_BODY} AS VARCHAR) AS body FROM crates"
    ),
    "sink_bronze_csv": _ALL_CRATES,
    "bronze_key": f"WITH {_OBJECTS} SELECT event_id, object_key FROM objects",
    "silver_route": f"""
        WITH {_OBJECTS}, arrived AS (
          SELECT object_key, CAST(ts AS DATE) AS creation_date FROM objects
          UNION ALL
          SELECT 'raw/copies/' || event_id || '.csv', CAST(ts AS DATE) + 1 FROM objects
        )
        SELECT object_key, creation_date, 'unprocessed/creation_date=' || creation_date || '/'
          || regexp_extract(object_key, '[^/]*$') AS destination_key FROM arrived""",
    "silver_route_stream": _ROUTED_ROWS,
    "list_files": f"""
        WITH {CRATES} SELECT 'creation_date=' || arrival_date AS directory, true AS is_csv,
          CAST(sum({_LINE}) AS BIGINT) AS row_bytes FROM crates GROUP BY arrival_date""",
    "scan_silver_csv": _ROUTED_ROWS,
    "raw_moved": f"""
        WITH {CRATES}
        SELECT arrival_date AS creation_date, count(*) AS n_routed, 0 AS left_in_raw FROM crates GROUP BY arrival_date""",
    "gold_compacted": _GOLD_ROWS,
    "queue_retired": f"""
        WITH {_ACKS}
        SELECT CAST(o_orderkey AS VARCHAR) AS message_id,
               CASE WHEN CAST(o_orderkey AS VARCHAR) IN (SELECT message_id FROM acks) THEN 'retired' ELSE 'pending' END AS state
        FROM orders""",
    "gold_write": _GOLD_ROWS,
    "gold_partitions": (
        f"WITH {CRATES} SELECT DISTINCT 'creation_date=' || arrival_date AS partition FROM crates"
    ),
    "gold_incremental": _GOLD_ROWS,
    "schema_report": f"""
        SELECT CAST(row_number() OVER () AS INTEGER) AS position, column_name,
          CASE column_type WHEN 'VARCHAR' THEN 'string' ELSE lower(column_type) END AS data_type
        FROM (DESCRIBE WITH {CRATES} SELECT {_GOLD_FIELDS} FROM crates)""",
    "notify_scanned": f"""
        WITH {CRATES}, {_ACKS} SELECT crate_id, 'Scan Completed' AS subject,
          'QR Code Scan Completed for Crate id: ' || crate_id AS message
        FROM crates WHERE crate_id IN (SELECT message_id FROM acks)""",
    "notify_arrival": f"""
        WITH {_OBJECTS} SELECT object_key, 'New file ''' || object_key || ''' uploaded to S3' AS body
        FROM objects""",
    "canonical_record": _ALL_CRATES,
    "label_payload_full": (
        f"WITH {CRATES} SELECT crate_id, CAST({_BODY} AS VARCHAR) AS payload FROM crates"
    ),
    "label_payload_scan": f"""
        WITH {CRATES} SELECT crate_id AS message_id, CAST(to_json({{{", ".join(
            f"'{f}': {_missing_field_is_null(f)}" for f in LABEL_FIELDS)}}}) AS VARCHAR) AS payload
        FROM crates""",
    "inprogress_view": f"""
        WITH {CRATES}, {_ACKS} SELECT crate_id AS message_id, {_QUEUE_VIEW}
        FROM crates WHERE crate_id NOT IN (SELECT message_id FROM acks) AND seq % 7 <> 0""",
    "inprogress_rejects": f"""
        WITH {CRATES}, {_ACKS} SELECT crate_id AS message_id, 'customer_name' AS missing
        FROM crates WHERE crate_id NOT IN (SELECT message_id FROM acks) AND seq % 7 = 0""",
    "track_delivered": _DELIVERED,
    "track_delivered_gold": _DELIVERED,
    "result_as_text": f"""
        WITH {CRATES} SELECT * REPLACE (
          regexp_extract(temperature, '[0-9.]+') AS temperature, regexp_extract(weight, '[0-9.]+') AS weight
        ) FROM (SELECT {_FIELDS} FROM crates)""",
    "validate_accept": f"WITH {CRATES}, {_FAULTY} SELECT {_FIELDS} FROM judged WHERE reason = ''",
    "validate_reject": f"WITH {CRATES}, {_FAULTY} SELECT crate_id, reason FROM judged WHERE reason <> ''",
    "pending": _PENDING,
    "route_rejects": """
        SELECT CASE event_id % 5 WHEN 1 THEN 'raw/' || event_id || '.csv' END AS object_key,
          CASE event_id % 5 WHEN 1 THEN 'no event time' ELSE 'no object' END AS reason, count(*) AS n
        FROM events WHERE event_id % 5 IN (1, 2, 3) GROUP BY 1, 2""",
    "scan_rejects": """
        WITH m AS (SELECT CAST(o_orderkey AS VARCHAR) AS message_id,
          o_orderkey % 11 = 0 OR o_orderkey % 7 = 0 AS bad FROM orders)
        SELECT message_id, 'rejected' AS state FROM m WHERE bad
        UNION ALL SELECT message_id, 'acknowledged' FROM m WHERE NOT bad
        UNION ALL SELECT message_id, 'landed' FROM m WHERE NOT bad""",
    "pending_after_scan": f"""
        WITH {_ACKS} SELECT CAST(o_orderkey AS VARCHAR) AS message_id,
          CASE WHEN CAST(o_orderkey AS VARCHAR) IN (SELECT message_id FROM acks) THEN 'landed'
            ELSE 'pending' END AS state FROM orders""",
    "queue_head": _PEEK + " LIMIT 1",
    "queue_peek10": _PEEK + " LIMIT 10",
    "inprogress_page": f"""
        WITH {CRATES}, {_ACKS}, page AS (
          SELECT * FROM crates WHERE crate_id NOT IN (SELECT message_id FROM acks)
          ORDER BY sent_ts, seq LIMIT 10
        )
        SELECT crate_id AS message_id, {_QUEUE_VIEW} FROM page WHERE seq % 7 <> 0""",
    "waiting_files": "SELECT count(*) AS waiting, count(*) > 10 AS batch_due FROM events",
    "kpi_cards": """
        SELECT count(DISTINCT o_orderkey) AS total_crates, count(*) AS total_requests,
          count(*) FILTER (o_orderstatus = 'F') AS total_flagged FROM orders""",
    "requests_7d": f"WITH {CRATES}, {_WEEK} SELECT day, n FROM week",
    "fulfilled_by_month": f"WITH {CRATES}, {_MONTHS} SELECT month, n FROM year",
    "series_max": f"""
        WITH {CRATES}, {_WEEK}, {_MONTHS}
        SELECT 'week' AS series, max(n) AS series_max FROM week
        UNION ALL SELECT 'year', max(n) FROM year""",
    "requested_vs_flagged": (
        f"WITH {CRATES}, {_WEEK} SELECT day, n AS requested, flagged FROM week"
    ),
    "category_share": f"""
        WITH {CRATES} SELECT company_name, count(*) AS n,
          count(*) / (SELECT count(*) FROM crates) AS share FROM crates GROUP BY company_name""",
    "table_search": f"""
        WITH {CRATES}, shown AS (SELECT {_TRACKING} FROM crates)
        SELECT * FROM shown WHERE {" AND ".join(
            "(" + " OR ".join(f"contains(lower(coalesce({f}, '')), '{w}')" for f in TRACKING_FIELDS)
            + ")" for w in ("asia", "glass"))}""",
    "table_sort_asc": _cells_sorted("ASC"),
    "table_sort_desc": _cells_sorted("DESC"),
    "table_page": f"""
        WITH {CRATES}, shown AS (SELECT {_TRACKING}, seq FROM crates)
        SELECT * FROM shown WHERE {" AND ".join(
            "(" + " OR ".join(f"contains(lower(CAST({f} AS VARCHAR)), '{w}')"
                              for f in [*TRACKING_FIELDS, "seq"])
            + ")" for w in ("asia", "glass"))}
        ORDER BY return_date DESC, seq LIMIT 10 OFFSET 20""",
    "table_page_far": f"""
        SELECT event_id, cell FROM ({_cells_sorted("ASC")}) WHERE pos BETWEEN 726 AND 750""",
    "table_page_count": "SELECT CAST(ceil(count(*) / 10) AS BIGINT) AS pages FROM orders",
    "date_scalars": """
        SELECT event_id,
          CASE WHEN event_id % 3 <> 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS default_text,
          strftime(ts, '%Y-%m-%d') AS date_text, strftime(ts, '%Y%m%d%H%M%S') AS compact_text,
          ts AS parsed_ts, CAST(NULL AS TIMESTAMP) AS unparsed_ts, CAST(ts AS DATE) AS event_date,
          CAST(ts AS DATE) + 7 AS week_later
        FROM events""",
    "key_scalars": r"""
        WITH uris AS (
          SELECT page_id, regexp_replace(url, '^https?://', 's3://')
            || CASE page_id % 3 WHEN 0 THEN '/a%20b+c%2Bd%C3%A9%zz100%' ELSE '' END
            || CASE page_id % 2 WHEN 0 THEN '.csv' ELSE '.parquet' END AS uri FROM pages
        ),
        split AS (
          SELECT *, regexp_extract(uri, '^s3://([^/]+)/', 1) AS bucket,
            regexp_extract(uri, '^s3://[^/]+/(.+)$', 1) AS object_key FROM uris
        )
        SELECT page_id, bucket, object_key, regexp_extract(uri, '[^/]*$') AS basename,
          'processed/' || CASE WHEN contains(object_key, '/')
            THEN substr(object_key, strpos(object_key, '/') + 1) ELSE '' END AS archive_key,
          url_decode(regexp_replace(uri, '%(zz|\.|$)', '%25\1', 'g')) AS decoded,
          'unprocessed/creation_date=2023-12-08/' || regexp_extract(uri, '[^/]*$') AS silver_key,
          suffix(uri, '.csv') AS is_csv
        FROM split""",
    "string_scalars": """
        WITH bodies AS (
          SELECT *, c_name || ' | ' || c_mktsegment || ' | '
            || repeat('é, ü and some more text ', 4) AS body FROM customer
        )
        SELECT c_custkey, CASE WHEN c_custkey < 1000 THEN lpad(CAST(c_custkey AS VARCHAR), 3, '0')
            ELSE CAST(c_custkey AS VARCHAR) END AS padded,
          to_base64(encode(body)) AS base64, sha256(body) AS hash,
          'QR Code Scan Completed for Crate id: '
            || CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE 'None' END AS message
        FROM bodies""",
    "unit_scalars": """
        SELECT CAST(o_orderkey AS VARCHAR) AS crate_id,
          CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) || ' kg' AS weight,
          CAST(o_totalprice AS DECIMAL(12,2)) AS kilograms,
          CAST(o_orderkey % 1000 / 100.0 AS DECIMAL(6,2)) AS celsius,
          CAST(NULL AS DECIMAL(6,2)) AS wrong_unit
        FROM orders""",
    "json_scalars": """
        SELECT event_id, props->>'k' AS k, props->>'absent' AS absent,
          json_exists(props, '$.absent') AS has_absent,
          CAST(to_json({'k': props->>'k', 'absent': props->>'absent'}) AS VARCHAR) AS encoded
        FROM events""",
    "dedup_fifo": _DEDUP,
    "dedup_fifo_stream": _DEDUP,
    "dedup_fifo_batches": _DEDUP,
    "dedup_fifo_chained": _DEDUP,
    "count_batches": _BATCHES,
    "count_batches_stream": _BATCHES,
}

# The same numbers by another way.
ORACLES |= {
    "pending_bucketed": ORACLES["pending"],
    "table_page_stored": ORACLES["table_page_far"],
    "kpi_cards_rollup": ORACLES["kpi_cards"],
    "requested_vs_flagged_rollup": ORACLES["requested_vs_flagged"],
    "fulfilled_by_month_rollup": ORACLES["fulfilled_by_month"],
    "category_share_rollup": ORACLES["category_share"],
}
