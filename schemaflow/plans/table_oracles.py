"""The registered queries as plain SQL over the same tables."""

from __future__ import annotations

M1 = """
m1 AS (
  SELECT CAST(event_id AS VARCHAR) AS order_id, CAST(user_id AS VARCHAR) AS customer_id,
         event_type AS customer_segment, CAST(round(value * 100) AS BIGINT) AS total_cents, ts AS event_time,
         coalesce(CAST(json_extract_string(props, '$.k') AS BIGINT), 0) AS discount_cents, event_id, user_id
  FROM events)
"""

M2 = """
m2 AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(c_custkey AS VARCHAR) AS customer_id,
         c_mktsegment AS customer_segment, CAST(round(o_totalprice * 100) AS BIGINT) AS total_cents,
         o_orderdate AS event_time, 0::BIGINT AS discount_cents
  FROM orders JOIN customer ON o_custkey = c_custkey)
"""


def _metrics(source: str, unit: str, where: str = "event_time IS NOT NULL", distinct: str = "count(DISTINCT order_id)"):
    return f"""
  SELECT customer_id, customer_segment, date_trunc('{unit}', event_time)::TIMESTAMP AS window_start,
         (date_trunc('{unit}', event_time) + INTERVAL 1 {unit})::TIMESTAMP AS window_end,
         strftime(date_trunc('{unit}', event_time), '%Y-%m-%d-%H') AS date_hour,
         count(*) AS order_count, CAST(sum(total_cents - discount_cents) AS BIGINT) AS net_cents_sum,
         avg(total_cents - discount_cents) AS net_cents_avg, max(total_cents - discount_cents) AS net_cents_max,
         {distinct} AS order_id_distinct
  FROM {source} WHERE {where} GROUP BY ALL"""


ROW = "order_id, customer_id, customer_segment, total_cents, event_time, discount_cents"
DECODED = (
    "order_id, customer_id, customer_segment, total_cents, "
    "date_trunc('millisecond', event_time)::TIMESTAMP AS event_time"
)
DAILY = f"daily AS ({_metrics('m1', 'day')})"
HOURLY = f"hourly AS ({_metrics('m1', 'hour')})"
STALE = (
    f"stale AS ({_metrics('undiscounted', 'day')})",
    "undiscounted AS (SELECT * REPLACE (0::BIGINT AS discount_cents) FROM m1)",
)
CORRECTED = f"""
WITH {M1}, {DAILY}, {STALE[1]}, {STALE[0]}
SELECT * FROM daily WHERE customer_segment <> 'error' UNION ALL SELECT * FROM stale WHERE customer_segment = 'error'
"""
BAD = """
  SELECT 'orders' AS topic, CAST(user_id % 4 AS INTEGER) AS "partition", event_id AS "offset", event_time AS timestamp,
         ['00010203', '', 'FFFFFFFFFFFFFFFFFFFFFF', '0861', NULL, '02610262'][event_id // 10 % 6 + 1] AS payload,
         'decode failed' AS reason
  FROM m1 WHERE event_id % 10 = 0"""

# Bytes of a zig-zag varint of a number that is not negative.
_VARINT = "(1 + " + " + ".join(f"CAST(2 * ({{0}}) >= {1 << 7 * k} AS INTEGER)" for k in range(1, 9)) + ")"


def _varint(number: str) -> str:
    return _VARINT.format(number)


PAYLOAD_BYTES = " + ".join(
    [f"{_varint(f'length({c})')} + length({c})" for c in ("order_id", "customer_id", "customer_segment")]
    + [_varint("total_cents"), _varint("epoch_ms(event_time)"), _varint("discount_cents")]
)


def _varint_hex(number: str) -> str:
    """Bytes of the same varint in hex."""
    parts = [
        f"CASE WHEN {k} = 0 OR 2 * ({number}) >= {1 << 7 * k} THEN printf('%02X', ((2 * ({number})) >> {7 * k}) & 127"
        f" | CASE WHEN 2 * ({number}) >= {1 << 7 * (k + 1)} THEN 128 ELSE 0 END) ELSE '' END"
        for k in range(8)
    ]
    return "(" + " || ".join(parts) + ")"


PAYLOAD_HEX = " || ".join(
    [f"{_varint_hex(f'length({c})')} || hex({c})" for c in ("order_id", "customer_id", "customer_segment")]
    + [_varint_hex("total_cents"), _varint_hex("epoch_us(event_time) // 1000"), _varint_hex("discount_cents")]
)
COUNTERS = f"""
  SELECT count(*) AS records_in, count(*) FILTER (event_id % 10 <> 0) AS records_valid,
         count(*) FILTER (event_id % 10 = 0) AS records_bad,
         CAST(sum(CASE WHEN event_id % 10 = 0 THEN [4, 0, 11, 2, 0, 4][event_id // 10 % 6 + 1] ELSE {PAYLOAD_BYTES} END) AS BIGINT) AS bytes_in
  FROM m1"""

# ---- schema registries -------------------------------------------------------------------------------------------

# A registry derived from rows (subject, version, e, k): one row per field, and one per record.
FIELDS = """
drawn AS (
  SELECT subject, version, j, (e * 31 + k * 17 + j * 101) % 97 AS h
  FROM v, range(6) AS places(j)),
placed AS (SELECT *, CAST((j + CASE WHEN h % 11 = 3 THEN 1 ELSE 0 END) % 7 AS INTEGER) AS place FROM drawn),
flds AS (
  SELECT subject, version, CAST(row_number() OVER (PARTITION BY subject, version ORDER BY j) - 1 AS INTEGER) AS pos,
         CASE WHEN h % 13 = 2 THEN 'g' ELSE 'f' END || j AS name,
         CASE WHEN h % 13 = 2 AND h % 2 = 0 THEN 'f' || j END AS alias,
         ['INT', 'LONG', 'FLOAT', 'DOUBLE', 'STRING', 'BYTES', 'BOOLEAN'][place + 1] AS tag,
         CASE WHEN place = 1 AND h % 2 = 1 THEN '{"type":"long","logicalType":"timestamp-millis"}'
              ELSE ['int', 'long', 'float', 'double', 'string', 'bytes', 'boolean'][place + 1] END AS base,
         h % 7 = 1 AS is_nullable, h % 3 = 0 AS has_default
  FROM placed WHERE h % 5 <> 0),
recs AS (
  SELECT subject, version, 'fixtures.events.' || CASE WHEN k % 10 = 0 THEN 'Purchase' ELSE 'Order' END AS full_name,
         CASE WHEN k % 20 = 0 THEN 'fixtures.events.Order' END AS alias
  FROM v)
"""
EVENT_VERSIONS = """
v AS (
  SELECT CAST(user_id AS VARCHAR) AS subject, CAST(event_id + 1 AS INTEGER) AS version, event_id AS e,
         coalesce(CAST(json_extract_string(props, '$.k') AS BIGINT), 0) AS k
  FROM events)
"""
FOLLOWING = """
pairs AS (
  SELECT * FROM (
    SELECT subject, version AS old_version, lead(version) OVER (PARTITION BY subject ORDER BY version) AS new_version
    FROM v)
  WHERE new_version IS NOT NULL)
"""
FIELD_COLUMNS = """
  SELECT subject, version, pos, name, coalesce(alias, '') AS aliases,
         CASE WHEN NOT is_nullable THEN base WHEN base LIKE '{%' THEN '["null",' || base || ']'
              ELSE '["null","' || base || '"]' END AS type_json, tag, is_nullable, has_default
  FROM flds"""

# The text of every version, and its canonical form, from the fields.
TEXTS = """
typed AS (
  SELECT *, CASE WHEN base LIKE '{%' THEN base ELSE '"' || base || '"' END AS plain,
         CASE tag WHEN 'STRING' THEN '""' WHEN 'BYTES' THEN '""' WHEN 'BOOLEAN' THEN 'false' WHEN 'FLOAT' THEN '0.0'
              WHEN 'DOUBLE' THEN '0.0' ELSE '0' END AS filler
  FROM flds),
written AS (
  SELECT subject, version, string_agg('{"name":"' || name || '","type":'
           || CASE WHEN is_nullable THEN '["null",' || plain || ']' ELSE plain END
           || CASE WHEN alias IS NULL THEN '' ELSE ',"aliases":["' || alias || '"]' END
           || CASE WHEN NOT has_default THEN '}' WHEN is_nullable THEN ',"default":null}'
                   ELSE ',"default":' || filler || '}' END, ',' ORDER BY pos) AS listed,
         string_agg('{"name":"' || name || '","type":' || CASE WHEN is_nullable THEN '["null","' || lower(tag) || '"]'
           ELSE '"' || lower(tag) || '"' END || '}', ',' ORDER BY pos) AS bare
  FROM typed GROUP BY ALL),
texts AS (
  SELECT r.subject, r.version, '{"type":"record","name":"' || replace(full_name, 'fixtures.events.', '')
           || '","namespace":"fixtures.events"' || CASE WHEN alias IS NULL THEN '' ELSE ',"aliases":["Order"]' END
           || ',"fields":[' || coalesce(listed, '') || ']}' AS schema,
         '{"name":"' || full_name || '","type":"record","fields":[' || coalesce(bare, '') || ']}' AS canonical
  FROM recs r LEFT JOIN written w ON w.subject = r.subject AND w.version = r.version)
"""

_MESSAGE = """
  CASE kind
    WHEN 'MissingDefault' THEN 'field ''' || field_name
      || ''' added without a default; old records would have nothing to fill it with'
    WHEN 'RenamedWithoutAlias' THEN 'field ''' || old_value || ''' appears to have been renamed to ''' || new_value
      || ''' but new schema has no aliases entry'
    WHEN 'TypeIncompatible' THEN 'field ''' || field_name || ''' type changed from ''' || old_value || ''' to '''
      || new_value || ''' which is not a safe promotion'
    WHEN 'RemovedRequiredField' THEN 'field ''' || field_name
      || ''' was required in old schema and was removed without a default'
    WHEN 'NonNullableMadeNullable' THEN 'field ''' || field_name
      || ''' was non-nullable; making it nullable requires a default'
    ELSE 'record full name changed from ''' || old_value || ''' to ''' || new_value
      || '''; this is a different schema, not an evolution' END"""


def _rules(level: str) -> str:
    """CTEs from ``pairs``, ``flds`` and ``recs`` to ``found``: the violations at one level, numbered within a pair."""
    ways = {"backward": [(0, "old", "new")], "forward": [(1, "new", "old")]}
    ways["full"] = ways["backward"] + ways["forward"]
    directed = " UNION ALL ".join(
        f"SELECT *, {turn} AS turn, {w}_version AS w, {r}_version AS r FROM pairs" for turn, w, r in ways[level]
    )
    removed = "true" if level in ("backward", "full") else "false"
    return f"""
directed AS ({directed}),
renamed_records AS (
  SELECT d.subject, old_version, new_version, turn * 10 AS o1, 0 AS o2, 0 AS o3, 'RecordNameMismatch' AS kind,
         '<root>' AS field_name, a.full_name AS old_value, b.full_name AS new_value
  FROM directed d JOIN recs a ON a.subject = d.subject AND a.version = w
  JOIN recs b ON b.subject = d.subject AND b.version = r
  WHERE a.full_name <> b.full_name AND b.alias IS DISTINCT FROM a.full_name),
matched AS (
  SELECT d.*, rf.pos, rf.name, rf.tag, rf.is_nullable, rf.has_default, coalesce(n.tag, l.tag) AS w_tag,
         coalesce(n.is_nullable, l.is_nullable) AS w_nullable
  FROM directed d JOIN flds rf ON rf.subject = d.subject AND rf.version = r
  LEFT JOIN flds n ON n.subject = d.subject AND n.version = w AND n.name = rf.name
  LEFT JOIN flds l ON l.subject = d.subject AND l.version = w AND l.name = rf.alias),
missing AS (
  SELECT subject, old_version, new_version, turn * 10 + 1, pos, 0, 'MissingDefault', name, NULL, NULL
  FROM matched WHERE w_tag IS NULL AND NOT has_default AND NOT is_nullable),
retyped AS (
  SELECT subject, old_version, new_version, turn * 10 + 1, pos, 0, 'TypeIncompatible', name, w_tag, tag
  FROM matched WHERE w_tag <> tag AND (w_tag || '>' || tag) NOT IN ('INT>LONG', 'INT>FLOAT', 'INT>DOUBLE',
    'LONG>FLOAT', 'LONG>DOUBLE', 'FLOAT>DOUBLE', 'STRING>BYTES', 'BYTES>STRING')),
opened AS (
  SELECT subject, old_version, new_version, turn * 10 + 1, pos, 1, 'NonNullableMadeNullable', name, NULL, NULL
  FROM matched WHERE NOT w_nullable AND is_nullable AND NOT has_default),
reader_only AS (
  SELECT d.subject, old_version, new_version, turn, f.pos, f.name, f.tag
  FROM directed d JOIN flds f ON f.subject = d.subject AND f.version = r
  WHERE NOT EXISTS (FROM flds x WHERE x.subject = d.subject AND x.version = w AND x.name = f.name)
    AND NOT EXISTS (FROM flds x WHERE x.subject = d.subject AND x.version = w AND x.name = f.alias)),
writer_only AS (
  SELECT d.subject, old_version, new_version, turn, f.pos, f.name, f.tag, f.has_default
  FROM directed d JOIN flds f ON f.subject = d.subject AND f.version = w
  WHERE NOT EXISTS (FROM flds x WHERE x.subject = d.subject AND x.version = r AND x.name = f.name)
    AND NOT EXISTS (FROM flds x WHERE x.subject = d.subject AND x.version = r AND x.alias = f.name)),
heirs AS (
  SELECT subject, old_version, new_version, turn, tag, arg_min(name, pos) AS heir FROM reader_only GROUP BY ALL),
renames AS (
  SELECT subject, old_version, new_version, turn * 10 + 2, pos, 0, 'RenamedWithoutAlias', name, name, heir
  FROM writer_only JOIN heirs USING (subject, old_version, new_version, turn, tag)),
removed AS (
  SELECT subject, old_version, new_version, 100, pos, 0, 'RemovedRequiredField', name, NULL, NULL
  FROM writer_only o WHERE {removed} AND turn = 0 AND NOT has_default AND NOT EXISTS (
    FROM flds f WHERE f.subject = o.subject AND f.version = o.new_version AND f.tag = o.tag AND NOT EXISTS (
      FROM flds x WHERE x.subject = o.subject AND x.version = o.old_version AND x.name = f.name))),
gathered AS (
  FROM renamed_records UNION ALL FROM missing UNION ALL FROM retyped UNION ALL FROM opened UNION ALL FROM renames
  UNION ALL FROM removed),
firsts AS (
  SELECT subject, old_version, new_version, kind, field_name, old_value, new_value,
         min(o1 * 10000000 + o2 * 10 + o3) AS place
  FROM gathered GROUP BY ALL),
found AS (
  SELECT subject, old_version, new_version, '{level}' AS level,
         CAST(row_number() OVER (PARTITION BY subject, old_version, new_version ORDER BY place) AS INTEGER) AS ord,
         kind, field_name, old_value, new_value, {_MESSAGE} AS message
  FROM firsts)
"""


def _compat(level: str) -> str:
    return f"WITH {EVENT_VERSIONS}, {FIELDS}, {FOLLOWING}, {_rules(level)} SELECT * FROM found"


REPORTED = """
reported AS (
  SELECT p.subject, p.old_version, p.new_version, count(kind) = 0 AS compatible,
         coalesce(string_agg('- **' || kind || '** (' || field_name || '): ' || message, chr(10) ORDER BY ord),
                  'compatible') AS report, CAST(count(kind) > 0 AS INTEGER) AS status
  FROM pairs p LEFT JOIN found f USING (subject, old_version, new_version) GROUP BY ALL)
"""

GATED = f"""
WITH registered AS (
  SELECT CAST(user_id AS VARCHAR) AS subject, CAST(event_id + 1 AS INTEGER) AS version, event_id AS e,
         coalesce(CAST(json_extract_string(props, '$.k') AS BIGINT), 0) AS k
  FROM events),
v AS (
  FROM registered UNION ALL
  SELECT CAST(c_custkey AS VARCHAR), 2147483647, c_custkey, c_nationkey * 4 FROM customer),
{FIELDS},
known AS (SELECT subject, max(version) AS version, count(*) AS n FROM registered GROUP BY subject),
pairs AS (
  SELECT subject, version AS old_version, 2147483647 AS new_version
  FROM known WHERE subject IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer)),
{_rules('backward')}, {REPORTED}, {TEXTS},
kinds AS (SELECT subject, string_agg(kind, ',' ORDER BY ord) AS kinds FROM found GROUP BY subject)
SELECT CAST(c_custkey AS VARCHAR) AS subject, coalesce(compatible, true) AS accepted,
       CASE WHEN coalesce(compatible, true) THEN CAST(coalesce(n, 0) + 1 AS INTEGER) END AS version,
       coalesce(report, 'compatible') AS report, texts.schema, coalesce(kinds, '') AS kinds
FROM customer c LEFT JOIN known ON known.subject = CAST(c_custkey AS VARCHAR)
LEFT JOIN reported ON reported.subject = CAST(c_custkey AS VARCHAR)
LEFT JOIN kinds ON kinds.subject = CAST(c_custkey AS VARCHAR)
JOIN texts ON texts.subject = CAST(c_custkey AS VARCHAR) AND texts.version = 2147483647
"""

# Candidates are versions from 2000000000 on; every pair that could meet is checked, and the chain picks its way through.
SEQUENCE = f"""
WITH RECURSIVE registered AS (
  SELECT CAST(user_id AS VARCHAR) AS subject, CAST(event_id + 1 AS INTEGER) AS version, event_id AS e,
         coalesce(CAST(json_extract_string(props, '$.k') AS BIGINT), 0) AS k
  FROM events),
offered AS (
  SELECT CAST(c_custkey AS VARCHAR) AS subject, CAST(ord AS INTEGER) AS ord, CAST(2000000000 + ord AS INTEGER) AS version,
         c_custkey + CASE WHEN ord = 2 THEN 1 ELSE 0 END AS e, c_nationkey * 4 AS k
  FROM customer, range(4) AS places(ord)),
v AS (FROM registered UNION ALL SELECT subject, version, e, k FROM offered),
{FIELDS},
known AS (SELECT subject, max(version) AS version, count(*) AS n FROM registered GROUP BY subject),
pairs AS (
  SELECT o.subject, known.version AS old_version, o.version AS new_version FROM offered o JOIN known ON known.subject = o.subject
  UNION ALL
  SELECT a.subject, a.version, b.version FROM offered a JOIN offered b ON a.subject = b.subject AND a.ord < b.ord),
{_rules('backward')}, {REPORTED}, {TEXTS},
steps AS (
  SELECT o.subject, -1 AS j, known.version AS last, coalesce(known.n, 0) AS n, false AS accepted, CAST(NULL AS VARCHAR) AS report
  FROM offered o LEFT JOIN known ON known.subject = o.subject WHERE o.ord = 0
  UNION ALL
  SELECT s.subject, s.j + 1, CASE WHEN coalesce(r.compatible, true) THEN 2000000001 + s.j ELSE s.last END,
         s.n + CASE WHEN coalesce(r.compatible, true) THEN 1 ELSE 0 END, coalesce(r.compatible, true),
         coalesce(r.report, 'compatible')
  FROM steps s LEFT JOIN reported r ON r.subject = s.subject AND r.old_version = s.last AND r.new_version = 2000000001 + s.j
  WHERE s.j < 3)
SELECT s.subject, s.j AS ord, schema, accepted, CASE WHEN accepted THEN CAST(n AS INTEGER) END AS version, report
FROM steps s JOIN texts ON texts.subject = s.subject AND texts.version = 2000000000 + s.j
WHERE s.j >= 0
"""


def _refused() -> str:
    from schemaflow.plans.table_queries import CANDIDATES

    problems = [f"'{p}'" if p else "NULL" for p in CANDIDATES.values()]
    rows = ", ".join(f"({i}, '{text}', {p})" for i, (text, p) in enumerate(zip(CANDIDATES, problems)))
    return f"""
WITH candidates(i, schema, problem) AS (VALUES {rows})
SELECT 'new ' || c_custkey AS subject, schema, problem IS NULL AS accepted,
       CASE WHEN problem IS NULL THEN 1 END AS version,
       coalesce('- **InvalidSchema** (<root>): ' || problem, 'compatible') AS report
FROM customer JOIN candidates ON i = c_custkey % {len(CANDIDATES)}"""


def _draw(seed: int, size: int) -> str:
    mixed = f"((event_id % 2147483648 * 48271 + {seed * 7919 + 12345}) % 2147483647 * 69621 + {seed}) % 2147483647"
    return f"(({mixed}) >> 7) % {size}"


STREAMED = _metrics("m1", "day", "event_id % 10 <> 0", "count(*)")

ORACLES = {
    "window_agg_hour": f"WITH {M1} {_metrics('m1', 'hour')}",
    "window_agg_day": f"WITH {M1} {_metrics('m1', 'day')}",
    "window_agg_orders_day": f"WITH {M2} {_metrics('m2', 'day')}",
    "distinct_with_duplicates": f"""
WITH {M1}, twice AS (FROM m1 UNION ALL FROM m1 UNION ALL SELECT * REPLACE (NULL AS event_time) FROM m1)
{_metrics('twice', 'day')}""",
    "business_filter": f"""
WITH {M1} {_metrics('m1', 'day', 'total_cents > discount_cents AND customer_id IS NOT NULL')}""",
    "business_filter_default": f"WITH {M1} SELECT {ROW} FROM m1 WHERE total_cents > 0 AND customer_id IS NOT NULL",
    "segment_filter": f"WITH {M1}, {DAILY} SELECT * FROM daily WHERE customer_segment <> 'error'",
    "top1": f"WITH {M1}, {HOURLY} SELECT * FROM hourly ORDER BY window_start, customer_id, customer_segment LIMIT 1",
    "distinct_hours": f"WITH {M1}, {HOURLY} SELECT DISTINCT date_hour FROM hourly",
    "hour_pattern": f"WITH {M1}, {HOURLY} SELECT DISTINCT date_hour, true AS matches FROM hourly",
    "global_sum": "SELECT count(*) AS order_count FROM events WHERE ts IS NOT NULL",
    "envelope_offset_range": """
SELECT 'orders' AS topic, CAST(user_id % 4 AS INTEGER) AS "partition", event_id AS "offset", ts AS timestamp,
       true AS no_key
FROM events
WHERE CASE user_id % 4 WHEN 2 THEN event_id >= 100 WHEN 3 THEN event_id < 5000 ELSE true END""",
    "topic_snapshot": f"""
WITH {M1} SELECT {DECODED}, discount_cents FROM m1
WHERE CASE user_id % 4 WHEN 1 THEN false WHEN 2 THEN event_id >= 100 WHEN 3 THEN event_id < 5000 ELSE true END""",
    "stream_topic_resume": f"WITH {M1} SELECT {DECODED}, discount_cents FROM m1",
    "split_valid": f"WITH {M1} SELECT {DECODED}, discount_cents FROM m1 WHERE event_id % 10 <> 0",
    "split_bad": f"WITH {M1} {BAD}",
    "split_counts": """
SELECT count(*) FILTER (event_id % 10 <> 0) AS valid_count, count(*) FILTER (event_id % 10 = 0) AS bad_count
FROM events""",
    "split_metrics": f"WITH {M1} {COUNTERS}",
    "decode_v1_as_v2": f"WITH {M1} SELECT {DECODED}, 0::BIGINT AS discount_cents FROM m1",
    "decode_oldest_first": f"WITH {M1} SELECT {DECODED}, 0::BIGINT AS discount_cents FROM m1",
    "decode_newest_first": f"WITH {M1} SELECT {DECODED}, discount_cents FROM m1",
    "decode_enum_segment": f"WITH {M1} SELECT {DECODED}, discount_cents FROM m1 WHERE customer_segment <> 'error'",
    "decode_text_types": f"""
WITH {M1}, digits AS (SELECT *, CAST(event_id + 1 AS VARCHAR) AS whole, rtrim(CAST(event_id + 1 AS VARCHAR), '0') AS kept FROM m1)
SELECT order_id, CASE WHEN user_id % 2 = 0 THEN 'true' ELSE 'false' END AS customer_id,
       kept[1] || '.' || CASE WHEN length(kept) > 1 THEN kept[2:] ELSE '0' END || 'E' || (length(whole) + 8) AS customer_segment,
       total_cents, date_trunc('millisecond', event_time)::TIMESTAMP AS event_time, discount_cents
FROM digits""",
    "bad_only": f"""
WITH {M1}
SELECT 'orders' AS topic, CAST(user_id % 4 AS INTEGER) AS "partition", event_id AS "offset", event_time AS timestamp,
       {PAYLOAD_HEX} AS payload, 'malformed' AS reason
FROM m1""",
    "replay_bad": f"WITH {M1} SELECT {DECODED}, discount_cents FROM m1",
    "synthetic_orders": f"""
SELECT 'order-' || lpad(CAST(event_id AS VARCHAR), 10, '0') AS order_id,
       'customer-' || lpad(CAST({_draw(42, 1000)} AS VARCHAR), 5, '0') AS customer_id,
       ['retail', 'wholesale', 'premium'][event_id % 3 + 1] AS customer_segment,
       {_draw(43, 50000)} + 100 AS total_cents,
       CAST(make_timestamp((1767225600000 + event_id * 13) * 1000) AS TIMESTAMP) AS event_time,
       {_draw(44, 500)} AS discount_cents
FROM events""",
    "parquet_roundtrip": f"WITH {M1} {_metrics('m1', 'day')}",
    "parquet_append_twice": f"WITH {M1}, {DAILY} FROM daily UNION ALL FROM daily",
    "pruned_read": f"""
WITH {M1}, {DAILY} FROM daily
WHERE date_hour BETWEEN '2024-01-05-00' AND '2024-01-20-00' AND customer_segment IN ('click', 'purchase')""",
    "table_append": f"WITH {M1}, {DAILY} FROM daily UNION ALL FROM daily",
    "dual_write": f"""
WITH {M1}, {DAILY} SELECT *, 'files' AS place FROM daily UNION ALL SELECT *, 'table' AS place FROM daily""",
    "dead_letter_daily": """
SELECT CAST(ts AS DATE) AS dt, count(*) AS bad_count FROM events WHERE event_id % 10 = 0 GROUP BY ALL""",
    "dead_letter_conditional": f"WITH {M1} {BAD}",
    "bad_summary": """
SELECT count(*) AS bad_count, 'empty payload' AS sample_reason FROM events WHERE event_id % 10 = 0""",
    "dedup_latest": CORRECTED,
    "dynamic_overwrite": CORRECTED,
    "file_audit": f"""
WITH {M1}, {DAILY}
SELECT DISTINCT date_hour, customer_segment, 0::BIGINT AS file_difference, 0::BIGINT AS byte_difference, true AS mean_is_whole
FROM daily""",
    "batch_run_metrics": f"""
WITH {M1}, rows AS ({_metrics('m1', 'day', 'event_id % 10 <> 0')}), counters AS ({COUNTERS})
SELECT count(*) AS aggregate_rows, CAST(sum(order_count) AS BIGINT) AS aggregated_orders,
       (SELECT records_bad FROM counters) AS stored_bad, (SELECT records_in FROM counters) AS records_in,
       (SELECT records_valid FROM counters) AS records_valid, (SELECT records_bad FROM counters) AS records_bad,
       (SELECT bytes_in FROM counters) AS bytes_in
FROM rows""",
    "stream_window_agg": f"WITH {M1} {STREAMED}",
    "stream_window_agg_exact": f"""
WITH {M1}, twice AS (FROM m1 UNION ALL FROM m1) {_metrics('twice', 'day')}""",
    "stream_window_agg_sketch": f"""
WITH {M1}, {DAILY} SELECT * EXCLUDE (order_id_distinct), true AS close FROM daily""",
    "late_drop": f"""
WITH {M1}, mark AS (
  SELECT date_trunc('millisecond', max(event_time)) - INTERVAL 1 HOUR AS watermark FROM m1 WHERE event_id % 7 <> 0),
kept AS (
  SELECT m1.* FROM m1, mark
  WHERE event_id % 7 <> 0 OR date_trunc('day', event_time) + INTERVAL 1 DAY > watermark)
SELECT strftime(date_trunc('day', event_time), '%Y-%m-%d-%H') AS date_hour, customer_segment,
       count(*) AS order_count, CAST(sum(total_cents - discount_cents) AS BIGINT) AS net_cents_sum
FROM kept GROUP BY ALL""",
    "stream_job": f"WITH {M1} {STREAMED}",
    "stream_dead_letters": f"""
WITH {M1}, bad AS ({BAD})
SELECT *, (SELECT count(*) FROM bad) AS summed_count, 'empty payload' AS sample_reason FROM bad""",
    "registry_fields": f"WITH {EVENT_VERSIONS}, {FIELDS} {FIELD_COLUMNS}",
    "registry_scan": f"""
WITH v AS (
  SELECT 'nation ' || s_nationkey AS subject, CAST(s_suppkey + 1 AS INTEGER) AS version, s_suppkey AS e,
         CAST(s_nationkey AS BIGINT) AS k
  FROM supplier), {FIELDS} {FIELD_COLUMNS}""",
    "registry_latest": f"""
WITH {EVENT_VERSIONS}, {FIELDS}, {TEXTS}, ends AS (SELECT subject, max(version) AS version, count(*) AS versions FROM v GROUP BY subject)
SELECT subject, version, schema, versions FROM ends JOIN texts USING (subject, version)""",
    "registry_subjects": "SELECT DISTINCT CAST(user_id AS VARCHAR) AS subject FROM events",
    "compat_backward": _compat("backward"),
    "compat_forward": _compat("forward"),
    "compat_full": _compat("full"),
    "compat_none": f"""
WITH {EVENT_VERSIONS}, {FOLLOWING}
SELECT subject, old_version, new_version, true AS compatible, 'compatible' AS report, 0 AS status FROM pairs""",
    "compat_report": f"""
WITH {EVENT_VERSIONS}, {FIELDS}, {FOLLOWING}, {_rules('backward')}, {REPORTED} FROM reported""",
    "compat_levels": " UNION ALL ".join(
        f"SELECT '{level}' AS level, count(*) AS violations FROM ({_compat(level)})" for level in ("backward", "forward", "full")
    )
    + " UNION ALL SELECT 'none', 0",
    "pair_check": f"""
WITH {EVENT_VERSIONS}, {FIELDS},
pairs AS (SELECT subject, min(version) AS old_version, max(version) AS new_version FROM v GROUP BY subject),
{_rules('full')}, {REPORTED} FROM reported""",
    "register_gate": GATED,
    "register_sequence": SEQUENCE,
    "register_fingerprints": f"""
WITH {EVENT_VERSIONS}, {FIELDS}, {TEXTS}
SELECT subject, sha256(canonical) AS fingerprint, min(version) AS version, count(*) AS versions
FROM texts GROUP BY subject, canonical""",
    "table_exists": f"WITH {M1}, {DAILY} SELECT *, false AS before, true AS after FROM daily",
    "stream_ticking": f"WITH {M1} {STREAMED}",
    "stream_sketch_rollup": f"""
WITH {M1}
SELECT customer_segment, date_trunc('day', event_time)::TIMESTAMP AS window_start,
       (date_trunc('day', event_time) + INTERVAL 1 day)::TIMESTAMP AS window_end,
       strftime(date_trunc('day', event_time), '%Y-%m-%d-%H') AS date_hour, count(*) AS order_count,
       CAST(sum(total_cents - discount_cents) AS BIGINT) AS net_cents_sum, max(total_cents - discount_cents) AS net_cents_max,
       avg(total_cents - discount_cents) AS net_cents_avg, count(DISTINCT order_id) AS order_id_distinct,
       0.0::DOUBLE AS relative_error
FROM m1 GROUP BY ALL""",
    "stream_metrics": f"WITH {M1} {COUNTERS}",
    "stream_dead_letters_compacted": """
SELECT CAST(ts AS DATE) AS dt, count(*) AS bad_count, CAST(sum(event_id) AS BIGINT) AS offsets, 1::BIGINT AS files
FROM events WHERE event_id % 10 = 0 GROUP BY ALL""",
    "stream_dead_letters_daily": """
SELECT CAST(ts AS DATE) AS dt, count(*) AS bad_count FROM events
WHERE event_id % 10 = 0 AND CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-14' GROUP BY ALL""",
    "compat_references": """
WITH v AS (
  SELECT CAST(user_id AS VARCHAR) AS subject, CAST(event_id + 1 AS INTEGER) AS version,
         ['STRING', 'ENUM', 'FIXED', 'RECORD'][event_id % 4 + 1] AS tag, event_id % 3 = 0 AS is_nullable
  FROM events),
pairs AS (
  SELECT subject, lag(version) OVER w AS old_version, version AS new_version, lag(tag) OVER w AS old_tag, tag AS new_tag,
         lag(is_nullable) OVER w AS was_nullable, is_nullable
  FROM v WINDOW w AS (PARTITION BY subject ORDER BY version)),
found AS (
  SELECT *, 1 AS place, 'TypeIncompatible' AS kind, old_tag AS old_value, new_tag AS new_value,
         format('field ''c'' type changed from ''{}'' to ''{}'' which is not a safe promotion', old_tag, new_tag) AS message
  FROM pairs WHERE old_version IS NOT NULL AND old_tag <> new_tag
  UNION ALL
  SELECT *, 2, 'NonNullableMadeNullable', NULL, NULL,
         'field ''c'' was non-nullable; making it nullable requires a default'
  FROM pairs WHERE old_version IS NOT NULL AND NOT was_nullable AND is_nullable)
SELECT subject, old_version, new_version, 'backward' AS level,
       CAST(row_number() OVER (PARTITION BY subject, old_version ORDER BY place) AS INTEGER) AS ord, kind,
       'c' AS field_name, old_value, new_value, message
FROM found""",
    "register_invalid": _refused(),
}
