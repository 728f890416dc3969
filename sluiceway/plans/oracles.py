"""SQL for the query catalogue, written from the fixture rules and not from the Spark code."""

from __future__ import annotations

_LINES = """
lines AS (
  SELECT CASE WHEN event_id % 97 = 0 THEN 'nonsense' || event_id ELSE
    event_id || chr(9) || strftime(ts, '%Y-%m-%d %H:%M:%S.%g') || chr(9) || event_type || chr(9)
    || '{"schema":"iglu:' || CASE WHEN event_id % 103 = 0 THEN 'com.unknown' ELSE 'com.acme' END || '/'
    || event_type || '/jsonschema/1-0-' || (event_id % 3) || '","data":'
    || CASE WHEN event_id % 101 = 0 THEN '{"k":"xyz"}' ELSE props END || '}' || chr(9)
    || '[{"schema":"iglu:com.acme/user_ctx/jsonschema/1-0-0","data":{"userId":' || user_id || '}}]' END AS value
  FROM events
),
parts AS (SELECT value, string_split(value, chr(9)) AS p FROM lines),
bad AS (SELECT value, len(p) AS n_fields FROM parts WHERE len(p) <> 5),
good AS (
  SELECT value, CAST(p[1] AS BIGINT) AS event_id, CAST(p[2] AS TIMESTAMP) AS tstamp, p[3] AS event_name,
    json_extract_string(p[4], '$.schema') AS uri, json_extract(p[4], '$.data.k') AS kj,
    json_extract_string(p[5], '$[0].schema') AS context_uri,
    CAST(json_extract_string(p[5], '$[0].data.userId') AS BIGINT) AS user_id
  FROM parts WHERE len(p) = 5
),
typed AS (
  SELECT *, regexp_extract(uri, '^iglu:([^/]+)/', 1) AS vendor, regexp_extract(uri, '^iglu:[^/]+/([^/]+)/', 1) AS name,
    CAST(regexp_extract(uri, '-([0-9]+)$', 1) AS INTEGER) AS addition,
    json_type(kj) IN ('UBIGINT', 'BIGINT') AS k_is_int,
    CASE WHEN json_type(kj) IN ('UBIGINT', 'BIGINT') THEN CAST(kj AS BIGINT) END AS k
  FROM good
),
occurrences AS (
  SELECT 'unstruct' AS entity, uri FROM good UNION ALL SELECT 'context', context_uri FROM good
),
versions AS (
  SELECT entity, uri, regexp_extract(uri, '^iglu:([^/]+)/', 1) AS vendor,
    regexp_extract(uri, '^iglu:[^/]+/([^/]+)/', 1) AS name,
    CAST(regexp_extract(uri, '-([0-9]+)$', 1) AS INTEGER) AS addition, count(*) AS occurrences
  FROM occurrences GROUP BY ALL
)
"""

# What fails when every schema loads in the main style.
_VERDICT = """,
verdict AS (
  SELECT *, vendor = 'com.unknown' AS not_found, vendor <> 'com.unknown' AND NOT k_is_int AS wrong_type FROM typed
),
errors AS (
  SELECT event_id, value, 'SchemaNotFound' AS error, uri AS schema_key, NULL AS found, NULL AS expected
  FROM verdict WHERE not_found
  UNION ALL
  SELECT event_id, value, 'WrongType', uri, CAST(kj AS VARCHAR), 'Integer' FROM verdict WHERE wrong_type
),
records AS (
  SELECT 'loader_parsing_error' AS kind, value AS payload,
    '{"kind":"loader_parsing_error","processor":{"artifact":"sluiceway","version":"0.1.0"},"errors":[{"error":'
    || '"FieldCountMismatch","value":"' || n_fields || '","expected":"5"}],"payload":' || to_json(value) || '}' AS record
  FROM bad
  UNION ALL
  SELECT 'loader_schema_error', value,
    '{"kind":"loader_schema_error","processor":{"artifact":"sluiceway","version":"0.1.0"},"errors":[{"error":"'
    || error || '","schema_key":"' || schema_key || '"'
    || CASE WHEN found IS NULL THEN '' ELSE ',"value":' || to_json(found) || ',"expected":"' || expected || '"' END
    || '}],"payload":' || to_json(value) || '}'
  FROM errors
)
"""

_NAMED = "regexp_replace(vendor, '[^a-z0-9]', '_', 'g') || '_' || name || '_1'"
_COLUMN = f"CASE entity WHEN 'unstruct' THEN 'unstruct_event_' ELSE 'contexts_' END || {_NAMED}"
_LOAD = "epoch_us(TIMESTAMP '2024-02-01 00:00:00')"


def _with(body: str, extra: str = "") -> str:
    return f"WITH {_LINES}{extra} {body}"


def _rows(first: str = _LOAD, second: str | None = None) -> str:
    load = first if second is None else (
        f"CASE WHEN event_name IN ('click', 'error', 'purchase') THEN {first} ELSE {second} END"
    )
    v2 = ", ".join(
        f"CASE WHEN name = '{e}' THEN k END AS {e}_k" for e in ("click", "purchase", "signup")
    )
    legacy = ", ".join(f"CASE WHEN name = 'view' AND addition = {i} THEN k END AS view_k_{i}" for i in range(3))
    return _with(f"""
SELECT event_id, epoch_us(tstamp) AS collector_micros, event_name, {load} AS load_micros, {v2}, {legacy},
  1 AS n_users, user_id
FROM typed WHERE vendor <> 'com.unknown' AND (name = 'error' OR k_is_int)""")


_ENVELOPED = """
WITH place AS (
  SELECT event_id, user_id, event_type, value, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
)
"""

_SHIP = "strftime(l_shipdate, '%Y-%m-%d')"

_SCHEMA_PATHS = """,
paths(path, type, nullable, column_name) AS (VALUES
  ('contexts_com_acme_user_ctx_1[]', 'struct', true, 'contexts_com_acme_user_ctx_1'),
  ('contexts_com_acme_user_ctx_1[].user_id', 'bigint', false, 'contexts_com_acme_user_ctx_1'),
  ('unstruct_event_com_acme_error_1', 'struct', true, 'unstruct_event_com_acme_error_1'),
  ('unstruct_event_com_acme_error_1.k', 'bigint', false, 'unstruct_event_com_acme_error_1'),
  ('unstruct_event_com_acme_error_1.note', 'string', true, 'unstruct_event_com_acme_error_1'),
  ('unstruct_event_com_acme_error_1.rank', 'bigint', true, 'unstruct_event_com_acme_error_1'),
  ('unstruct_event_com_acme_signup_1', 'struct', true, 'unstruct_event_com_acme_signup_1'),
  ('unstruct_event_com_acme_signup_1.k', 'bigint', false, 'unstruct_event_com_acme_signup_1'),
  ('unstruct_event_com_acme_signup_1.note', 'string', true, 'unstruct_event_com_acme_signup_1'),
  ('unstruct_event_com_acme_signup_1.rank', 'bigint', true, 'unstruct_event_com_acme_signup_1'),
  ('unstruct_event_com_acme_view_1', 'struct', true, 'unstruct_event_com_acme_view_1'),
  ('unstruct_event_com_acme_view_1.k', 'bigint', false, 'unstruct_event_com_acme_view_1'),
  ('unstruct_event_com_acme_view_1.note', 'string', true, 'unstruct_event_com_acme_view_1'),
  ('unstruct_event_com_acme_view_1.rank', 'bigint', true, 'unstruct_event_com_acme_view_1'),
  ('unstruct_event_com_acme_click_1', 'struct', true, 'unstruct_event_com_acme_click_1'),
  ('unstruct_event_com_acme_click_1.k', 'string', true, 'unstruct_event_com_acme_click_1'),
  ('unstruct_event_com_acme_click_1.note', 'string', true, 'unstruct_event_com_acme_click_1'),
  ('unstruct_event_com_acme_click_1.rank', 'bigint', true, 'unstruct_event_com_acme_click_1'),
  ('unstruct_event_com_acme_purchase_1', 'struct', true, 'unstruct_event_com_acme_purchase_1'),
  ('unstruct_event_com_acme_purchase_1.k', 'bigint', false, 'unstruct_event_com_acme_purchase_1'),
  ('unstruct_event_com_acme_purchase_1.note', 'string', true, 'unstruct_event_com_acme_purchase_1'),
  ('unstruct_event_com_acme_purchase_1.rank', 'bigint', true, 'unstruct_event_com_acme_purchase_1'))
"""

_FIELDS = """
fields(name, path, column_name, kind, nullable) AS (VALUES
  ('click', '', NULL, 'struct', false), ('click', 'k', 'k', 'int', false),
  ('error', '', NULL, 'struct', false), ('error', 'k', 'k', 'int', false),
  ('signup', '', NULL, 'struct', false), ('signup', 'k', 'k', 'int', false),
  ('view', '', NULL, 'struct', false), ('view', 'k', 'k', 'int', false),
  ('user_ctx', '', NULL, 'struct', false), ('user_ctx', 'userId', 'user_id', 'bigint', false),
  ('placeSeen', '', NULL, 'struct', false), ('placeSeen', 'amount', 'amount', 'decimal(9,2)', false),
  ('placeSeen', 'detail', 'detail', 'json', false), ('placeSeen', 'spot', 'spot', 'struct', true),
  ('placeSeen', 'spot.siteID', 'site_id', 'string', false), ('placeSeen', 'spot.tags', 'tags', 'array', true),
  ('placeSeen', 'spot.tags.[]', '[]', 'string', true)),
present AS (
  SELECT event_type AS name, count(*) AS n FROM events WHERE event_type <> 'purchase' GROUP BY 1
  UNION ALL SELECT 'user_ctx', 2 * count(*) FROM events WHERE event_type <> 'error'
  UNION ALL SELECT 'placeSeen', count(*) FROM events WHERE event_type <> 'error'
)
"""

_HOURS = """,
hours AS (
  SELECT date_trunc('hour', ts) + INTERVAL 1 HOUR AS load_tstamp, count(*) AS n,
    count(*) FILTER (WHERE event_id % 97 <> 0 AND event_id % 103 <> 0 AND event_id % 101 <> 0) AS n_good, epoch_us(max(ts)) // 1000 AS newest,
    epoch_ms(date_trunc('hour', ts) + INTERVAL 1 HOUR) - epoch_us(max(ts)) // 1000 AS lag,
    epoch_ms(date_trunc('hour', ts) + INTERVAL 1 HOUR) - epoch_us(min(ts) FILTER (WHERE event_id % 97 <> 0)) // 1000 AS waited
  FROM events GROUP BY date_trunc('hour', ts)
),
calendar AS (SELECT unnest(generate_series(min(load_tstamp), max(load_tstamp) + INTERVAL 24 HOUR, INTERVAL 1 HOUR)) AS load_tstamp FROM hours),
filled AS (
  SELECT load_tstamp, coalesce(n, 0) AS n, coalesce(n_good, 0) AS n_good,
    coalesce(lag, epoch_ms(load_tstamp + INTERVAL 1 HOUR) - max(newest) OVER (ORDER BY load_tstamp ROWS UNBOUNDED PRECEDING)) AS lag
  FROM calendar LEFT JOIN hours USING (load_tstamp)
)
"""

_FAULTY = """
WITH cases AS (SELECT event_id, user_id, event_id % 9 AS c FROM events),
errors(c, position, error, name, found, expected) AS (VALUES
  (1, 0, 'WrongType', 'order', 'null', 'Integer'), (2, 0, 'WrongType', 'order', 'null', 'String'),
  (3, 0, 'WrongType', 'order', NULL, 'Integer'), (3, 1, 'WrongType', 'order', '5', 'String'),
  (4, 0, 'WrongType', 'order', 'null', 'Json'), (5, 0, 'WrongType', 'note', 'null', 'String'), (5, 1, 'WrongType', 'note', 'null', 'String'),
  (6, 0, 'WrongType', 'order', NULL, 'Integer'), (7, 0, 'SchemaNotFound', 'ctx', NULL, NULL),
  (8, 0, 'InvalidSchema', 'broken', NULL, NULL), (8, 1, 'SchemaNotFound', 'ctx', NULL, NULL))
"""


def all_oracles() -> dict[str, str]:
    return {
        "parse_good_bad": _with("SELECT CASE WHEN len(p) = 5 THEN 'good' ELSE 'bad' END AS status, count(*) AS n_events FROM parts GROUP BY 1"),
        "parse_failures": _with("SELECT value AS payload, 'FieldCountMismatch' AS error, CAST(n_fields AS VARCHAR) AS found, '5' AS expected FROM bad"),
        "payload_bytes": _with("SELECT CASE WHEN len(p) = 5 THEN 'good' ELSE 'bad' END AS status, CAST(sum(strlen(value)) AS BIGINT) AS n_bytes FROM parts GROUP BY 1"),
        "payload_as_utf8": "SELECT doc_id, length(text) + 1 AS n_chars, chr(65533) AS last_char, strlen(text) + 1 AS n_bytes FROM documents",
        "unstruct_extract": _with("SELECT event_id, vendor, name, 'jsonschema' AS format, 1 AS model, 0 AS revision, addition, json_extract_string(kj, '$') AS k FROM typed"),
        "start_position": _with("SELECT event_name, count(*) AS n_events FROM good WHERE tstamp >= TIMESTAMP '2024-01-10 06:00:00' GROUP BY 1"),
        "contexts_concat": """
SELECT event_id, CAST(0 AS BIGINT) AS position, 'unstruct' AS entity, 'iglu:com.acme/' || event_type || '/jsonschema/1-0-0' AS uri
FROM events WHERE event_type <> 'purchase'
UNION ALL
SELECT event_id, CAST(i + 1 AS BIGINT), 'context',
  'iglu:com.acme/' || CASE i WHEN 1 THEN 'placeSeen' ELSE 'user_ctx' END || '/jsonschema/1-0-0'
FROM (SELECT event_id, event_type, unnest([0, 1, 2]) AS i FROM events WHERE event_type <> 'error')""",
        "entity_counts": _with("SELECT entity, vendor, name, 'jsonschema' AS format, 1 AS model, 0 AS revision, addition, occurrences FROM versions"),
        "column_names_v2": _with(f"SELECT {_COLUMN} AS column_name, CAST(sum(occurrences) AS BIGINT) AS occurrences FROM versions GROUP BY 1"),
        "column_names_legacy": _with(f"SELECT {_COLUMN} || '_0_' || addition AS column_name, occurrences FROM versions"),
        "skip_schemas": _with("SELECT uri, CASE WHEN vendor = 'com.acme' AND name = 'view' THEN 'legacy' ELSE 'v2' END AS style, occurrences FROM versions WHERE NOT (vendor = 'com.acme' AND name = 'error')"),
        "legacy_selection": _with("SELECT 'criteria' AS chosen_by, uri, occurrences FROM versions WHERE vendor = 'com.acme' AND name = 'view' UNION ALL SELECT 'mode', uri, occurrences FROM versions"),
        "resolve_schemas": _with("SELECT uri, vendor = 'com.acme' AS found, occurrences FROM versions"),
        "unresolved_schemas": _with("SELECT uri, occurrences FROM versions WHERE vendor <> 'com.acme'"),
        "any_unresolved": _with("SELECT bool_or(vendor <> 'com.acme') AS any_unresolved FROM versions"),
        "registry_fields": f"""
WITH {_FIELDS}
SELECT 'iglu:com.acme/' || name || '/jsonschema/1-0-0' AS uri, path, column_name AS name, kind, nullable, n AS occurrences
FROM fields JOIN present USING (name)""",
        "strict_cast_int": _with("SELECT event_id, CAST(k AS INTEGER) AS k, CASE WHEN NOT k_is_int THEN 'WrongType' END AS error, CASE WHEN NOT k_is_int THEN CAST(kj AS VARCHAR) END AS wrong_value, CASE WHEN NOT k_is_int THEN 'Integer' END AS expected FROM typed"),
        "cast_all_types": """
SELECT l_orderkey, l_linenumber, l_orderkey AS order_number, l_linenumber AS order_line, CAST(l_extendedprice AS DECIMAL(12, 2)) AS price,
  l_discount AS first_rate, l_tax AS second_rate, 2 AS n_rates, l_returnflag AS flag, l_returnflag = 'R' AS returned,
  CAST(date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS INTEGER) AS shipped_on,
  epoch_us(CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) + INTERVAL '7 hours 45 minutes 10 seconds') AS packed_at,
  CAST(NULL AS VARCHAR) AS remark
FROM lineitem""",
        "json_text_v2": """SELECT l_orderkey, l_linenumber, '"' || l_linestatus || '"' AS stage_json, '{}' AS extras_json FROM lineitem""",
        "json_text_legacy": f"""
SELECT l_orderkey, l_linenumber, {_SHIP} AS shipped_on,
  '{{"flag":"' || l_returnflag || '","stage":"' || l_linestatus || '"}}' AS label_json, '{{}}' AS extras_json,
  CAST(l_extendedprice AS DECIMAL(12, 2)) AS price
FROM lineitem""",
        "array_null_drop": """
SELECT event_id, CASE WHEN event_id % 7 = 0 OR event_id % 5 = 0 THEN 0 ELSE 2 END AS n_items,
  CAST(CASE WHEN event_id % 7 = 0 OR event_id % 5 = 0 THEN 0 ELSE 2 * event_id + 1 END AS BIGINT) AS total
FROM events""",
        "array_of_records": """
SELECT event_id, NOT (event_id % 5 = 0 OR event_id % 7 = 0 OR event_id % 11 = 0) AS ok,
  CASE WHEN event_id % 5 <> 0 AND event_id % 7 <> 0 AND event_id % 11 = 0 THEN 1 ELSE 2 END AS n_rows,
  event_id || CASE WHEN event_id % 5 = 0 THEN ',-' WHEN event_id % 7 <> 0 AND event_id % 11 = 0 THEN '' ELSE ',' || user_id END AS ns,
  CASE WHEN event_id % 5 = 0 THEN 'a,' || event_type WHEN event_id % 7 = 0 THEN 'a,' || event_type || ',b'
    WHEN event_id % 11 = 0 THEN 'a,' || event_type END AS tags,
  CASE WHEN event_id % 5 = 0 THEN 'WrongType/"x' || user_id || '"/Long' WHEN event_id % 7 = 0 THEN 'WrongType/' || event_id || '/String'
    WHEN event_id % 11 = 0 THEN 'WrongType/[' || event_id || ']/Struct' ELSE '' END AS errors
FROM events""",
        "transform_rows": _rows(),
        "transform_legacy_mode": _with(f"SELECT event_id, {_LOAD} AS load_micros, k, user_id FROM typed WHERE vendor <> 'com.unknown' AND k_is_int"),
        "transform_nested": _ENVELOPED + """
SELECT event_id, CAST(CAST(value AS DECIMAL(12, 2)) AS DOUBLE) AS value, event_type = 'purchase' AS is_sale,
  CASE WHEN event_type <> 'purchase' THEN k END AS k, CASE WHEN event_type <> 'error' THEN 2 END AS n_users,
  CASE WHEN event_type <> 'error' THEN user_id END AS second_user,
  CASE WHEN event_type <> 'error' THEN CAST(value AS DECIMAL(9, 2)) END AS amount,
  CASE WHEN event_type <> 'error' THEN '{"z":1,"a":"' || event_type || '"}' END AS detail_json,
  CASE WHEN event_type <> 'error' THEN 's' || user_id END AS site_id,
  CASE WHEN event_type <> 'error' THEN 'x,' || event_type END AS tags
FROM place""",
        "merged_versions": _with("""
SELECT event_id, CASE WHEN addition < 2 THEN CAST(k AS DOUBLE) END AS merged_k,
  CASE WHEN addition = 2 THEN CAST(kj AS VARCHAR) END AS recovered_k
FROM typed WHERE vendor <> 'com.unknown' AND (k_is_int OR addition = 2)"""),
        "missing_schema_lenient": _with("SELECT event_id, error, schema_key, found AS value, expected FROM errors", _VERDICT),
        "failed_records": _with("SELECT kind, record AS value FROM records", _VERDICT),
        "failed_records_capped": _with("""
SELECT CASE WHEN strlen(record) > 380 THEN 'size_violation' ELSE kind END AS kind,
  CASE WHEN strlen(record) > 380 THEN strlen(
    '{"kind":"size_violation","processor":{"artifact":"sluiceway","version":"0.1.0"},"failure":{"maximum_bytes":380,"actual_bytes":'
    || strlen(record) || ',"original_kind":"' || kind || '","key":"' || sha256(record) || '"},"payload":' || to_json(payload[1:38]) || '}'
  ) ELSE strlen(record) END AS record_bytes,
  CASE WHEN strlen(record) > 380 THEN strlen(record) END AS actual_bytes
FROM records""", _VERDICT),
        "row_conformance": _with("""
SELECT event_id, CASE name WHEN 'purchase' THEN 'UnknownField' ELSE 'WrongType' END AS error,
  CAST(NULL AS VARCHAR) AS schema_key, CAST(NULL AS VARCHAR) AS value,
  CASE name WHEN 'purchase' THEN 'unstruct_event_com_acme_purchase_1'
    ELSE 'unstruct_event_com_acme_click_1.k String' END AS expected
FROM verdict WHERE NOT not_found AND NOT wrong_type AND name IN ('purchase', 'click')""", _VERDICT),
        "schema_diff": _with(f"""
SELECT {_COLUMN} AS column_name, CAST(sum(occurrences) AS BIGINT) AS occurrences FROM versions
WHERE vendor = 'com.acme' AND name IN ('purchase', 'click') GROUP BY 1"""),
        "schema_merge": _with(f"""
SELECT path, type, nullable, n AS occurrences FROM paths JOIN (
  SELECT {_COLUMN} AS column_name, CAST(sum(occurrences) AS BIGINT) AS n FROM versions GROUP BY 1
) USING (column_name)""", _SCHEMA_PATHS),
        "append_evolved": _rows(_LOAD, "epoch_us(TIMESTAMP '2024-02-02 12:30:00')"),
        "daily_partitions": _with("""
SELECT CASE WHEN event_name IN ('click', 'error', 'purchase') THEN '2024-02-01' ELSE '2024-02-02' END AS load_day,
  event_name, count(*) AS n_rows
FROM typed WHERE vendor <> 'com.unknown' AND (name = 'error' OR k_is_int) GROUP BY 1, 2"""),
        "rerun_replaces": _with("""
SELECT CASE WHEN event_name IN ('click', 'error', 'purchase') THEN 'first-0' ELSE 'second-0' END AS batch_id,
  CASE WHEN event_name IN ('click', 'error', 'purchase') THEN '2024-02-01' ELSE '2024-02-02' END AS load_day, count(*) AS n
FROM typed WHERE vendor <> 'com.unknown' AND (name = 'error' OR k_is_int) GROUP BY 1, 2
UNION ALL
SELECT 'failed', 'failed', count(*) + (SELECT count(*) FROM bad) FROM typed WHERE NOT (vendor <> 'com.unknown' AND (name = 'error' OR k_is_int))"""),
        "pruned_read": _with("""
SELECT CASE event_name WHEN 'click' THEN '2024-02-01' ELSE '2024-02-02' END AS load_day, event_name, count(*) AS n_rows,
  CAST(sum(event_id) AS BIGINT) AS event_ids
FROM typed WHERE vendor <> 'com.unknown' AND k_is_int AND event_name IN ('click', 'signup') AND tstamp >= TIMESTAMP '2024-01-10 06:00:00' GROUP BY 1, 2"""),
        "loaded_metrics": _with("""
SELECT batch_id, count(*) AS n_events, count(*) FILTER (WHERE is_good) AS n_good, count(*) FILTER (WHERE NOT is_good) AS n_bad,
  CAST(sum(strlen(value)) AS BIGINT) AS n_bytes, epoch_us(min(tstamp)) AS earliest_micros
FROM (
  SELECT CASE WHEN event_name IN ('click', 'error', 'purchase') THEN 'first-0' ELSE 'second-0' END AS batch_id, value, tstamp,
    vendor <> 'com.unknown' AND (name = 'error' OR k_is_int) AS is_good FROM typed
  UNION ALL SELECT 'first-0', value, NULL, false FROM bad
) GROUP BY 1"""),
        "column_cap": _with("""
SELECT kind, count(*) AS n_failed FROM (
  SELECT 'loader_parsing_error' AS kind FROM bad
  UNION ALL SELECT 'loader_schema_error' FROM typed WHERE vendor = 'com.unknown' OR (name <> 'error' AND NOT k_is_int)
  UNION ALL SELECT 'loader_runtime_error' FROM typed WHERE vendor <> 'com.unknown' AND (name = 'error' OR k_is_int)
) GROUP BY 1"""),
        "summary_of_batch": _with("""
SELECT count(*) + (SELECT count(*) FROM bad) AS n_events, count(*) FILTER (WHERE NOT not_found AND NOT wrong_type) AS n_good,
  count(*) FILTER (WHERE not_found OR wrong_type) + (SELECT count(*) FROM bad) AS n_bad,
  CAST(sum(strlen(value)) + (SELECT sum(strlen(value)) FROM bad) AS BIGINT) AS n_bytes,
  epoch_us(min(tstamp)) AS earliest_micros,
  epoch_ms(TIMESTAMP '2024-02-01 00:00:00') - epoch_ms(min(tstamp)) AS e2e_millis
FROM verdict""", _VERDICT),
        "metrics_by_period": _with("""
SELECT epoch_us(date_trunc('day', load_tstamp)) AS period_start, CAST(sum(n_good) AS BIGINT) AS events_good,
  CAST(sum(n - n_good) AS BIGINT) AS events_bad, max(lag) AS latency_millis, max(waited) AS e2e_latency_millis
FROM hours GROUP BY date_trunc('day', load_tstamp)""", _HOURS),
        "unhealthy_periods": _with("""
SELECT epoch_us(load_tstamp) AS period_start, lag AS latency_millis, waited AS e2e_latency_millis FROM hours WHERE lag > 5 * 60 * 1000""", _HOURS),
        "stalled_source": _with("""
SELECT epoch_us(load_tstamp) AS period_start, n_good AS events_good, n - n_good AS events_bad, lag AS latency_millis
FROM filled WHERE lag > 5 * 60 * 1000""", _HOURS),
        "stream_equals_batch": _rows(),
        "error_details": f"""
{_FAULTY}
SELECT event_id, 'loader_schema_error' AS kind, CAST(position AS INTEGER) AS position, error,
  'iglu:com.' || CASE name WHEN 'ctx' THEN 'unknown' ELSE 'acme' END || '/' || name || '/jsonschema/1-0-0' AS schema_key,
  CASE WHEN error = 'WrongType' THEN coalesce(found, '"x' || user_id || '"') END AS found, expected
FROM cases JOIN errors USING (c)""",
        "moments_cast": f"""
{_FAULTY}
SELECT event_id, epoch_us(CASE WHEN event_id % 2 = 0 THEN TIMESTAMP '2024-03-17 18:37:00' ELSE TIMESTAMP '2024-03-17 20:37:00' END)
  + 1000000 * (event_id % 60) + CASE WHEN event_id % 2 = 0 THEN 1000 * (event_id % 1000) ELSE 0 END AS at_micros,
  '{{}}' AS extra_json, 'n' AS note_json
FROM cases WHERE c = 0""",
        "alerts_raised": _with(f"""
SELECT 'failed_to_add_columns' AS alert, 'too many total leaf fields: 11, allowed: 8' AS cause, {_COLUMN} AS column_name,
  CAST(sum(occurrences) AS BIGINT) AS occurrences
FROM versions WHERE vendor = 'com.acme' AND name IN ('click', 'purchase', 'user_ctx') GROUP BY ALL"""),
        "relaxed_columns": """
SELECT 'unstruct_event_com_acme_' || event_type || '_1' AS column_name, false AS nullable_first, true AS nullable_last,
  false AS first_has_last, true AS last_has_first, count(*) AS n_values, count(*) FILTER (WHERE event_id % 3 <> 0 AND event_id % 5 = 0) AS n_without
FROM events GROUP BY event_type""",
        "colliding_names": _ENVELOPED + """
SELECT event_id, CASE WHEN event_type = 'view' THEN 'v' || user_id END AS page_view_k, CASE WHEN event_type = 'click' THEN k END AS page_view_other_k,
  CASE WHEN event_type = 'purchase' THEN k END AS item_k, CASE WHEN event_type = 'signup' THEN 's' || user_id END AS item_other_k
FROM place""",
        "refreshed_registry": _with("""
, outcome AS (
  SELECT CASE WHEN event_id % 2 = 0 THEN 'before' ELSE 'after' END AS batch_id, event_name,
    vendor = 'com.acme' AND k_is_int AND (event_id % 2 = 1 OR name <> 'signup') AS fine FROM typed
  UNION ALL
  SELECT CASE WHEN CAST(value[9:] AS BIGINT) % 2 = 0 THEN 'before' ELSE 'after' END, NULL, false FROM bad
)
SELECT batch_id, event_name, count(*) AS n FROM outcome WHERE fine GROUP BY 1, 2
UNION ALL SELECT batch_id, 'failed', count(*) FROM outcome WHERE NOT fine GROUP BY 1"""),
        "outputs_by_batch": _with("""
SELECT 'good' AS batch_id, count(*) AS n_events, CAST(count(*) AS BIGINT) AS n_rows, true AS has_rows, false AS has_failed FROM typed WHERE vendor = 'com.acme' AND k_is_int
UNION ALL SELECT 'bad', count(*), 0, false, true FROM bad"""),
    }
