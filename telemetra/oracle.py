"""DuckDB SQL equivalents of the driver queries (see :mod:`telemetra.registry`).

The views ``events`` ... ``conversations`` are registered by the checker; the
``telemetry`` fixture is repeated as a CTE so every statement stands alone.
"""

from __future__ import annotations

TELEMETRY = """telemetry AS (
  SELECT event_id,
    CASE WHEN event_id % 97 = 0 THEN NULL ELSE concat('device_', CAST(user_id % 3 + 1 AS STRING)) END AS device_id,
    CASE WHEN event_id % 101 = 0 THEN NULL ELSE ts END AS event_ts,
    CASE WHEN event_id % 20 = 0 OR event_id % 33 = 0 THEN NULL ELSE value END AS temperature,
    CASE WHEN event_id % 21 = 0 OR event_id % 33 = 0 THEN NULL ELSE value * 2 END AS pressure,
    CASE WHEN event_id % 22 = 0 OR event_id % 33 = 0 THEN NULL ELSE value + 1 END AS humidity
  FROM events)"""

NULLS = "(CAST(temperature IS NULL AS INT) + CAST(pressure IS NULL AS INT) + CAST(humidity IS NULL AS INT))"

CLEANED = f"""cleaned AS (
  SELECT * FROM telemetry
  WHERE device_id IS NOT NULL AND event_ts IS NOT NULL AND {NULLS} <= 2)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _imputed(source: str) -> str:
    return f"""SELECT event_id, device_id, event_ts,
  ROUND(COALESCE(temperature, AVG(temperature) OVER ()), 6) AS temperature,
  ROUND(COALESCE(pressure, AVG(pressure) OVER ()), 6) AS pressure,
  ROUND(COALESCE(humidity, AVG(humidity) OVER ()), 6) AS humidity
FROM {source}"""


MESSAGE_REASON = """CASE WHEN event_id % 211 = 0 THEN 'malformed_json'
       WHEN device_id IS NULL THEN 'missing_device'
       WHEN event_ts IS NULL THEN 'missing_timestamp'
       WHEN event_id % 307 = 0 THEN 'missing_data' END"""

ISO = "strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%f')"

TAGGED_DOC = """(
  '{"reading":' || CAST(value AS STRING) || ',"count":' || CAST(user_id AS STRING)
  || ',"kind":"' || event_type || '","alarm":' || CASE WHEN value > 100 THEN 'true' ELSE 'false' END
  || ',"note":null,"props":' || props || '}')::JSON"""


def _text(c: str) -> str:
    return f"CASE WHEN event_id % 50 = 0 THEN 'zz' WHEN event_id % 77 = 0 THEN '' ELSE CAST({c} AS STRING) END"


def statements() -> dict[str, str]:
    sql: dict[str, str] = {}
    sql["table_scan"] = "SELECT * FROM events"
    sql["scan_capped"] = "SELECT * FROM events ORDER BY event_id LIMIT 1000"
    sql["scan_page"] = "SELECT * FROM lineitem ORDER BY l_shipdate DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 10000"
    sql["item_unwrap"] = _with(TELEMETRY) + "SELECT event_id, device_id, event_ts, temperature, pressure, humidity FROM telemetry"
    sql["item_scan_capped"] = _with(TELEMETRY) + (
        "SELECT event_id, device_id, event_ts, temperature, pressure, humidity FROM telemetry ORDER BY event_id LIMIT 1000"
    )
    sql["records_frame"] = _with(TELEMETRY) + "SELECT event_id, device_id, event_ts, temperature, pressure, humidity FROM telemetry"
    sql["infer_schema"] = """SELECT k AS field,
  CASE WHEN bool_and(json_type(props, '$.' || k) IN ('BIGINT', 'UBIGINT')) THEN 'BIGINT'
       WHEN bool_and(json_type(props, '$.' || k) IN ('BIGINT', 'UBIGINT', 'DOUBLE')) THEN 'DOUBLE'
       ELSE 'STRING' END AS data_type,
  count(*) AS n_records
FROM events, unnest(json_keys(props)) AS t(k)
GROUP BY k"""
    sql["cast_readings"] = _with(TELEMETRY) + f"""SELECT event_id,
  TRY_CAST({_text('temperature')} AS DOUBLE) AS temperature,
  TRY_CAST({_text('pressure')} AS DOUBLE) AS pressure,
  TRY_CAST({_text('humidity')} AS DOUBLE) AS humidity
FROM telemetry"""
    sql["parse_body"] = _with(TELEMETRY) + f"""SELECT event_id, device_id, {ISO} AS timestamp,
  temperature, pressure, humidity
FROM telemetry
WHERE ({MESSAGE_REASON}) IS NULL"""
    sql["drop_null_attrs"] = _with(TELEMETRY) + """SELECT event_id, 'temperature' AS attribute, temperature AS value FROM telemetry WHERE temperature IS NOT NULL
UNION ALL SELECT event_id, 'pressure', pressure FROM telemetry WHERE pressure IS NOT NULL
UNION ALL SELECT event_id, 'humidity', humidity FROM telemetry WHERE humidity IS NOT NULL"""
    sql["flatten_attrs"] = _with(TELEMETRY) + "SELECT event_id, temperature, pressure, humidity, 1 AS n_extras FROM telemetry"
    sql["flatten_all"] = f"""SELECT event_id, value > 100 AS alarm, user_id AS count, event_type AS kind,
  json_extract_string({TAGGED_DOC}, '$.props') AS props, value AS reading
FROM events"""
    sql["tag_attrs"] = f"""WITH j AS (SELECT event_id, {TAGGED_DOC} AS doc FROM events)
SELECT event_id, k AS attribute,
  CASE json_type(doc, '$.' || k) WHEN 'BOOLEAN' THEN 'BOOL'
    WHEN 'DOUBLE' THEN 'N' WHEN 'UBIGINT' THEN 'N' WHEN 'BIGINT' THEN 'N' ELSE 'S' END AS tag,
  json_extract_string(doc, '$.' || k) AS value
FROM j, unnest(json_keys(doc)) AS t(k)
WHERE json_type(doc, '$.' || k) <> 'NULL'"""
    sql["row_null_count"] = _with(TELEMETRY) + f"SELECT event_id, {NULLS} AS null_count, 2 AS threshold FROM telemetry"
    sql["null_key_rows"] = _with(TELEMETRY) + "SELECT * FROM telemetry WHERE device_id IS NULL OR event_ts IS NULL"
    sql["sparse_rows_strict"] = _with(TELEMETRY) + (
        f"SELECT * FROM telemetry WHERE device_id IS NOT NULL AND event_ts IS NOT NULL AND {NULLS} > 2"
    )
    sql["sparse_rows_inclusive"] = _with(TELEMETRY) + (
        f"SELECT * FROM telemetry WHERE device_id IS NOT NULL AND event_ts IS NOT NULL AND {NULLS} >= 2"
    )
    sql["topic_route"] = "SELECT * FROM events WHERE event_type = 'click'"
    sql["event_pattern"] = """SELECT event_id, 'svc.' || event_type AS source, 'Update Stream Event' AS detail_type,
  'arn:table/t' || CAST(user_id % 4 AS STRING) AS event_source_arn
FROM events
WHERE event_type IN ('click', 'purchase') AND value > 100 AND user_id % 4 IN (1, 3)"""
    sql["reject_split"] = _with(TELEMETRY) + f"""SELECT event_id, reason FROM (
  SELECT event_id, {MESSAGE_REASON} AS reason FROM telemetry) r
WHERE reason IS NOT NULL"""
    sql["parse_split"] = _with(TELEMETRY) + f"""SELECT event_id, coalesce(reason, 'good') AS outcome,
  CASE WHEN reason IS NULL THEN device_id END AS device_id, CASE WHEN reason IS NULL THEN {ISO} END AS timestamp,
  CASE WHEN reason IS NULL THEN temperature END AS temperature, CASE WHEN reason IS NULL THEN pressure END AS pressure,
  CASE WHEN reason IS NULL THEN humidity END AS humidity
FROM (SELECT *, {MESSAGE_REASON} AS reason FROM telemetry) r"""
    sql["split_counts"] = _with(TELEMETRY) + f"""SELECT outcome, count(reason) AS n
FROM (VALUES ('good'), ('malformed_json'), ('missing_device'), ('missing_timestamp'), ('missing_data'), ('other')) AS o(outcome)
LEFT JOIN (SELECT coalesce({MESSAGE_REASON}, 'good') AS reason FROM telemetry) r ON reason = outcome
GROUP BY outcome"""
    sql["column_means"] = _with(TELEMETRY, CLEANED) + """SELECT ROUND(AVG(temperature), 6) AS temperature_mean,
  ROUND(AVG(pressure), 6) AS pressure_mean, ROUND(AVG(humidity), 6) AS humidity_mean
FROM cleaned"""
    sql["impute_mean"] = _with(TELEMETRY) + _imputed("telemetry")
    sql["preview"] = _with(TELEMETRY) + "SELECT * FROM telemetry ORDER BY event_id LIMIT 5"
    cols = [
        (0, "event_id", "bigint"),
        (1, "device_id", "string"),
        (2, "event_ts", "timestamp_ntz"),
        (3, "temperature", "double"),
        (4, "pressure", "double"),
        (5, "humidity", "double"),
    ]
    sql["schema_report"] = _with(TELEMETRY) + "\nUNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS column_name, '{t}' AS data_type, true AS nullable, "
        f"count(*) - count({c}) AS null_count FROM telemetry"
        for i, c, t in cols
    )
    sql["clean_telemetry_keyed"] = _with(TELEMETRY, CLEANED) + _imputed("cleaned")

    def clean_latest(source: str, *ctes: str) -> str:
        latest = f"""latest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY device_id, event_ts ORDER BY event_id DESC) AS rn
    FROM {source} WHERE device_id IS NOT NULL AND event_ts IS NOT NULL) d
  WHERE rn = 1)"""
        kept = f"cleaned_latest AS (SELECT * FROM latest WHERE {NULLS} <= 2)"
        return _with(TELEMETRY, *ctes, latest, kept) + _imputed("cleaned_latest")

    sql["clean_telemetry"] = clean_latest("telemetry")
    sql["clean_telemetry_dedup"] = clean_latest(
        "sent",
        """sent AS (
  SELECT * FROM telemetry UNION ALL
  SELECT event_id + 1000000000, device_id, event_ts, CASE WHEN event_id % 9 <> 0 THEN temperature + 1000 END,
    CASE WHEN event_id % 9 <> 0 THEN pressure + 1000 END, CASE WHEN event_id % 9 <> 0 THEN humidity + 1000 END
  FROM telemetry WHERE humidity > 101)""",
    )
    sql["clean_telemetry_inclusive"] = _with(
        TELEMETRY,
        f"""cleaned_inc AS (
  SELECT * FROM telemetry
  WHERE device_id IS NOT NULL AND event_ts IS NOT NULL AND {NULLS} < 2)""",
    ) + _imputed("cleaned_inc")

    from .oracle_io import statements as io_statements

    sql.update(io_statements())
    return sql
