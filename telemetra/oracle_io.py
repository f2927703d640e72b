"""DuckDB SQL for the write/read-back and streaming driver queries."""

from __future__ import annotations


def statements() -> dict[str, str]:
    from .oracle import CLEANED, ISO, MESSAGE_REASON, NULLS, TELEMETRY, _imputed, _with

    latest = """SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
  FROM {src}) r WHERE rn = 1"""
    sql: dict[str, str] = {}
    sql["snapshot_roundtrip"] = _with(TELEMETRY) + "SELECT * FROM telemetry"
    sql["insert_overwrite"] = _with(TELEMETRY) + "SELECT * FROM telemetry"
    sql["insert_append"] = _with(TELEMETRY) + "SELECT * FROM telemetry UNION ALL SELECT * FROM telemetry"
    sql["upsert_latest"] = latest.format(src="events")
    sql["upsert_merge"] = (
        "WITH t AS (" + latest.format(src="(SELECT * FROM events WHERE event_id % 2 = 0)") + "),\n"
        "s AS (" + latest.format(src="(SELECT * FROM events WHERE event_id % 2 = 1)") + ")\n"
        """SELECT * FROM t WHERE NOT EXISTS (
  SELECT 1 FROM s WHERE s.user_id IS NOT DISTINCT FROM t.user_id AND s.event_type IS NOT DISTINCT FROM t.event_type)
UNION ALL SELECT * FROM s"""
    )
    sql["delete_by_key"] = """SELECT * FROM events e WHERE NOT EXISTS (
  SELECT 1 FROM events d WHERE d.value > 100
    AND d.user_id IS NOT DISTINCT FROM e.user_id AND d.event_type IS NOT DISTINCT FROM e.event_type)"""
    sql["catalog_sync"] = _with(TELEMETRY) + "SELECT * FROM telemetry"
    sql["clean_job_commits"] = _with(TELEMETRY, CLEANED) + _imputed("cleaned")
    kept = f"""kept AS (
  SELECT * FROM telemetry
  WHERE device_id IS NOT NULL AND event_ts IS NOT NULL AND {NULLS} < 2)"""
    sql["clean_job_notebook"] = _with(TELEMETRY, kept) + (
        "SELECT event_id, device_id, event_ts, ROUND(temperature, 6) AS temperature, "
        "ROUND(pressure, 6) AS pressure, ROUND(humidity, 6) AS humidity FROM kept\nUNION ALL\n"
        + _imputed("kept")
    )
    sql["stream_ingest"] = _with(TELEMETRY) + f""", m AS (
  SELECT 1 AS arrival, event_id, device_id, event_ts, temperature, pressure, humidity FROM telemetry
  UNION ALL
  SELECT 2, event_id, device_id, event_ts, temperature + 1000.0, pressure + 1000.0, humidity + 1000.0
  FROM telemetry WHERE humidity > 101),
good AS (SELECT * FROM m WHERE ({MESSAGE_REASON}) IS NULL),
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY device_id, event_ts ORDER BY arrival DESC) AS rn FROM good)
SELECT device_id, {ISO} AS timestamp, temperature, pressure, humidity FROM ranked WHERE rn = 1"""
    sql["stream_fold"] = sql["stream_keyed_state"] = sql["stream_ingest"]
    # of the missing readings, the fixture sends some as a text or a flag, the others as null
    sql["stream_merge_on_read"] = sql["stream_ingest"].replace(
        "temperature, pressure, humidity FROM ranked",
        """temperature, pressure, humidity,
  CAST(temperature IS NOT NULL OR event_id % 40 = 0 AS INT) + CAST(pressure IS NOT NULL AS INT)
    + CAST(humidity IS NOT NULL OR event_id % 44 = 0 AS INT) AS n_attributes,
  CAST(event_id % 40 = 0 AS INT) + CAST(event_id % 44 = 0 AS INT) AS n_extras,
  CASE WHEN event_id % 40 = 0 THEN 'zz' END AS temperature_text,
  CASE WHEN event_id % 44 = 0 THEN true END AS humidity_flag, pressure AS pressure_number
FROM ranked""",
    )
    sql["recrawl_schema"] = _with(TELEMETRY) + """SELECT event_id, device_id,
  CASE WHEN event_id % 2 = 0 THEN floor(temperature) ELSE temperature END AS temperature,
  CASE WHEN event_id % 2 = 1 THEN temperature > 100 END AS alarm,
  CASE WHEN event_id % 2 = 1 THEN humidity END AS humidity
FROM telemetry"""
    sql["partitioned_crawl"] = _with(TELEMETRY) + "SELECT event_id, temperature, device_id, event_id % 7 AS slot FROM telemetry"
    sql["change_refresh"] = _with(TELEMETRY, CLEANED) + _imputed("cleaned")
    return sql
