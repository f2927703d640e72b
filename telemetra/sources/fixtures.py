"""Telemetry-shaped data derived from the driver's ``events`` table.

``events`` has no NULLs and no device readings, so these views derive them
deterministically from ``event_id`` (the same rules appear as SQL in the
oracle).  They are projections of the whole table: every row flows through,
and the derived columns make NULL keys, sparse rows, malformed bodies and
re-sent messages appear at fixed rates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _unless(cond: Column, value: Column) -> Column:
    return F.when(~cond, value)


def telemetry_from_events(events: DataFrame) -> DataFrame:
    """``telemetry``: event_id, device_id, event_ts and three readings with NULLs."""
    eid = F.col("event_id")
    v = F.col("value")
    return events.select(
        eid,
        _unless(eid % 97 == 0, F.concat(F.lit("device_"), (F.col("user_id") % 3 + 1).cast("string"))).alias(
            "device_id"
        ),
        _unless(eid % 101 == 0, F.col("ts")).alias("event_ts"),
        _unless((eid % 20 == 0) | (eid % 33 == 0), v).alias("temperature"),
        _unless((eid % 21 == 0) | (eid % 33 == 0), v * 2).alias("pressure"),
        _unless((eid % 22 == 0) | (eid % 33 == 0), v + 1).alias("humidity"),
    )


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, ISO_FORMAT)


def message_bodies(telemetry: DataFrame, reading_offset: float = 0.0) -> DataFrame:
    """One JSON message per telemetry row: (event_id, body).

    Readings are written with explicit ``null``s (as a device sends them),
    some of the missing ones as a text or a boolean; a NULL key field is
    written as ``null``.  Every 211th body is cut short
    (malformed JSON) and every 307th carries ``"data": null``.
    """
    eid = F.col("event_id")
    data = F.struct(*[(F.col(r) + F.lit(reading_offset)).alias(r) for r in ("temperature", "humidity", "pressure")])
    msg = F.struct(
        F.col("device_id").alias("device"),
        iso_text(F.col("event_ts")).alias("timestamp"),
        _unless(eid % 307 == 0, data).alias("data"),
    )
    body = F.to_json(msg, {"ignoreNullFields": "false"})
    body = F.when(eid % 40 == 0, F.replace(body, F.lit('"temperature":null'), F.lit('"temperature":"zz"'))).otherwise(body)
    body = F.when(eid % 44 == 0, F.replace(body, F.lit('"humidity":null'), F.lit('"humidity":true'))).otherwise(body)
    body = F.when(eid % 211 == 0, F.substring(body, 1, 17)).otherwise(body)
    return telemetry.select(eid, body.alias("body"))


def tagged_json(events: DataFrame) -> DataFrame:
    """(event_id, doc): a JSON object per event with mixed value types.

    Booleans, integers, decimals, strings, an explicit null and a nested
    object — the cases the attribute tagger distinguishes.
    """
    doc = F.concat(
        F.lit('{"reading":'), F.col("value").cast("string"),
        F.lit(',"count":'), F.col("user_id").cast("string"),
        F.lit(',"kind":"'), F.col("event_type"),
        F.lit('","alarm":'), F.when(F.col("value") > 100, F.lit("true")).otherwise(F.lit("false")),
        F.lit(',"note":null,"props":'), F.col("props"),
        F.lit("}"),
    )
    return events.select("event_id", doc.alias("doc"))


def change_events(events: DataFrame) -> DataFrame:
    """(event_id, body): change notifications in the event-bus shape.

    ``{"source": ..., "detail-type": ..., "detail": {"eventSourceARN": ...}}``
    """
    body = F.to_json(
        F.struct(
            F.concat(F.lit("svc."), F.col("event_type")).alias("source"),
            F.when(F.col("value") > 100, F.lit("Update Stream Event")).otherwise(F.lit("Heartbeat")).alias(
                "detail-type"
            ),
            F.struct(F.concat(F.lit("arn:table/t"), (F.col("user_id") % 4).cast("string")).alias("eventSourceARN")).alias(
                "detail"
            ),
        )
    )
    return events.select("event_id", body.alias("body"))


CHANGE_EVENT_SCHEMA = "source string, `detail-type` string, detail struct<eventSourceARN: string>"
