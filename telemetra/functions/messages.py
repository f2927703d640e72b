"""Message bodies: parse, key, validate.

A message is ``{"device": ..., "timestamp": ..., "data": {...}}`` as JSON
text.  Parsing goes through VARIANT (``try_parse_json``) so malformed text
becomes a NULL rather than an exception, and the dynamic ``data`` object
keeps every attribute whatever its type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import READINGS
from .attributes import drop_null_attrs, typed_attrs, unwrap_item
from .evaluation import computed_once, where_once

REASON_MALFORMED = "malformed_json"
REASON_NO_DEVICE = "missing_device"
REASON_NO_TIMESTAMP = "missing_timestamp"
REASON_NO_DATA = "missing_data"
REASONS = (REASON_MALFORMED, REASON_NO_DEVICE, REASON_NO_TIMESTAMP, REASON_NO_DATA)


def parse_body(body: Column) -> Column:
    """JSON text -> VARIANT (NULL when the text is not JSON)."""
    return F.try_parse_json(body)


def message_fields(parsed: Column) -> list[Column]:
    """P2 + P3: the required fields, renamed to the record key.

    ``device`` -> ``device_id``; ``timestamp`` stays ISO text; ``data`` is
    the attribute map with JSON nulls removed (P4) and values as text.
    """
    return [
        F.try_variant_get(parsed, "$.device", "string").alias("device_id"),
        F.try_variant_get(parsed, "$.timestamp", "string").alias("timestamp"),
        drop_null_attrs(F.try_variant_get(parsed, "$.data", "map<string,string>")).alias("data"),
    ]


def message_item(parsed: Column) -> Column:
    """The ``data`` object as a typed item, ``attribute -> {tag: text}``; NULL when there is none."""
    data = F.try_variant_get(parsed, "$.data", "map<string,variant>")
    present = F.map_filter(data, lambda _k, v: ~F.coalesce(F.is_variant_null(v), F.lit(True)))
    return typed_attrs(present)


def reject_reason(parsed: Column, device_id: Column, timestamp: Column, data: Column) -> Column:
    """why a message cannot become an item; NULL when it can."""
    return (
        F.when(parsed.isNull(), F.lit(REASON_MALFORMED))
        .when(device_id.isNull(), F.lit(REASON_NO_DEVICE))
        .when(timestamp.isNull(), F.lit(REASON_NO_TIMESTAMP))
        .when(data.isNull(), F.lit(REASON_NO_DATA))
    )


def parse_messages(df: DataFrame, body_col: str = "body", keep: tuple[str, ...] = (), items: bool = False) -> DataFrame:
    """Parse bodies into (kept cols, device_id, timestamp, data, reason), with ``items`` also the typed item.

    One parse per row; ``reason`` is NULL for good records.  Split the result
    with :func:`split_rejects` — both outputs come from this single frame.
    With ``items``, ``data`` is the item's text, and the item is computed once
    however often it is used further on.
    """
    parsed = df.select(*keep, body_col, parse_body(F.col(body_col)).alias("_j"))
    fields = message_fields(F.col("_j"))
    if items:
        item = computed_once(message_item(F.col("_j")))
        parsed = parsed.select(*keep, body_col, "_j", *fields[:2], item.alias("item"))
        parsed = parsed.withColumn("data", unwrap_item(F.col("item")))
    else:
        parsed = parsed.select(*keep, body_col, "_j", *fields)
    return parsed.select(
        *keep,
        body_col,
        "device_id",
        "timestamp",
        "data",
        *(["item"] if items else []),
        reject_reason(F.col("_j"), F.col("device_id"), F.col("timestamp"), F.col("item" if items else "data")).alias("reason"),
    )


def split_rejects(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, rejects) — a bad record never stops or loses the others.

    Each output still scans its input; :func:`telemetra.sinks.split.write_split`
    writes both from one scan.
    """
    good = where_once(parsed, F.col("reason").isNull()).drop("reason")
    rejects = where_once(parsed, F.col("reason").isNotNull())
    return good, rejects


def readings_columns(data: Column, readings=READINGS, dtype: str = "double") -> list[Column]:
    """Typed reading columns out of the attribute map (absent -> NULL)."""
    return [data[r].try_cast(dtype).alias(r) for r in readings]
