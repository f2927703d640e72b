"""Driver-facing query builders: ``name -> (spark, sf_dir) -> DataFrame``.

Each builder reads the driver tables (whole tables, no subsets) and runs one
operator or composition of this package over them.  The matching DuckDB SQL
lives in :mod:`telemetra.oracle`; column names agree one to one.  Values that
come out of a mean are rounded to 6 places (summation order differs between
engines).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .constants import FIXTURE_KEY, READINGS
from .functions.attributes import drop_null_attrs, flatten_attrs, long_attrs, tagged_long_attrs, to_item
from .functions.casts import cast_readings
from .functions.evaluation import where_once
from .functions.messages import parse_messages, readings_columns, split_rejects
from .functions.nulls import half_threshold, non_key_columns, null_count
from .functions.predicates import event_pattern, topic_is
from .operators.flatten import flatten_all
from .operators.infer import inferred_fields
from .operators.inspect import capped_scan, preview, schema_report
from .operators.quality import column_means, drop_null_keys, drop_sparse_rows, impute_mean, null_key_rows, sparse_rows
from .plans.clean import clean_telemetry, sparse_threshold
from .registry_io import CHANGE_PATTERN
from .session import work_dir
from .sinks.split import write_split
from .sources.fixtures import (
    CHANGE_EVENT_SCHEMA,
    change_events,
    message_bodies,
    tagged_json,
    telemetry_from_events,
)
from .sources.tables import catalog_scan, read_records, read_table, read_unwrapped_items, register_external

Builder = Callable[[SparkSession, str], DataFrame]

def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry_from_events(events(spark, sf_dir))


def _round_readings(df: DataFrame, cols=READINGS, places: int = 6) -> DataFrame:
    return df.select(*[F.round(F.col(c), places).alias(c) if c in cols else F.col(c) for c in df.columns])


# --- scans and sources --------------------------------------------------------


def q_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Register the events files as a catalog table and scan it."""
    path = f"{sf_dir.rstrip('/')}/events.parquet"
    digest = hashlib.sha1(path.encode()).hexdigest()[:10]
    name = register_external(
        spark, f"telemetra_src.events_{digest}", path, database_location=work_dir(spark, "src-db")
    )
    return catalog_scan(spark, name)


def q_scan_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 1000 rows by key order."""
    return capped_scan(events(spark, sf_dir), ["event_id"], 1000)


def q_scan_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2/L1 at the full cap of one page, by a key whose first column has ties."""
    return capped_scan(read_table(spark, sf_dir, "lineitem"), ["l_shipdate DESC", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])


ITEM_COLUMNS = {
    "event_id": "bigint",
    "device_id": "string",
    "event_ts": "timestamp_ntz",
    "temperature": "double",
    "pressure": "double",
    "humidity": "double",
}


def _export_items(spark: SparkSession, sf_dir: str) -> str:
    """Telemetry rows written as typed items (JSON lines), NULL attributes absent."""
    tele = telemetry(spark, sf_dir)
    path = work_dir(spark, "items")
    tele.select(F.to_json(to_item(tele, list(ITEM_COLUMNS))).alias("value")).write.text(path)
    return path


def q_item_unwrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: telemetry rows -> exported typed items (JSON lines) -> unwrapped, typed."""
    return read_unwrapped_items(spark, _export_items(spark, sf_dir), ITEM_COLUMNS)


def q_item_scan_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 + L1: typed items read back, unwrapped, at most 1000 by key order."""
    items = read_unwrapped_items(spark, _export_items(spark, sf_dir), ITEM_COLUMNS)
    return capped_scan(items, ["event_id"], 1000)


def q_records_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry written as JSON records without their NULL attributes,
    read back with an inferred schema (keys unioned, missing -> NULL)."""
    tele = telemetry(spark, sf_dir)
    path = work_dir(spark, "records")
    as_json = F.to_json(F.struct(*tele.columns), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
    tele.select(as_json.alias("value")).write.text(path)
    frame = read_records(spark, path)
    return frame.select(
        "event_id",
        "device_id",
        F.col("event_ts").try_cast("timestamp_ntz").alias("event_ts"),
        *[F.col(c).alias(c) for c in READINGS],
    )


def q_infer_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discovered fields of the ``props`` JSON over all events."""
    return inferred_fields(events(spark, sf_dir), "props")


# --- projections and scalar functions -------------------------------------------


def reading_texts(tele: DataFrame) -> DataFrame:
    """Readings as text, with malformed ('zz') and empty values mixed in."""
    eid = F.col("event_id")

    def text(c: str):
        return (
            F.when(eid % 50 == 0, F.lit("zz"))
            .when(eid % 77 == 0, F.lit(""))
            .otherwise(F.col(c).cast("string"))
        )

    return tele.select("event_id", *[text(c).alias(c) for c in READINGS])


def q_cast_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tolerant numeric cast."""
    return cast_readings(reading_texts(telemetry(spark, sf_dir)), READINGS)


def q_parse_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message JSON -> keyed, typed rows (good messages only)."""
    parsed = parse_messages(message_bodies(telemetry(spark, sf_dir)), keep=("event_id",))
    good, _ = split_rejects(parsed)
    return good.select("event_id", "device_id", "timestamp", *readings_columns(F.col("data")))


def _readings_map(df: DataFrame):
    pairs = []
    for r in READINGS:
        pairs += [F.lit(r), F.col(r)]
    return F.create_map(*pairs)


def q_drop_null_attrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attribute map without NULL values, in long form."""
    tele = telemetry(spark, sf_dir)
    return long_attrs(tele, ["event_id"], drop_null_attrs(_readings_map(tele)))


def q_flatten_attrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: attribute map -> known readings as columns, the rest in ``extras``."""
    tele = telemetry(spark, sf_dir)
    pairs = []
    for r in READINGS:
        pairs += [F.lit(r), F.col(r).cast("string")]
    attrs = drop_null_attrs(F.create_map(*pairs, F.lit("kind"), F.lit("sensor")))
    flat = tele.select("event_id", *flatten_attrs(attrs, READINGS))
    return flat.select("event_id", *READINGS, F.size("extras").alias("n_extras"))


def q_flatten_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: every attribute found in the JSON objects becomes a typed column."""
    return flatten_all(tagged_json(events(spark, sf_dir)), "doc", ["event_id"])


def q_tag_attrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type tag and text of every non-null JSON attribute."""
    docs = tagged_json(events(spark, sf_dir))
    return tagged_long_attrs(docs, ["event_id"], F.try_parse_json(F.col("doc")))


def q_row_null_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL count of the readings and the sparse threshold."""
    tele = telemetry(spark, sf_dir)
    counted = [c for c in tele.columns if c != "event_id"]
    measured = non_key_columns(counted, FIXTURE_KEY)
    return tele.select("event_id", null_count(measured).alias("null_count"), F.lit(half_threshold(len(counted))).alias("threshold"))


# --- filters -----------------------------------------------------------------------


def q_null_key_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_key_rows(telemetry(spark, sf_dir), FIXTURE_KEY)


def _sparse(spark: SparkSession, sf_dir: str, inclusive: bool) -> DataFrame:
    tele = drop_null_keys(telemetry(spark, sf_dir), FIXTURE_KEY)
    return sparse_rows(tele, READINGS, sparse_threshold(FIXTURE_KEY, READINGS), inclusive=inclusive)


def q_sparse_rows_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sparse(spark, sf_dir, inclusive=False)


def q_sparse_rows_inclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sparse(spark, sf_dir, inclusive=True)


def q_topic_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """every field of the messages on one topic (event_type plays the topic)."""
    ev = events(spark, sf_dir)
    return ev.where(topic_is(F.col("event_type"), "click")).select("*")


def parsed_change_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ch = change_events(events(spark, sf_dir))
    return ch.select("event_id", F.from_json("body", CHANGE_EVENT_SCHEMA).alias("e")).select("event_id", "e.*")


def q_event_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    """change events matching a nested source/detail-type/ARN pattern."""
    matched = where_once(parsed_change_events(spark, sf_dir), event_pattern(CHANGE_PATTERN))
    return matched.select(
        "event_id",
        "source",
        F.col("`detail-type`").alias("detail_type"),
        F.col("detail.eventSourceARN").alias("event_source_arn"),
    )


def q_reject_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the reject output (event_id, reason) of the message parse."""
    parsed = parse_messages(message_bodies(telemetry(spark, sf_dir)), keep=("event_id",))
    _, rejects = split_rejects(parsed)
    return rejects.select("event_id", "reason")


def _written_split(spark: SparkSession, sf_dir: str):
    parsed = parse_messages(message_bodies(telemetry(spark, sf_dir)), keep=("event_id",))
    rows = parsed.select("event_id", "device_id", "timestamp", *readings_columns(F.col("data")), "reason")
    return write_split(rows, work_dir(spark, "split"))


def q_parse_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """good messages and rejects, both from one parse and one write."""
    split = _written_split(spark, sf_dir)
    good = split.good.select("event_id", F.lit("good").alias("outcome"), "device_id", "timestamp", *READINGS)
    return good.unionByName(split.rejects.select("event_id", F.col("reason").alias("outcome")), allowMissingColumns=True)


def q_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rows by outcome, observed while the split was written."""
    return spark.createDataFrame(list(_written_split(spark, sf_dir).counts.items()), "outcome string, n long")


# --- aggregations ------------------------------------------------------------------


def cleaned_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 + F2 applied: the rows the means are taken over."""
    tele = drop_null_keys(telemetry(spark, sf_dir), FIXTURE_KEY)
    return drop_sparse_rows(tele, READINGS, sparse_threshold(FIXTURE_KEY, READINGS))


def q_column_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = column_means(cleaned_rows(spark, sf_dir), READINGS)
    return means.select(*[F.round(F.col(c), 6).alias(c) for c in means.columns])


def q_impute_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_readings(impute_mean(telemetry(spark, sf_dir), READINGS))


# --- inspection ----------------------------------------------------------------------


def q_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(telemetry(spark, sf_dir), ["event_id"], 5)


def q_schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema_report(telemetry(spark, sf_dir))


# --- pipelines -------------------------------------------------------------------------


def q_clean_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1, the flagship: one row per key, null-key and sparse deletes, mean imputation."""
    return _round_readings(clean_telemetry(telemetry(spark, sf_dir), order_by=["event_id"]))


def q_clean_telemetry_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 for a source known to hold each key once: without A3 no row is shuffled."""
    return _round_readings(clean_telemetry(telemetry(spark, sf_dir)))


def q_clean_telemetry_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 for a source that repeats keys: rows with humidity > 101 were sent again
    later with other readings, every ninth of them without one; the latest row
    per key comes first (A3), so a dense row does not outlive a sparse one."""
    tele = telemetry(spark, sf_dir)
    again = tele.where(F.col("humidity") > 101)
    resent = {r: F.when(F.col("event_id") % 9 != 0, F.col(r) + 1000.0) for r in READINGS}
    again = again.withColumns(resent | {"event_id": F.col("event_id") + 1_000_000_000})
    return _round_readings(clean_telemetry(tele.unionByName(again), order_by=["event_id"]))


def q_clean_telemetry_inclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 with the inclusive (``>=``) sparse rule."""
    return _round_readings(clean_telemetry(telemetry(spark, sf_dir), inclusive=True))


def builders() -> dict[str, Builder]:
    from . import registry_io

    out: dict[str, Builder] = {
        "table_scan": q_table_scan,
        "scan_capped": q_scan_capped,
        "scan_page": q_scan_page,
        "item_unwrap": q_item_unwrap,
        "item_scan_capped": q_item_scan_capped,
        "records_frame": q_records_frame,
        "infer_schema": q_infer_schema,
        "cast_readings": q_cast_readings,
        "parse_body": q_parse_body,
        "drop_null_attrs": q_drop_null_attrs,
        "flatten_attrs": q_flatten_attrs,
        "flatten_all": q_flatten_all,
        "tag_attrs": q_tag_attrs,
        "row_null_count": q_row_null_count,
        "null_key_rows": q_null_key_rows,
        "sparse_rows_strict": q_sparse_rows_strict,
        "sparse_rows_inclusive": q_sparse_rows_inclusive,
        "topic_route": q_topic_route,
        "event_pattern": q_event_pattern,
        "reject_split": q_reject_split,
        "parse_split": q_parse_split,
        "split_counts": q_split_counts,
        "column_means": q_column_means,
        "impute_mean": q_impute_mean,
        "preview": q_preview,
        "schema_report": q_schema_report,
        "clean_telemetry": q_clean_telemetry,
        "clean_telemetry_keyed": q_clean_telemetry_keyed,
        "clean_telemetry_dedup": q_clean_telemetry_dedup,
        "clean_telemetry_inclusive": q_clean_telemetry_inclusive,
    }
    out.update(registry_io.builders())
    return out
