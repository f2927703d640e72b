"""Schema discovery over JSON records and folders, and its registration.

Types are inferred by ``schema_of_variant_agg``, a mergeable aggregate: each
task builds a partial schema of its records and only those partials are
shuffled, so discovery over the whole table never routes records to one task.

Column types form a lattice, so a crawl can only add columns and widen types:

    VOID < BOOLEAN, DATE, BIGINT < STRING    and    BIGINT < DOUBLE < STRING

A registered table is a view over a catalog table of the crawled schema.  A
crawl that changes the schema registers a new such table and switches the view;
one that does not, only looks for new files and partition folders.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.attributes import object_fields

VOID, BOOLEAN, DATE, BIGINT, DOUBLE, STRING = "VOID", "BOOLEAN", "DATE", "BIGINT", "DOUBLE", "STRING"
#: A crawl that finds more top-level fields fails: their list goes through the driver.
MAX_FIELDS = 1000
_CRAWLED = "telemetra.crawled"
_ONLY_NULLS = "only nulls so far"
_SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


def inferred_schema(df: DataFrame, json_col: str) -> DataFrame:
    """One row: the merged schema of all records (``OBJECT<...>``), keys unioned."""
    return df.agg(F.schema_of_variant_agg(F.try_parse_json(F.col(json_col))).alias("schema"))


def inferred_fields(df: DataFrame, json_col: str) -> DataFrame:
    """One row per top-level field: (field, data_type, n_records).

    ``data_type`` is the type merged over every record that has the field
    (e.g. integers and decimals widen, a string/number clash gives a string
    type); JSON nulls contribute nothing but are counted as present.
    """
    attrs = object_fields(df, [], F.try_parse_json(F.col(json_col))).withColumnRenamed("attribute", "field")
    return attrs.groupBy("field").agg(
        F.schema_of_variant_agg(F.col("v")).alias("data_type"),
        F.count(F.lit(1)).alias("n_records"),
    )


def column_type(discovered: str) -> str:
    """Column type for a discovered field: nested values as text, JSON numbers
    with a fraction as DOUBLE (their merged decimal scale is an artefact of
    the sample)."""
    t = discovered.upper()
    if t.startswith("DECIMAL") or t in ("FLOAT", DOUBLE):
        return DOUBLE
    if t in ("TINYINT", "SMALLINT", "INT", BIGINT):
        return BIGINT
    return t if t in (VOID, BOOLEAN, DATE) else STRING


def merge_types(a: str, b: str) -> str:
    """The least column type that holds the values of both."""
    if a == b or b == VOID:
        return a
    if a == VOID:
        return b
    return DOUBLE if {a, b} == {BIGINT, DOUBLE} else STRING


def merge_columns(registered: dict[str, str], crawled: dict[str, str]) -> dict[str, str]:
    """Both schemas as one: registered columns keep their place (also those
    that no record has any more), new ones follow by name."""
    out = {c: merge_types(t, crawled.get(c, VOID)) for c, t in registered.items()}
    out |= {c: crawled[c] for c in sorted(crawled) if c not in out}
    if len({c.lower() for c in out}) < len(out):
        raise ValueError(f"field names that differ only in case cannot be columns of one table: {sorted(out)}")
    return out


def field_types(fields: DataFrame, max_fields: int = MAX_FIELDS) -> dict[str, str]:
    """Column types of the discovered fields (rows of :func:`inferred_fields`);
    more than ``max_fields`` fail rather than being cut."""
    rows = fields.select("field", "data_type").limit(max_fields + 1).collect()
    if len(rows) > max_fields:
        raise ValueError(f"more than {max_fields} fields")
    return {r["field"]: column_type(r["data_type"]) for r in rows}


def folder_columns(spark: SparkSession, location: str) -> dict[str, str]:
    """Partition columns by the ``name=value`` folders below ``location``, outermost first, with their types.

    Only the files' paths are read.  A column is BIGINT or DATE when each of
    its values is the canonical text of one, otherwise STRING, so that ``001``
    stays as it is; the NULL folder has no say.  Files under different folder
    names fail.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    try:
        paths = files.load(location).select("path")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    base = "/" + re.sub(_SCHEME, "", location).strip("/") + "/"
    path = F.regexp_replace("path", _SCHEME, "")
    below = F.substr(path, F.instr(path, base) + len(base))  # from the location on, with the file's name
    folder = F.slice(F.split(below, "/"), F.lit(1), F.size(F.split(below, "/")) - 1)
    steps = paths.select(F.filter(folder, lambda p: p.contains("=")).alias("steps")).distinct()
    folders = steps.select("steps", F.transform("steps", lambda p: F.substring_index(p, "=", 1)).alias("names"))
    found = folders.select("names").distinct().limit(2).collect()
    if len(found) > 1:
        raise ValueError(f"files below {location} lie under different partition columns: {[list(r.names) for r in found]}")
    if not found or not found[0].names:
        return {}

    def value(i):
        raw = F.element_at("steps", i + 1)
        text = F.url_decode(F.replace(F.regexp_replace(raw, "^[^=]*=", ""), F.lit("+"), F.lit("%2B")))
        return F.when(~raw.endswith("=__HIVE_DEFAULT_PARTITION__"), text)

    aggs = []
    for i, _ in enumerate(found[0].names):
        v = value(i)
        aggs.append(F.bool_and(v.rlike(r"^(0|-?[1-9][0-9]{0,17})$")).alias(f"n{i}"))
        aggs.append(F.bool_and(v.rlike(r"^\d{4}-\d\d-\d\d$") & v.try_cast("date").isNotNull()).alias(f"d{i}"))
    kinds = folders.agg(*aggs).first()

    def kind(i):
        return VOID if kinds[f"n{i}"] is None else BIGINT if kinds[f"n{i}"] else DATE if kinds[f"d{i}"] else STRING

    return {c: kind(i) for i, c in enumerate(found[0].names)}


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _crawled_table(spark: SparkSession, qualified_name: str) -> str | None:
    """The catalog table behind a crawled view; None before the first crawl."""
    if not spark.catalog.tableExists(qualified_name):
        return None
    row = spark.sql(f"SHOW TBLPROPERTIES {qualified_name} ('{_CRAWLED}')").first()
    if row is None or row["value"].startswith("Table "):
        raise ValueError(f"{qualified_name} is there, but not from a crawl")
    return row["value"]


def registered_columns(spark: SparkSession, qualified_name: str) -> dict[str, str]:
    """Columns and types of a crawled table; VOID where only nulls have been seen."""
    table = _crawled_table(spark, qualified_name)
    fields = spark.table(table).schema.fields if table else []
    return {f.name: VOID if f.metadata.get("comment") == _ONLY_NULLS else column_type(f.dataType.simpleString()) for f in fields}


def register_inferred_table(
    spark: SparkSession,
    fields: DataFrame,
    qualified_name: str,
    location: str,
    partition_by: Sequence[str] | None = None,
    fmt: str = "parquet",
    max_fields: int = MAX_FIELDS,
) -> str:
    """Register the files at ``location`` under the discovered fields, merged
    with what is registered under ``qualified_name`` already.

    Crawling again adds new fields, widens types and finds new files and
    folders; columns that no record has any more stay.  Partition columns and
    their types are taken from the folder names (``partition_by``, if given,
    must agree with them); a record's field of such a name gives way to the
    folder's.  ``fields`` is the result of :func:`inferred_fields`; only that
    field list reaches the driver, never the records.  Readers see the old
    schema or the new one, never neither.  Records in JSON can be read under
    every wider type; of typed files (``fmt``) Spark widens less, and a read
    fails where it does not.
    """
    folders = folder_columns(spark, location)
    if partition_by is not None and folders and list(partition_by) != list(folders):
        raise ValueError(f"{location} is partitioned by {list(folders)}, not by {list(partition_by)}")
    folders = folders or {c: VOID for c in partition_by or ()}
    previous = _crawled_table(spark, qualified_name)
    known = registered_columns(spark, qualified_name)
    if previous and [c for c in known if c in folders] != list(folders):
        raise ValueError(f"{qualified_name} was registered with other partition columns than {list(folders)}")
    crawled = {c: t for c, t in field_types(fields, max_fields).items() if c not in folders}
    columns = merge_columns(known, crawled | folders)
    ordered = [c for c in columns if c not in folders] + list(folders)
    ddl = ", ".join(f"{_quoted(c)} {STRING} COMMENT '{_ONLY_NULLS}'" if columns[c] == VOID else f"{_quoted(c)} {columns[c]}" for c in ordered)
    table = f"{qualified_name}__{hashlib.sha1(f'{ddl} {list(folders)} {fmt} {location}'.encode()).hexdigest()[:12]}"
    part = f" PARTITIONED BY ({', '.join(map(_quoted, folders))})" if folders else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING {fmt}{part} LOCATION '{location}'")
    if folders:
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    spark.catalog.refreshTable(table)
    if table != previous:
        visible = ", ".join(map(_quoted, ordered))
        spark.sql(f"CREATE OR REPLACE VIEW {qualified_name} TBLPROPERTIES ('{_CRAWLED}'='{table}') AS SELECT {visible} FROM {table}")
        if previous:
            spark.sql(f"DROP TABLE IF EXISTS {previous}")  # external: its files stay
    return qualified_name


def crawl(spark: SparkSession, qualified_name: str, location: str, max_fields: int = MAX_FIELDS) -> str:
    """Look at all JSON records below ``location`` and register what is there."""
    records = spark.read.text(location).select("value")
    return register_inferred_table(spark, inferred_fields(records, "value"), qualified_name, location, fmt="json", max_fields=max_fields)
