"""Batch sources: parquet tables, catalog tables, typed items, lake snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.attributes import ITEM_TYPE, unwrap_attribute


def table_path(base_dir: str, name: str) -> str:
    return f"{base_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, base_dir: str, name: str, schema: StructType | str | None = None) -> DataFrame:
    """Parquet table of the driver layout; projection/filters push into the scan."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(table_path(base_dir, name))


def register_external(
    spark: SparkSession,
    qualified_name: str,
    path: str,
    fmt: str = "parquet",
    database_location: str | None = None,
) -> str:
    """Register files as an external catalog table (metadata only, no copy)."""
    db, _, table = qualified_name.rpartition(".")
    if db:
        loc = f" LOCATION '{database_location}'" if database_location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}{loc}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {qualified_name} USING {fmt} LOCATION '{path}'")
    return qualified_name


def catalog_scan(spark: SparkSession, qualified_name: str) -> DataFrame:
    """All rows of a registered table (the analogue of a catalog frame)."""
    return spark.table(qualified_name)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """JSON records -> DataFrame with an inferred schema.

    Keys are unioned over the records (a key some records lack is a column
    that is NULL for them), and conflicting types widen as Spark's JSON
    inference does.  Inference is a distributed pass over all records.
    """
    return spark.read.json(path)


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """Exported typed items, one JSON object per line.

    Each line is ``{"attr": {"S"|"N"|"BOOL": value}, ...}``; it becomes a
    single ``item map<string, struct<S,N,BOOL>>`` column.  Lines that are
    not an item object give a NULL item (kept, so nothing is silently lost).
    """
    lines = spark.read.text(path)
    return lines.select(F.from_json("value", ITEM_TYPE).alias("item"), F.col("value").alias("raw"))


def read_unwrapped_items(
    spark: SparkSession,
    path: str,
    columns: dict[str, str],
) -> DataFrame:
    """S2 + S3: read items and surface ``columns`` (name -> Spark type) typed."""
    items = read_items(spark, path)
    item = F.col("item")
    return items.select(*[unwrap_attribute(item, name).try_cast(dtype).alias(name) for name, dtype in columns.items()])


def read_snapshot(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A partitioned parquet snapshot, read with its declared schema.

    Giving the schema keeps partition values typed as declared (``'001'``
    stays a string instead of being inferred as the integer 1).
    """
    return spark.read.schema(schema).option("basePath", path).parquet(path)
