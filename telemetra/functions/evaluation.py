"""Evaluation-order helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def where_once(df: DataFrame, cond: Column) -> DataFrame:
    """Filter ``df`` by ``cond`` without re-evaluating ``df``'s projections.

    Catalyst pushes a filter below the projection that defines the columns it
    reads, substituting their definitions; when those are parses
    (``try_parse_json``, ``from_json``) every reference becomes another parse
    of the same text.  Referencing a nondeterministic column keeps the filter
    above the projection, so each row is parsed once.  ``SPARK_PARTITION_ID()``
    costs nothing and is always >= 0.
    """
    guarded = df.withColumn("__part", F.spark_partition_id())
    return guarded.where(cond & (F.col("__part") >= 0)).drop("__part")


def computed_once(c: Column) -> Column:
    """``c`` as it is, kept from being copied into the expressions that use it.

    Catalyst merges neighbouring projections and writes a column's definition
    wherever the column is read (each map lookup in an item would compute the
    whole item).  Nondeterministic columns are never merged.
    """
    return F.when(F.spark_partition_id() >= 0, c)
