"""Keyed-row operators: latest row per key, key delete, upsert (A3, K2, K5 cores).

All of them are plain joins/windows on the record key, so Spark hash-
partitions on the key once and AQE handles the rest:

* ``latest_per_key`` is ``row_number() == 1``; Spark inserts a *partial*
  window-group limit before the shuffle, so each map task forwards at most one
  row per key.  A key that holds a third of the table therefore sends one row
  per map task, not a third of the table, to its reducer.
* ``delete_keys`` / ``upsert_rows`` use a null-safe left-anti join.  The key
  side is reduced with ``dropDuplicates`` (partial aggregation, map-side) and
  the join strategy is left to AQE: it becomes a broadcast hash join when the
  materialised key side is measured below
  ``spark.sql.adaptive.autoBroadcastJoinThreshold`` and stays a sort-merge
  join otherwise; a skewed target partition is split by AQE's skew-join rule
  (left-anti joins split their left side).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    NumericType,
    StringType,
    TimestampNTZType,
    TimestampType,
)


def _order_cols(order_by: Sequence[str | Column]) -> list[Column]:
    return [F.col(o).desc_nulls_last() if isinstance(o, str) else o for o in order_by]


def _zero(dtype: DataType) -> Column | None:
    """A fixed non-NULL value of ``dtype`` (the stand-in for NULL in a key)."""
    if isinstance(dtype, StringType):
        return F.lit("")
    if isinstance(dtype, BooleanType):
        return F.lit(False)
    if isinstance(dtype, NumericType):
        return F.lit(0).cast(dtype)
    if isinstance(dtype, (DateType, TimestampType, TimestampNTZType)):
        return F.lit("1970-01-01").cast(dtype)
    return None


def null_safe_key(df: DataFrame, keys: Sequence[str]) -> list[Column] | None:
    """Key columns rewritten so that plain equality is NULL-safe.

    Each key ``k`` becomes ``(coalesce(k, zero), isnull(k))`` — the same
    expressions Spark derives for ``<=>`` join keys.  Partitioning a window or
    an aggregate by them lets a later null-safe join on the same keys reuse
    that partitioning instead of shuffling again.  None for key types without
    a stand-in value (then ``eqNullSafe`` is used as is).
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    out: list[Column] = []
    for k in keys:
        z = _zero(types[k])
        if z is None:
            return None
        out += [F.coalesce(F.col(k), z), F.col(k).isNull()]
    return out


def _with_key_columns(
    df: DataFrame, keys: Sequence[str], null_safe: bool = True
) -> tuple[DataFrame, list[str]]:
    """``df`` plus materialised NULL-safe key columns ``__nk_i`` (or the raw keys)."""
    norm = null_safe_key(df, keys) if null_safe else None
    if norm is None:
        return df, list(keys)
    names = [f"__nk_{i}" for i in range(len(norm))]
    return df.select("*", *[c.alias(n) for c, n in zip(norm, names)]), names


def _latest(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column], null_safe: bool = True
) -> tuple[DataFrame, list[str]]:
    if not order_by:
        raise ValueError("latest_per_key needs an order (no implicit precombine column)")
    keyed, names = _with_key_columns(df, keys, null_safe)
    w = Window.partitionBy(*names).orderBy(*_order_cols(order_by))
    out = keyed.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")
    return out, names


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column],
    null_safe: bool = True,
) -> DataFrame:
    """A3: one row per record key — the one ordered last by ``order_by``.

    ``order_by`` names columns in ascending "arrival" order (the last wins);
    Column objects are used verbatim as the window order (first row wins).
    Ties must be broken by the caller (give a unique last column) for a
    deterministic result.  NULL is a key value like any other.

    The window is partitioned by the NULL-safe key columns so that a later
    null-safe join on the key can reuse the shuffle.  ``null_safe=False``
    partitions by the raw keys instead — for input whose keys are known to be
    non-NULL, where it keeps the key columns themselves in the exchange (a
    second use of the same input, such as the means of the clean, can then
    reuse it).
    """
    out, names = _latest(df, keys, order_by, null_safe)
    return out.drop(*[n for n in names if n not in keys])


def _key_side(rows: DataFrame, keys: Sequence[str], distinct: bool) -> tuple[DataFrame, list[str], bool]:
    """Key frame with renamed (normalised when possible) key columns."""
    norm = null_safe_key(rows, keys)
    if norm is None:
        cols = [F.col(k) for k in keys]
    else:
        cols = norm
    alias = [f"__key_{i}" for i in range(len(cols))]
    side = rows.select(*[c.alias(a) for c, a in zip(cols, alias)])
    if distinct:
        side = side.dropDuplicates()
    return side, alias, norm is not None


def _match(target: DataFrame, keys: Sequence[str], side: DataFrame, alias: Sequence[str], normalised: bool) -> Column:
    if normalised:
        left = null_safe_key(target, keys)
        cond = None
        for l_col, a in zip(left, alias):
            term = l_col == side[a]
            cond = term if cond is None else cond & term
        return cond
    cond = None
    for k, a in zip(keys, alias):
        term = target[k].eqNullSafe(side[a])
        cond = term if cond is None else cond & term
    return cond


def delete_keys(target: DataFrame, rows: DataFrame, keys: Sequence[str], distinct: bool = True) -> DataFrame:
    """K5: drop every target row whose key appears in ``rows`` (NULL matches NULL).

    Deletes go by key, not by row: a duplicate of a deleted key goes too.
    The key side is de-duplicated map-side first; its partitioning is then
    reused by the join.  ``distinct=False`` says that the keys are distinct
    already, which saves that shuffle.
    """
    side, alias, normalised = _key_side(rows, keys, distinct=distinct)
    return target.join(side, _match(target, keys, side, alias, normalised), "left_anti")


def upsert_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column],
) -> DataFrame:
    """K2: key match -> the source row replaces the whole target row, else insert.

    The source is first reduced to its latest row per key (precombine).  No
    column-wise coalescing: attributes missing from the newer row are NULL.
    The source is shuffled once (by its dedup window, on the NULL-safe key
    columns) and the anti-join reuses that partitioning: only the target is
    exchanged for the join.
    """
    latest, names = _latest(source, keys, order_by)
    alias = [f"__key_{i}" for i in range(len(names))]
    side = latest.select(*[F.col(n).alias(a) for n, a in zip(names, alias)])
    normalised = names != list(keys)
    kept = target.join(side, _match(target, keys, side, alias, normalised), "left_anti")
    rows = latest.drop(*[n for n in names if n not in keys])
    return kept.unionByName(rows, allowMissingColumns=True)
