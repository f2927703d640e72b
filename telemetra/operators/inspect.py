"""Inspection operators: capped scan, preview, schema report (L1-L3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, StringType, TimestampNTZType, TimestampType

from ..constants import ITEM_SCAN_CAP

#: Steps of the threshold search, and of the ladder of quantiles of each step (halves of the rows).
MAX_STEPS, LADDER = 20, 40


def _order(o: str | Column) -> Column:
    if not isinstance(o, str):
        return o
    name, _, direction = o.partition(" ")
    return F.col(name).desc() if direction.upper() == "DESC" else F.col(name).asc()


def _sketch_key(df: DataFrame, o: str | Column) -> tuple[Column, Column, str, bool, bool] | None:
    """(what a quantile sketch takes, the column to bound, its type, falling,
    whether equal values tie) of an order column: rows before others in the
    order never have a later value.  None: there is no such column."""
    if not isinstance(o, str):
        return None
    name, _, direction = o.partition(" ")
    kind, c, falling = df.schema[name].dataType, F.col(name), direction.upper() == "DESC"
    if isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
        return c, c, kind.simpleString(), falling, True
    if isinstance(kind, NumericType):
        fractional = kind.typeName() in ("float", "double")
        return F.nanvl(c, F.lit(float("inf"))) if fractional else c, c, kind.simpleString(), falling, True
    if isinstance(kind, StringType):  # the first seven bytes as a number
        prefix = F.conv(F.rpad(F.hex(F.substring(c.cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("bigint")
        return prefix, prefix, "bigint", falling, False
    return None


def first_rows_bound(df: DataFrame, order_by: Sequence[str | Column], n: int, slack: float = 2.0) -> Column | None:
    """A condition that the first ``n`` rows by ``order_by`` meet, and few others; None: all rows.

    One aggregate counts the rows and takes a ladder of quantiles of the first
    order column from a mergeable sketch; the quantile expected to leave a few
    more than ``n`` rows becomes the bound, and the next aggregate, which the
    bound prunes, counts what it really left.  A bound that left too few is
    taken back.  This goes on until at most ``slack * n`` rows are left.  Where
    ties keep more, they are cut by the next order column (texts that agree in
    their first seven bytes are not).
    """
    if not order_by or (found := _sketch_key(df, order_by[0])) is None:
        return None
    sketch, key, kind, falling, ties = found
    literal = lambda t: F.lit(t).cast(kind)
    before = lambda t: (key > literal(t)) if falling else key.isNull() | (key < literal(t))
    until = lambda t: (key >= literal(t)) if falling else key.isNull() | (key <= literal(t))
    shares = [2.0**-k for k in range(1, LADDER + 1)]
    ladder = F.percentile_approx(sketch, [1 - s if falling else s for s in shares], 10_000)
    if kind.startswith(("date", "timestamp")):
        ladder = ladder.cast("array<string>")
    bound, counted, tried, too_low = None, None, None, set()
    for _ in range(MAX_STEPS):
        rows = df if tried is None else df.where(until(tried))
        now = rows.agg(F.count(F.lit(1)), F.count_if(key.isNull()), ladder).first()
        if tried is not None and now[0] < n:
            too_low.add(tried)
        else:
            bound, counted = tried, now
        count, nulls, values = counted
        if count <= slack * n:
            break
        if values is None or not falling and nulls >= n:  # NULLs tie, and they come first or are all there is
            rest = first_rows_bound(df.where(key.isNull()), order_by[1:], n, slack)
            return key.isNull() if rest is None else key.isNull() & rest
        left, wanted = count - nulls, n - (0 if falling else nulls)
        fits = [t for s, t in zip(shares, values) if s * left >= wanted + left / 5_000 and t not in too_low and t != bound]
        if not fits:
            break
        tried = fits[-1]
    if bound is None:
        return None
    if counted[0] > slack * n and ties:
        nearer, tied = df.where(before(bound)), key == literal(bound)
        ahead = nearer.count()
        if ahead < n:
            rest = first_rows_bound(df.where(tied), order_by[1:], n - ahead, slack)
            return until(bound) if rest is None else before(bound) | (tied & rest)
        # the sketch knows no value between; what is left of NaN rows ties
        rest = first_rows_bound(nearer, order_by if ahead < counted[0] else order_by[1:], n, slack)
        return before(bound) if rest is None else before(bound) & rest
    return until(bound)


def capped_scan(
    df: DataFrame,
    order_by: Sequence[str | Column],
    n: int = ITEM_SCAN_CAP,
    groups: int | None = 0,
) -> DataFrame:
    """At most ``n`` rows, the first ``n`` by ``order_by``, names of
    columns (``"c"`` or ``"c DESC"``) or sort expressions.

    The cap is the feature (one scan page).  Without an order a capped read is
    not reproducible, so the order is required.

    A plain ``orderBy().limit(n)`` merges the top ``n`` of *every* scan task in
    one task (n x tasks rows).  Here a bound on the order columns is found
    first (:func:`first_rows_bound`, a few aggregates) and goes down to the
    scan, so that all tasks together pass about ``n`` rows on: one plan for
    every ``n``.  The result is the exact global top ``n``.  ``df`` is read
    once for each aggregate: stage one that is costly.  A sort expression in
    first place has no bound.

    ``groups``: instead reduce the scan tasks in that many buckets with a window
    top-n each (up to ``spark.sql.optimizer.windowGroupLimitThreshold`` rows);
    None: always plan the one-level TakeOrderedAndProject.
    """
    if not order_by:
        raise ValueError("a capped scan needs an explicit order")
    order = [_order(o) for o in order_by]
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if groups == 0:
        bound = first_rows_bound(df, order_by, n)
        df = df if bound is None else df.where(bound)
    elif groups and n <= limit:
        bucket = F.pmod(F.spark_partition_id(), F.lit(groups))
        w = Window.partitionBy("__bucket").orderBy(*order)
        df = (
            df.withColumn("__bucket", bucket)
            .withColumn("__rn", F.row_number().over(w))
            .where(F.col("__rn") <= n)
            .drop("__bucket", "__rn")
        )
    return df.orderBy(*order).limit(n)


def preview(df: DataFrame, order_by: Sequence[str | Column], n: int = 5) -> DataFrame:
    """L2: the first rows, without first pulling the whole table to the driver."""
    return capped_scan(df, order_by, n, groups=None)


def schema_report(df: DataFrame) -> DataFrame:
    """L3: (position, column_name, data_type, nullable, null_count) per column.

    Names and types come from the schema; the null counts come from one
    global aggregate (partial counts per task), unpivoted with ``stack``.
    """
    fields = df.schema.fields
    counts = df.agg(
        *[F.sum(F.col(f.name).isNull().cast("long")).alias(f"__n{i}") for i, f in enumerate(fields)]
    )
    args = []
    for i, f in enumerate(fields):
        args += [
            F.lit(i),
            F.lit(f.name),
            F.lit(f.dataType.simpleString()),
            F.lit(bool(f.nullable)),
            F.coalesce(F.col(f"__n{i}"), F.lit(0).cast("long")),
        ]
    stacked = counts.select(F.stack(F.lit(len(fields)), *args))
    return stacked.toDF("position", "column_name", "data_type", "nullable", "null_count")
