"""Exact prefix sums over a table too large for one task.

A plain ``SUM() OVER (ORDER BY ...)`` gathers its whole partition into one
task.  Here rows carry two coarse parts of their order, ``zone`` and ``sub``
(hash prefixes, so a bounded number of values).  Sums per (zone, sub) are
combined map-side, accumulated over this small table, and joined back; only
the rows of one (zone, sub) bucket are ever sorted together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ZONE, SUB = "_zone", "_sub"


def prefix_sums(rows: DataFrame, groups: list[str], order: list[str], sums: dict[str, Column], per_group: DataFrame | None = None) -> DataFrame:
    """``rows`` plus, for each ``out: value`` of ``sums``, the sum of the
    (long, non-null) values of all rows before it in its group, in the order
    (zone, sub, *order).

    ``rows`` needs the non-null columns ``_zone`` and ``_sub``; group columns
    must not be NULL.  Rows that tie on the whole order get sums in an
    arbitrary order among themselves.  ``per_group`` has one row per group;
    its columns come along with the bucket offsets, so a group that holds a
    third of all rows is not gathered for them.
    """
    n = {out: f"_v_{out}" for out in sums}
    rows = rows.withColumns({n[out]: value for out, value in sums.items()})
    buckets = rows.groupBy(*groups, ZONE, SUB).agg(*[F.sum(v).alias(v) for v in n.values()])
    zones = buckets.groupBy(*groups, ZONE).agg(*[F.sum(v).alias(v) for v in n.values()])

    before_zone = Window.partitionBy(*groups).orderBy(ZONE).rowsBetween(Window.unboundedPreceding, -1)
    zones = zones.select(*groups, ZONE, *[F.coalesce(F.sum(v).over(before_zone), F.lit(0)).alias(f"_z{v}") for v in n.values()])
    extra = [c for c in per_group.columns if c not in groups] if per_group is not None else []
    if per_group is not None:
        zones = zones.join(per_group, groups)
    before_sub = Window.partitionBy(*groups, ZONE).orderBy(SUB).rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.select(*groups, ZONE, SUB, *[F.coalesce(F.sum(v).over(before_sub), F.lit(0)).alias(f"_b{v}") for v in n.values()])
    offsets = buckets.join(zones, [*groups, ZONE]).select(*groups, ZONE, SUB, *[(F.col(f"_b{v}") + F.col(f"_z{v}")).alias(f"_o{v}") for v in n.values()], *extra)

    inside = Window.partitionBy(*groups, ZONE, SUB).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = rows.join(offsets, [*groups, ZONE, SUB])
    out = out.withColumns({o: F.col(f"_o{v}") + F.coalesce(F.sum(v).over(inside), F.lit(0)) for o, v in n.items()})
    return out.drop(*n.values(), *[f"_o{v}" for v in n.values()])
