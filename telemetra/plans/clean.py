"""The batch clean of a telemetry table as one lazy plan.

Steps, in the order the result depends on:

1. cast readings with ``try_cast`` (P1) — malformed text becomes NULL;
2. drop rows with a NULL key (F1) — may run before the dedup, same result,
   and it shrinks the shuffle;
3. keep the latest row per key (A3) when an ``order_by`` is given — the
   table load is an upsert;
4. drop sparse rows (F2/F3) — must run *after* the dedup: a key whose newest
   row is sparse disappears, an older dense row must not survive;
5. fill NULL/NaN readings with the global means of what is left (A1/A2).

Every step is a DataFrame transformation; the only shuffle is the key
exchange of step 3 plus the tiny partial-aggregate merge of the means.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame

from ..constants import FIXTURE_KEY, READINGS
from ..functions.casts import cast_readings
from ..functions.nulls import half_threshold
from ..operators.keyed import latest_per_key
from ..operators.quality import drop_null_keys, drop_sparse_rows, impute_mean


def sparse_threshold(keys: Sequence[str], readings: Sequence[str], total_columns: int | None = None) -> int:
    """Half of the counted columns (keys + readings), floored.

    ``total_columns`` reproduces a literal column count instead (for a table
    with extra bookkeeping columns the literal rule can never fire).
    """
    return half_threshold(total_columns if total_columns is not None else len(keys) + len(readings))


def clean_telemetry(
    df: DataFrame,
    keys: Sequence[str] = FIXTURE_KEY,
    readings: Sequence[str] = READINGS,
    order_by: Sequence[str | Column] | None = None,
    inclusive: bool = False,
    total_columns: int | None = None,
    on_all_null: str = "error",
    dtype: str = "double",
) -> DataFrame:
    """The cleaned table: no NULL keys, no sparse rows, no gaps.

    ``order_by``: give it when ``df`` may hold several rows per key; the
    latest row per key is kept first (one shuffle on the key).  Leave it out
    for a source already keyed by ``keys`` (an item table or a lake table):
    the plan then has no row shuffle at all.
    """
    out = cast_readings(df, readings, dtype)
    out = drop_null_keys(out, keys)
    if order_by:
        out = latest_per_key(out, keys, order_by, null_safe=False)  # keys are non-NULL here
    threshold = sparse_threshold(keys, readings, total_columns)
    out = drop_sparse_rows(out, readings, threshold, inclusive=inclusive)
    return impute_mean(out, readings, on_all_null=on_all_null)


def run_clean_job(
    table,
    source: DataFrame,
    order_by: Sequence[str | Column],
    readings: Sequence[str] = READINGS,
    inclusive: bool = False,
    total_columns: int | None = None,
    on_all_null: str = "error",
    fused: bool = True,
    reinsert: bool = False,
    marks: Mapping[str, int] | None = None,
) -> str:
    """C1 with a sink: clean ``source`` into the lake ``table``; returns the version.

    ``fused=True`` (the default) writes the one fused plan once.  ``fused=False``
    commits every step the way the deployed job does — load (K1), delete null
    keys (K5), delete sparse rows (K5), upsert the imputed rows (K2) — each a
    partition-scoped copy-on-write commit; the final table is the same.

    ``reinsert=True`` (implies step-by-step) is the notebook's chain: a plain
    insert load (K3, no dedup), the two key deletes, then the imputed rows
    are *appended* (K4) instead of upserted, so every surviving key ends up
    twice — once as stored, once imputed.  Kept for parity; the upsert is the
    canonical form.  ``marks`` are set by the last commit.
    """
    from ..operators.quality import null_key_rows, sparse_rows

    keys = table.keys
    if reinsert:
        table.insert_overwrite(cast_readings(source, readings))
        table.delete(null_key_rows(table.read(), keys))
        threshold = sparse_threshold(keys, readings, total_columns)
        table.delete(sparse_rows(table.read(), readings, threshold, inclusive=inclusive))
        imputed = impute_mean(table.read(), readings, on_all_null=on_all_null)
        return table.insert_append(imputed, marks)
    if fused:
        cleaned = clean_telemetry(
            source, keys, readings, order_by, inclusive, total_columns, on_all_null
        )
        return table.insert_overwrite(cleaned, marks)  # already one row per key
    table.overwrite(cast_readings(source, readings), order_by)
    table.delete(null_key_rows(table.read(), keys))
    threshold = sparse_threshold(keys, readings, total_columns)
    table.delete(sparse_rows(table.read(), readings, threshold, inclusive=inclusive))
    imputed = impute_mean(table.read(), readings, on_all_null=on_all_null)
    return table.upsert(imputed, order_by, marks)
