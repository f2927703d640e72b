"""Null accounting over columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import THRESHOLD_DIVISOR


def non_key_columns(columns: Sequence[str], keys: Iterable[str]) -> list[str]:
    """Every column except the record key."""
    excluded = set(keys)
    return [c for c in columns if c not in excluded]


def null_count(columns: Iterable[str]) -> Column:
    """Number of NULL values among ``columns`` in the row (NaN is not NULL)."""
    terms = [F.col(c).isNull().cast("int") for c in columns]
    if not terms:
        return F.lit(0)
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total


def half_threshold(n_columns: int) -> int:
    """P10: half the column count, floored."""
    return n_columns // THRESHOLD_DIVISOR
