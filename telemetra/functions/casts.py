"""Tolerant casts for readings."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_number(c: Column, dtype: str = "double") -> Column:
    """Text or number -> ``dtype``; malformed text becomes NULL instead of failing.

    Under ANSI mode a plain ``cast`` raises on ``'zz'``; ``try_cast`` keeps
    the row and lets the null-handling steps decide about it.
    """
    return c.try_cast(dtype)


def cast_readings(df: DataFrame, readings: Iterable[str], dtype: str = "double") -> DataFrame:
    """Cast every reading column in one projection, other columns untouched."""
    readings = set(readings)
    return df.select(
        *[to_number(F.col(c), dtype).alias(c) if c in readings else F.col(c) for c in df.columns]
    )
