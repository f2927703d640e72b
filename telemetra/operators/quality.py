"""Data-quality operators: null keys, sparse rows, mean imputation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, IntegralType

from ..functions.nulls import null_count


def _any_null(keys: Sequence[str]) -> Column:
    cond = F.col(keys[0]).isNull()
    for k in keys[1:]:
        cond = cond | F.col(k).isNull()
    return cond


def null_key_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """rows where any key column is NULL (what the cleaner deletes)."""
    return df.where(_any_null(keys))


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Complement of F1; ``isnotnull`` filters push down to the parquet scan."""
    return df.dropna(how="any", subset=list(keys))


def _sparse(measured: Sequence[str], threshold: int, inclusive: bool) -> Column:
    n = null_count(measured)
    return n >= F.lit(threshold) if inclusive else n > F.lit(threshold)


def sparse_rows(df: DataFrame, measured: Sequence[str], threshold: int, inclusive: bool = False) -> DataFrame:
    """F2 (strict ``>``) / F3 (``inclusive`` ``>=``): rows with too many NULL readings."""
    return df.where(_sparse(measured, threshold, inclusive))


def drop_sparse_rows(df: DataFrame, measured: Sequence[str], threshold: int, inclusive: bool = False) -> DataFrame:
    """Complement of F2/F3."""
    return df.where(~_sparse(measured, threshold, inclusive))


def _missing_to_null(c: Column, is_fractional: bool) -> Column:
    # NaN counts as missing for the mean and for imputation, as in the ML Imputer.
    return F.nanvl(c, F.lit(None).cast("double")) if is_fractional else c


def mean_column(c: str) -> str:
    return f"{c}_mean"


#: A double below 2 ** 60 in size is a whole and a 60-bit fraction part, each summed in digits of 20 bits.
_DIGIT, _PART = 20, 60


def exact_mean(c: Column, fractional: bool) -> Column:
    """The mean of ``c`` from whole-number partial sums.

    Sums of doubles depend on the order of their terms, so means differ in
    their last bits from one partitioning to the next.  Here the part of a
    value before the point and its first 60 bits behind it become two longs
    (both exact: cutting off, the difference and scaling by a power of two
    are), and their base 2 ** 20 digits are summed as longs, which hold 2 ** 43
    rows.  What lies below 2 ** -60 is cut off, value by value.  Values of
    2 ** 60 and more are summed as doubles.
    """
    if not fractional:
        return F.sum(c.cast("decimal(38,0)")).cast("double") / F.count(c).cast("double")
    fits = F.abs(c) < F.lit(2.0**_PART)
    value = F.when(fits, c).cast("double")
    whole = value.cast("long")
    fraction = ((value - whole.cast("double")) * F.lit(2.0**_PART)).cast("long")
    total = F.coalesce(F.sum(F.when(~fits, c)), F.lit(0.0))
    for part, scale in ((whole, 0), (fraction, -_PART)):
        for low in range(_PART - _DIGIT, -1, -_DIGIT):
            digit = F.shiftright(part, low)  # of a negative part, too: floors of it, and what they leave
            if low < _PART - _DIGIT:
                digit = digit.bitwiseAND(F.lit((1 << _DIGIT) - 1))
            total = total + F.coalesce(F.sum(digit), F.lit(0)).cast("double") * F.lit(2.0 ** (low + scale))
    n = F.count(c)
    return F.when(n > 0, total / n.cast("double"))


def column_means(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """A1: one row of global means ignoring NULL and NaN.

    A global aggregate: each task folds its rows into partial sums and counts
    and only those partials are exchanged, so the cost is one scan and a tiny
    single-partition final merge, whatever the data size.  With ``exact`` the
    means have the same bits however the rows are dealt out
    (:func:`exact_mean`); without it they are Spark's ``avg``.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    aggs = []
    for c in columns:
        fractional = isinstance(types[c], (DoubleType, FloatType))
        value = _missing_to_null(F.col(c), fractional)
        whole = isinstance(types[c], IntegralType)
        aggs.append((exact_mean(value, fractional) if exact and (fractional or whole) else F.avg(value)).alias(mean_column(c)))
    return df.agg(*aggs)


def impute_mean(
    df: DataFrame,
    columns: Sequence[str],
    on_all_null: str = "error",
    means: DataFrame | None = None,
) -> DataFrame:
    """A2: NULL/NaN readings -> column mean, column type and all other columns kept.

    Each mean is a scalar subquery over the one-row aggregate; Spark merges
    them into one aggregation, runs it once and inlines the values, so the
    rows of ``df`` are only projected — no join, no shuffle of ``df``.  A
    ``means`` frame with more than one row fails instead of multiplying rows.

    ``on_all_null``: ``"error"`` raises when a column has no value to average
    but some row needs one (the ML Imputer's behaviour); ``"keep"`` leaves it
    NULL.
    """
    if on_all_null not in ("error", "keep"):
        raise ValueError("on_all_null must be 'error' or 'keep'")
    types = {f.name: f.dataType for f in df.schema.fields}
    means = column_means(df, columns) if means is None else means
    out = []
    for c in df.columns:
        if c not in columns:
            out.append(F.col(c))
            continue
        frac = isinstance(types[c], (DoubleType, FloatType))
        value = _missing_to_null(F.col(c), frac)
        mean = means.select(mean_column(c)).scalar()
        filled = F.coalesce(value, mean)
        if on_all_null == "error":
            filled = F.when(
                value.isNull() & mean.isNull(),
                F.raise_error(F.lit(f"cannot impute {c}: the column has no non-missing value")),
            ).otherwise(filled)
        out.append(filled.cast(types[c]).alias(c))
    return df.select(*out)
