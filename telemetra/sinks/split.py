"""Good rows and rejects of one parse in one write."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.messages import REASONS

GOOD, OTHER = "good", "other"
_VALID = "__valid"


@dataclass(frozen=True)
class Split:
    """The two outputs and the rows by outcome: ``good``, each reason, and ``other`` for reasons not listed."""

    good: DataFrame
    rejects: DataFrame
    counts: dict[str, int]


def write_split(parsed: DataFrame, path: str, reasons: Sequence[str] = REASONS) -> Split:
    """Write ``parsed`` (with a ``reason``, NULL for good rows) once, split by validity.

    The input is read and parsed a single time: each task writes its good rows
    and its rejects to folders of their own, and the counts are observed on
    the rows as they pass.  Readers of one output open only its folder.
    """
    seen = Observation()
    reason = F.col("reason")
    known = {GOOD: reason.isNull()} | {r: reason == r for r in reasons}
    metrics = [F.count_if(c).alias(name) for name, c in known.items()]
    rows = parsed.withColumn(_VALID, reason.isNull()).observe(seen, F.count(F.lit(1)).alias("__all"), *metrics)
    rows.write.partitionBy(_VALID).parquet(path)
    counts = {name: seen.get[name] for name in known}
    counts[OTHER] = seen.get["__all"] - sum(counts.values())
    written = parsed.sparkSession.read.schema(rows.schema).parquet(path)
    good = written.where(F.col(_VALID)).drop(_VALID, "reason")
    return Split(good, written.where(~F.col(_VALID)).drop(_VALID), counts)
