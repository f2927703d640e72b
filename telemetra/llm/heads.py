"""Frequent keys of a table, by mergeable Misra-Gries summaries.

Each task keeps a summary of bounded size over all of its rows; the summaries
are added up by key, and the keys with the largest sums are the head.  A key
with a share of all occurrences above 1 / size is in every head.  Which keys a
head holds must not change a result, only the way it is reached.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.staging import stage

#: Keys of a head, and bytes of them, at most.
SIZE, BYTES = 1 << 17, 8 << 20
#: Keys that a task saw less often are left out of its summary.
LEAST = 3
#: Buckets of counts per doubling, to find where the head ends.
_STEPS = 8

Emit = Callable[[pa.RecordBatch], Iterator[tuple[pa.Array, np.ndarray]]]


class Summary:
    """At most ``size`` keys and ``bytes`` bytes of them, with a lower bound of each one's count."""

    def __init__(self, size: int, limit: int):
        self.size, self.limit, self.pending, self.waiting = size, limit, [], 0

    def add(self, keys: pa.Array, n: np.ndarray) -> None:
        self.pending.append(pa.table([keys, pa.array(n, pa.int64())], names=["key", "n"]))
        self.waiting += len(n)
        if self.waiting > 4 * self.size:
            self.shrink()

    def shrink(self) -> pa.Table | None:
        if not self.pending:
            return None
        t = pa.concat_tables(self.pending).group_by("key").aggregate([("n", "sum")]).rename_columns(["key", "n"])
        if len(t) > self.size:
            n = t["n"].to_numpy()
            cut = int(np.partition(n, len(n) - self.size - 1)[len(n) - self.size - 1])
            t = pa.table([t["key"], pa.array(n - cut)], names=["key", "n"]).filter(pa.array(n > cut))
        if (pc.sum(pc.binary_length(t["key"])).as_py() or 0) > self.limit:
            t = t.sort_by([("n", "descending")])
            t = t.slice(0, int((np.cumsum(pc.binary_length(t["key"]).to_numpy()) <= self.limit).sum()))
        self.pending, self.waiting = [t], len(t)
        return t


def frequent(rows: DataFrame, emit: Emit, size: int = SIZE, limit: int = BYTES, least: int = LEAST) -> DataFrame:
    """Staged (key binary, n): the most frequent keys of ``rows``, at most
    ``size`` of them and ``limit`` bytes in all.  ``emit`` gives the keys of a
    batch and their counts."""

    def summed(batches):
        own = Summary(size, limit)
        for b in batches:
            for keys, n in emit(b):
                own.add(keys, n)
        t = own.shrink()
        if t is not None:
            yield from t.filter(pc.greater_equal(t["n"], least)).combine_chunks().to_batches(max_chunksize=10_000)

    sums = stage(rows.mapInArrow(summed, "key binary, n long").groupBy("key").agg(F.sum("n").alias("n")), "heads")
    step = F.floor(F.log2(F.col("n").cast("double")) * _STEPS).cast("int")
    sizes = sums.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("k"), F.sum(F.octet_length("key")).alias("b")).collect()  # at most 64 * _STEPS rows
    least_step, k, b = 64 * _STEPS, 0, 0
    for r in sorted(sizes, key=lambda r: -r.step):
        k, b = k + r.k, b + r.b
        if k > size or b > limit:
            break
        least_step = r.step
    return sums.filter(step >= least_step)
