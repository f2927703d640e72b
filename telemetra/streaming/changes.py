"""Change-driven refresh (F5 in a stream, C3).

Change notifications arrive as JSON lines.  A stream with
``trigger(availableNow=True)`` drains them, keeps those matching the event
pattern (F5) and records them per micro-batch under ``<matches>/batch_id=n``
(overwrite: replay-safe).  If anything matched since the last run, the
refresh job runs once — the checkpoint makes sure a notification triggers at
most one refresh.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.evaluation import where_once
from ..functions.predicates import event_pattern
from ..sources.fixtures import CHANGE_EVENT_SCHEMA


def change_stream(spark: SparkSession, source_dir: str, schema: str = CHANGE_EVENT_SCHEMA) -> DataFrame:
    raw = spark.readStream.format("text").load(source_dir)
    return raw.select(F.from_json("value", schema).alias("e")).select("e.*")


def drain_matches(
    spark: SparkSession,
    source_dir: str,
    pattern: Mapping[str, object],
    matches_dir: str,
    checkpoint_dir: str,
) -> None:
    """Run the matcher over everything not yet seen, then stop."""
    matched = where_once(change_stream(spark, source_dir), event_pattern(pattern))

    def record(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{matches_dir}/batch_id={batch_id}")

    q = (
        matched.writeStream.foreachBatch(record)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()


def last_batch(spark: SparkSession, folder: str, schema: str) -> int:
    """The largest batch recorded below ``folder``, -1 before the first one."""
    try:
        batches = spark.read.schema(f"{schema}, batch_id bigint").parquet(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return -1
    found = batches.agg(F.max("batch_id")).first()[0]
    return -1 if found is None else found


def refresh_on_change(
    spark: SparkSession,
    source_dir: str,
    pattern: Mapping[str, object],
    matches_dir: str,
    checkpoint_dir: str,
    job: Callable[[], DataFrame],
    after_batch: int = -1,
) -> DataFrame | None:
    """Drain change events; when new ones matched, run ``job`` once and return its result.

    The last batch refreshed is recorded beside the matches after ``job``
    returned, so later calls run it again only for later matches.
    """
    drain_matches(spark, source_dir, pattern, matches_dir, checkpoint_dir)
    refreshed_dir = matches_dir.rstrip("/") + "_refreshed"
    latest = last_batch(spark, matches_dir, CHANGE_EVENT_SCHEMA)
    if latest <= max(after_batch, last_batch(spark, refreshed_dir, "done boolean")):
        return None
    out = job()
    spark.range(1).select(F.lit(True).alias("done")).write.mode("overwrite").parquet(f"{refreshed_dir}/batch_id={latest}")
    return out


def refresh_table_on_change(
    table,
    source_dir: str,
    pattern: Mapping[str, object],
    matches_dir: str,
    checkpoint_dir: str,
    job: Callable[[dict[str, int]], object],
    mark: str = "changes",
) -> bool:
    """C3 into a lake table: drain change events; when new ones matched, run
    ``job(marks)`` once.  Returns whether it ran.

    ``job`` passes ``marks`` to its last commit to ``table``.  The last batch
    refreshed is thereby known exactly when its rows are: a crash before that
    commit leaves the events to be served, one after it does not repeat them.
    """
    spark = table.spark
    drain_matches(spark, source_dir, pattern, matches_dir, checkpoint_dir)
    latest = last_batch(spark, matches_dir, CHANGE_EVENT_SCHEMA)
    if latest <= table.mark(mark):
        return False
    job({mark: latest})
    if table.mark(mark) != latest:
        raise RuntimeError("the refresh has not committed its marks")
    return True
