"""Materialise a frame under the shared work folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import work_dir


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder below ``spark.checkpoint.dir``; read it back.

    Two effects: the lineage is cut (a lost executor recomputes from the
    written files, not from the sources), and the planner sees the real size
    of ``df``.  A join against a staged frame is then planned as a broadcast
    hash join only when the written files are under
    ``spark.sql.autoBroadcastJoinThreshold``, and as a sort-merge join
    otherwise — decided before any other input is shuffled.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)
