"""Session helpers: a local session for tests/bench and the shared work folder.

Every operator that has to materialise something (lake snapshots, stream
checkpoints, exported items) writes below the folder the cluster names in
``spark.checkpoint.dir``.  We only pick our own folder when that setting is
absent *and* the master is local (tests, laptops); on a cluster a missing
setting is an error, never a silent machine-local path.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_ROOT: dict[str, str] = {}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "telemetra") -> SparkSession:
    """Session for tests and the bench: AQE on, UI off, UTC, small shuffles."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def _checkpoint_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    sc = spark.sparkContext
    existing = sc.getCheckpointDir()
    if existing:
        return existing.rstrip("/")
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: telemetra needs a shared folder "
            "for snapshots and stream checkpoints on a cluster"
        )
    key = sc.applicationId
    if key not in _LOCAL_ROOT:
        _LOCAL_ROOT[key] = tempfile.mkdtemp(prefix="telemetra-")
        sc.setCheckpointDir(os.path.join(_LOCAL_ROOT[key], "rdd-checkpoints"))
    return _LOCAL_ROOT[key]


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared work root (not created yet)."""
    return f"{_checkpoint_root(spark)}/telemetra/{name}-{uuid.uuid4().hex[:12]}"
