"""Session helpers: a local session for tests/bench and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", app: str = "contrail") -> SparkSession:
    """Session for tests and the bench. On a cluster, build your own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """Shared folder for materialised intermediate tables.

    Uses the cluster's ``spark.checkpoint.dir`` (or the context's checkpoint
    dir). When neither is set, a local session gets a fresh temp folder as its
    checkpoint dir; any other raises, as executors don't share the driver's folders.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no context; local folder only for local runs
        sc = None
    d = sc.getCheckpointDir() if sc is not None else None
    if not d:
        if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="contrail-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(d)
            d = sc.getCheckpointDir() or d
    return d


def app_id(spark: SparkSession) -> str:
    """Identifier of the running application (keys per-session caches)."""
    return spark.conf.get("spark.app.id", None) or str(id(spark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared work folder."""
    base = work_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"

