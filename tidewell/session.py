"""Session defaults and the shared scratch area.

Library code never creates a session; callers pass theirs. ``build_session`` is
for tests, the bench and local runs.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.forceDeleteTempCheckpointLocation": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tidewell", extra: dict | None = None) -> SparkSession:
    """A session with AQE (coalesce + skew join) on, ANSI on and the UI off."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app_name)
    conf = dict(_LOCAL_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cpus)
    conf["spark.driver.memory"] = os.environ.get("TIDEWELL_DRIVER_MEMORY", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_WORKSPACES: dict[str, str] = {}


def workspace(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written tables.

    On a cluster this is ``spark.checkpoint.dir`` (a shared file system); without
    it the call fails. Only a local master that names none (tests) gets a temporary
    folder, registered as the checkpoint dir, so ``DataFrame.checkpoint`` works too.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        try:
            base = spark.sparkContext.getCheckpointDir()
        except Exception:  # pragma: no cover - e.g. Spark Connect
            base = None
    if not base:
        base = _LOCAL_WORKSPACES.get(spark.sparkContext.applicationId)
    if not base:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"set spark.checkpoint.dir to a shared folder (master {master})")
        base = tempfile.mkdtemp(prefix="tidewell-ws-")
        _LOCAL_WORKSPACES[spark.sparkContext.applicationId] = base
        try:
            spark.conf.set("spark.checkpoint.dir", base)
        except Exception:  # pragma: no cover - a session that refuses the setting
            pass
        try:
            spark.sparkContext.setCheckpointDir(base)
        except Exception:  # pragma: no cover
            pass
    return base.rstrip("/")


def parallelism(spark: SparkSession) -> int:
    """Cores available to the session's tasks (for spreading iterative fits)."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:  # pragma: no cover - no driver-side context (e.g. Spark Connect)
        return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the workspace (never reused between runs)."""
    return f"{workspace(spark)}/tidewell/{name}-{uuid.uuid4().hex[:12]}"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure ``DataFrame.checkpoint()`` has a reliable, shared target."""
    ws = workspace(spark)
    try:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(f"{ws}/rdd-checkpoints")
    except Exception:  # pragma: no cover
        pass
    return ws
