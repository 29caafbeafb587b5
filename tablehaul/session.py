"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every tablehaul job relies on. Time values are compared across
# engines, so the session zone is pinned to UTC; AQE re-plans joins and
# shuffle sizes from runtime statistics.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.timeType.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def get_session(master: str | None = None, app_name: str = "tablehaul",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a SparkSession with the tablehaul defaults.

    On a cluster, pass ``master=None`` and let spark-submit decide; locally
    ``local[N]`` with shuffle partitions sized to the cores.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if master and master.startswith("local"):
        # local mode: the driver JVM is the whole cluster
        conf["spark.driver.memory"] = "8g"
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    On a cluster the folder must be set by whoever submits the job (shared
    storage every executor can reach). Only a local-mode session without the
    setting gets a fresh private folder, as in tests.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    configured = current or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if not current:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", sc.master):  # one JVM; a local cluster has several
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a shared folder (HDFS/S3/…) "
            "that every executor can reach")
    path = tempfile.mkdtemp(prefix="tablehaul-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    tail = list(parts)
    if unique:
        tail.append(uuid.uuid4().hex[:12])
    return "/".join([base.rstrip("/"), "tablehaul", *tail])
