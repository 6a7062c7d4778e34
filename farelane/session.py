"""Session helpers for tests, the bench and command-line jobs.

On a cluster the session comes from the platform and is used as is; these
helpers only fill in settings that are unset (checkpoint folder, shuffle
partitions for local runs).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the session; a local one is made only for a local master without any."""
    cur = spark.conf.get("spark.checkpoint.dir", None) or context_checkpoint_dir(spark)
    if not cur:
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        cur = tempfile.mkdtemp(prefix="farelane-ckpt-", dir=os.environ.get("FARELANE_SCRATCH", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", cur)
    try:
        spark.sparkContext.setCheckpointDir(str(cur))
    except Exception:  # noqa: BLE001 - sessions without a SparkContext keep the conf value only
        pass
    return str(cur)


def context_checkpoint_dir(spark: SparkSession) -> str | None:
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # noqa: BLE001 - e.g. a Spark Connect session
        return None


def get_spark(master: str | None = None, shuffle_partitions: int | None = None, app: str = "farelane") -> SparkSession:
    """The running session as it is, or a new one; ``shuffle_partitions`` is 8 for a local master unless given."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    builder = SparkSession.builder.appName(app)
    local = master is not None and master.startswith("local")
    if master:
        builder = builder.master(master)
    if local or shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
    if local:
        builder = builder.config("spark.driver.memory", os.environ.get("FARELANE_DRIVER_MEMORY", "8g")).config("spark.ui.showConsoleProgress", "false")
    spark = builder.config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


# settings for large clusters, applied only where the cluster has not set them
SCALE_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
}


def apply_scale_defaults(spark: SparkSession) -> dict[str, str]:
    """Fill in the scale settings the session does not set yet; returns what was set."""
    applied = {}
    for key, value in SCALE_DEFAULTS.items():
        if spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, value)
            applied[key] = value
    return applied
