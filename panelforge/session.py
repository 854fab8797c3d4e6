"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "panelforge", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session with AQE on and the UI off.

    On a cluster ``master`` stays None and the launcher's settings win;
    locally the shuffle width follows the core count instead of Spark's 200.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    cores = os.cpu_count() or 8
    builder = (
        builder.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master and master.startswith("local"):
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores)).config(
            "spark.driver.memory", "16g"
        )
    elif shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not (master and master.startswith("local")):
        apply_cluster_defaults(spark)
    return spark


# Sizing for a large cluster (hundreds of executors, tens of TB per job):
# many initial shuffle partitions that AQE coalesces to ~256 MB each, scan
# splits of 256 MB, skewed partitions split at 5x the median. Each value is
# applied only when the launcher did not set it.
CLUSTER_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8192",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
}


def apply_cluster_defaults(spark: SparkSession) -> None:
    given = spark.sparkContext.getConf()
    for key, value in CLUSTER_DEFAULTS.items():
        if not given.contains(key):
            spark.conf.set(key, value)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Uses ``spark.checkpoint.dir`` from the session. Only a local master with
    the setting unset (tests, laptops) gets a private folder, removed when the
    process ends; a cluster without the setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; on a cluster it must name a shared folder "
            "(a machine-local folder would not survive executor loss)"
        )
    local = tempfile.mkdtemp(prefix="panelforge-ckpt-")
    atexit.register(shutil.rmtree, local, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)
