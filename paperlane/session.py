"""Session helpers: one place that fixes the settings every job relies on."""
from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job needs for correct results (UTC calendar days, ANSI-safe
# try_* casts) and for a sane plan (AQE re-plans joins/partition counts at
# runtime; skew join splits hot partitions of sort-merge joins).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Settings for a large cluster (hundreds of executors, ~100 TB inputs). Shuffle
# partitions start high and AQE coalesces them to ~256 MB; skewed partitions
# over 5x the median (and 512 MB) are split; parquet splits are 256 MB so a
# task reads a bounded slice; broadcasts stay under a fixed, measured size.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.task.maxFailures": "8",
    "spark.stage.maxConsecutiveAttempts": "8",
}


def cluster_session(app_name: str = "paperlane", extra_conf: dict | None = None) -> SparkSession:
    """Session for cluster runs: the master and ``spark.checkpoint.dir`` come
    from the submit configuration; :data:`CLUSTER_CONF` sizes partitions and
    skew handling."""
    conf = dict(CLUSTER_CONF)
    conf.update(extra_conf or {})
    spark = build_session(None, app_name, extra_conf=conf)
    ensure_checkpoint_dir(spark)
    return spark


def build_session(master: str | None = None, app_name: str = "paperlane",
                  shuffle_partitions: int | None = None,
                  extra_conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session. Only a local-mode
    session (tests, single-node bench) gets a private folder when it is
    unset; on a cluster an unset folder is a configuration error, because a
    machine-local folder does not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/ABFS)")
        configured = tempfile.mkdtemp(prefix="paperlane-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()
