"""Session and checkpoint helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Defaults for sessions this package builds itself (tests, bench).  Library
# functions never change the conf of a session they are handed.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # no broadcast from file-size estimates: only sides measured by
    # operators.joins.checked_broadcast, or by AQE from real shuffle sizes
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoints written by the jobs (silhouette, degree table) are removed
    # once their DataFrames are gone, so the shared folder does not fill up
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int | None = None,
                  app: str = "tessera", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(_DEFAULTS)
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
    """Use the cluster's ``spark.checkpoint.dir``; only a local master with no
    setting gets a scratch folder of its own."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns spark.checkpoint.dir
        return spark.conf.get("spark.checkpoint.dir", "")
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; a cluster needs a shared folder")
    path = tempfile.mkdtemp(prefix="tessera-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return path


def cores(spark: SparkSession) -> int:
    """Task slots to fill: ``defaultParallelism`` (classic sessions), else the
    shuffle partition count."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:  # no SparkContext on this client (e.g. Spark Connect)
        return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
