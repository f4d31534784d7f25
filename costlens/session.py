"""Session settings shared by tests, the bench and the cluster entry points."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every costlens job relies on: UTC dates/minute truncation, ANSI
# arithmetic, adaptive execution (coalescing, skew-join splitting, runtime
# broadcast conversion).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Suggested settings for a large cluster (1000 executors, ~100 TB input).
# Shuffle partitions start high and adaptive execution coalesces them to
# ~256 MB; skewed partitions above 5x the median and 512 MB are split.
# Broadcasts: none is chosen from plan-time size *estimates* (which can
# undershoot after generators and aggregates); adaptive execution converts a
# join to a broadcast only when the *measured* output of the finished shuffle
# stage of a side is under 64 MB, and keeps the sort-merge join otherwise.
CLUSTER_CONF = {
    **REQUIRED_CONF,
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    # A scope too large to broadcast goes ahead of its joins as a Bloom filter of at most
    # 8 MB, so that rows of foreign workspaces are not shuffled (see operators/scope.py).
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": str(4 * 1024**3),
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "4000000",
    "spark.sql.optimizer.runtime.bloomFilter.numBits": str(8 * 8 * 1024 * 1024),
}


def apply_required_conf(spark: SparkSession) -> SparkSession:
    """Set the session options costlens needs (time zone UTC, ANSI, AQE)."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def apply_cluster_conf(spark: SparkSession) -> SparkSession:
    """``CLUSTER_CONF`` for every key that the submit command left unset."""
    given = spark.sparkContext.getConf()
    for key, value in CLUSTER_CONF.items():
        if not given.contains(key):
            spark.conf.set(key, value)
    return apply_required_conf(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Outside tests this must be set by the cluster; a machine-local folder is
    only created when the setting is absent (local sessions in tests).
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="costlens-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def local_session(cpus: int | None = None, partitions: int | None = None, app: str = "costlens"):
    """A local session for tests and the bench (UI off, UTC, AQE).

    The test tables are small files, so plan-time broadcasts (from file-size
    estimates) stay on here; ``CLUSTER_CONF`` turns them off for large inputs.
    """
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions or cpus))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
    )
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(checkpoint_dir(spark))
    return spark
