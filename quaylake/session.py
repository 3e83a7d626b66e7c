"""Session settings and shared storage locations.

On a cluster the session is created by the launcher and already carries its
own settings; `tune` only fills in what is unset.  Tests and the bench call
`local_session`, which pins the values needed for reproducible results
(UTC clock, small shuffle width, no UI).
"""

from __future__ import annotations

import os
import tempfile

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# Settings every job relies on.  AQE re-plans joins from real shuffle sizes
# (sort-merge -> broadcast when a side turns out small, split of skewed
# partitions) and coalesces small shuffle partitions.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Dimensions are broadcast from their measured shuffle size, never before.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64m",
    # What one task sorts or hashes: shuffled bytes are compressed and take 10 to 50 times as
    # much memory.  Shuffles begin with PARTITIONS parts, of which AQE joins small ones, so a
    # task's share stays the same while the input grows.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # What one task reads, compressed as well, and may have to sort.
    "spark.sql.files.maxPartitionBytes": "8m",
    # Staged and stored tables: about a third smaller than with snappy.
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
}
PARTITIONS = 1000


def tune(spark: SparkSession) -> SparkSession:
    """Apply DEFAULTS where the session has no value of its own."""
    parts = max(PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    for key, value in (DEFAULTS | {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts)}).items():
        if spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "quaylake") -> SparkSession:
    """Local session for tests and the bench (single JVM, no UI)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if not (SparkContext._active_spark_context or SparkConf().get("spark.checkpoint.dir", None)):
        # A session's checkpoint folder cannot be set once it runs.
        builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(
            prefix="quaylake-ckpt-", dir=os.environ.get("TMPDIR", "/tmp")))
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Root of shared storage for checkpoints, staging tables and stream state.

    Read from ``spark.checkpoint.dir`` as the cluster sets it.  Only when the
    setting is missing on a local master (tests) is a fresh temporary folder
    taken as the context's checkpoint folder, where every later call finds it.
    """
    sc = spark.sparkContext
    current = (spark.conf.get("spark.checkpoint.dir", None)
               or sc.getConf().get("spark.checkpoint.dir", None))
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if not sc.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all workers share")
    local = tempfile.mkdtemp(prefix="quaylake-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared folder (never a machine-local one on a cluster)."""
    return "/".join([shared_dir(spark).rstrip("/"), *parts])
