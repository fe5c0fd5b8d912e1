"""Session construction and shared-folder helpers.

The session settings that the marts rely on:

* ANSI mode on (Spark 4 default) - bad casts raise, so dirty text goes through ``try_cast``.
* ``partitionOverwriteMode=dynamic`` - rewriting one snapshot never wipes the others.
* AQE on, with partition coalescing and skew-join splitting, so join strategy and reducer
  counts are picked at run time from real sizes.
* UTC session time zone, so date truncation does not depend on the host.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a chain of joins on one key set shares a partitioning; split its hot keys all the same
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # a finished execution's shuffle files are never read again: free their disk at once
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Sizing for a large cluster (~1000 executors, ~100 TB scans).  Input splits of 256 MB keep the
# scan task count in the hundreds of thousands; shuffles start wide (AQE coalesces them back to
# ~256 MB reducers) so no reducer of a big join or aggregation has to spill gigabytes; a
# partition 5x the median and above 1 GB counts as skewed and is split.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.parquet.compression.codec": "zstd",
}


def get_session(master: str | None = None, app_name: str = "sparkmart",
                conf: dict[str, str] | None = None, profile: str = "local") -> SparkSession:
    """Build (or reuse) a session with the mart defaults; ``conf`` overrides them.

    ``profile="cluster"`` adds ``CLUSTER_CONF`` (sizing for the 100 TB target).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    base = {**DEFAULT_CONF, **(CLUSTER_CONF if profile == "cluster" else {})}
    for key, value in {**base, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Set the SQL settings the marts need on an existing session (idempotent)."""
    for key, value in DEFAULT_CONF.items():
        if key.startswith("spark.sql."):
            try:
                spark.conf.set(key, value)
            except Exception:  # static conf on a shared session: leave as is
                pass


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for lineage cuts and scratch tables.

    Read from ``spark.checkpoint.dir``.  Only when the session has none (local tests) is a
    fresh local folder created and registered, so the same code path works on both.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: a cluster needs a shared folder for "
                               "checkpoints and scratch tables")
        path = tempfile.mkdtemp(prefix="sparkmart-ckpt-")  # local mode only (tests, laptop runs)
        spark.sparkContext.setCheckpointDir(path)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared folder (never a machine-local temp dir)."""
    return os.path.join(shared_dir(spark), "sparkmart-scratch", f"{name}-{uuid.uuid4().hex[:12]}")
