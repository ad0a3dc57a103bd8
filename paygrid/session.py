"""SparkSession settings and the shared scratch folder.

The job relies on Catalyst/AQE for join strategy and partition sizing, so the
session enables adaptive execution (runtime broadcast of small join sides,
partition coalescing, skew-join splitting) instead of hand-scheduling.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "paygrid",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or fetch) a session with the settings the job expects."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(expected_shuffle_bytes: int, cores: int,
                 partition_bytes: int = 128 * 1024 ** 2) -> dict[str, str]:
    """Settings for a large cluster run, sized from the expected largest shuffle.

    AQE starts from enough partitions that none exceeds ``partition_bytes``
    (at least 3 per core) and coalesces the rest at runtime; the same size is
    the split size for file scans and the target for skew-join splitting.
    """
    initial = max(3 * cores, -(-expected_shuffle_bytes // partition_bytes))
    size = str(partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        # Coalesce to the target size rather than to maximum parallelism:
        # fewer, fuller tasks on a busy cluster (Spark's own recommendation).
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for staged tables and checkpoints.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared
    file system).  Only when the session leaves it unset (local tests) do we
    create a private folder and register it, so ``DataFrame.checkpoint`` and
    staged writes land in the same place.
    """
    sc = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if not configured:
        if not sc.master.startswith("local"):
            # A driver-local folder is invisible to executors on a cluster.
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a shared folder (HDFS/S3/...) "
                               "for staged tables and checkpoints")
        configured = tempfile.mkdtemp(prefix="paygrid-scratch-")
        try:
            spark.conf.set(CHECKPOINT_CONF, configured)
        except Exception:  # a session may refuse runtime changes of core settings
            pass
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-path of the shared scratch folder."""
    root = scratch_root(spark)
    sep = "" if root.endswith("/") else "/"
    return f"{root}{sep}{name}-{uuid.uuid4().hex[:12]}"
