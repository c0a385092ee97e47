"""Session helpers: a UTC, ANSI-on session and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


# Settings for a large cluster (hundreds of executors, tens of TB per job):
# start with many shuffle partitions and let AQE coalesce them to ~256 MB,
# read ~256 MB splits, split skewed join/rebalance partitions, and keep
# broadcasts to checked small sides (our own checks; the planner's automatic
# threshold stays at its conservative default).
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def get_session(app_name: str = "tidemark", master: str | None = None, cpus: int | None = None,
                shuffle_partitions: int | None = None, profile: str | None = None) -> SparkSession:
    """Create (or return) a session with the settings every job here assumes.

    Session zone UTC (all ``retrieved_at`` values are UTC wall clock), ANSI on
    (untrusted text goes through ``try_*`` functions), AQE with partition
    coalescing and skew-join splitting on. ``master`` is only set when given,
    so on a cluster the launcher's master wins. ``profile="cluster"`` adds
    :data:`CLUSTER_CONF` (partition sizing for very large inputs).
    """
    builder = SparkSession.builder.appName(app_name)
    if master is None and cpus is not None:
        master = f"local[{cpus}]"
    if master is not None:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # drop reliable-checkpoint files once their DataFrame is garbage collected
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if profile == "cluster":
        conf.update(CLUSTER_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def _is_local(spark: SparkSession) -> bool:
    # local-cluster[...] runs executors of its own and counts as a cluster
    return spark.sparkContext.master.split("[")[0] == "local"


def work_dir(spark: SparkSession, *parts: str) -> str:
    """A folder under the cluster's shared ``spark.checkpoint.dir``.

    The setting is read from the session. Only when it is unset *and* the
    session is local (tests) do we pick a scratch folder and set it; on a
    cluster an unset value is an error, because a machine-local folder is
    not visible to other executors and does not survive their loss.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder (HDFS/S3/ABFS)")
        base = tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(base)
    path = "/".join([base.rstrip("/"), "tidemark", *parts])
    return path


def fresh_dir(spark: SparkSession, *parts: str) -> str:
    """A new, unique folder under :func:`work_dir` (one per run)."""
    return work_dir(spark, *parts, uuid.uuid4().hex[:12])


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint()`` usable (reads or, in tests, sets the dir)."""
    if spark.sparkContext.getCheckpointDir() is None:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if base:
            spark.sparkContext.setCheckpointDir(base)
        else:
            work_dir(spark)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for Python-side checks in tests."""
    return path[5:] if path.startswith("file:") else path


__all__ = ["get_session", "work_dir", "fresh_dir", "ensure_checkpoint_dir", "local_path"]
