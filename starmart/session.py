"""Session construction and the shared scratch/lake location.

The lake root is taken from ``spark.checkpoint.dir`` – the shared folder a
cluster names for lineage cuts – so that every table written by a query or a
pipeline run lands on storage all executors can see.  Only when the setting is
absent (unit tests, a bare local session) do we create a private folder and
register it as the checkpoint dir.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Session settings the library relies on.  Sizes are tuned for a cluster; AQE
# re-plans joins (broadcast when the runtime size is small, skew-split when a
# key is hot) and coalesces shuffle partitions from measured map output.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128MB",
    # rows of this much compressed shuffle data unpack to several times as much
    # and still sort in a task's memory; 128 MB spilled
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32MB",
    "spark.sql.files.maxPartitionBytes": "128MB",
    # Static (statistics-based) broadcast threshold: Catalyst broadcasts a join
    # side only when its estimated size is below this, otherwise it plans a
    # sort-merge join.  AQE applies the same check on measured sizes.
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    # Estimates start from file sizes; zstd Parquet of ids and names takes several
    # times as much in memory, in the driver as well.
    "spark.sql.sources.fileCompressionFactor": "3.0",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app_name: str = "starmart",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    # remove checkpoint files once their DataFrame is garbage-collected
    conf["spark.cleaner.referenceTracking.cleanCheckpoints"] = "true"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable defaults to an existing session (e.g. the
    driver's).  Static settings are left alone."""
    for k, v in DEFAULT_CONF.items():
        if spark.conf.isModifiable(k):
            spark.conf.set(k, v)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a private one only when
    the session names none (tests)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="starmart-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_root(spark: SparkSession) -> str:
    """Folder next to the checkpoints where the library writes its tables."""
    ckpt = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return ckpt.rstrip("/") + "/starmart"


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared root (one per run)."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete scratch folders that nothing reads any more."""
    for path in paths:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Shuffle files of the actions inside go when the action ends, not when the
    driver next happens to collect its garbage: for writes, whose result is read
    from its files.  (A frame that is executed again shuffles again.)"""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for local-filesystem helpers."""
    return path[len("file:"):] if path.startswith("file:") else path
