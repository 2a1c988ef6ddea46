"""Spark session and shared-storage helpers.

Everything the library writes (stream sinks, checkpoints, materialised
dimensions) goes below ONE shared directory: the one the cluster names in
``spark.checkpoint.dir``.  We only invent a directory when the setting is
missing and Spark runs in local mode (tests, benches); on a cluster a missing
setting is an error, because a machine-local folder would not survive the loss
of an executor.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.errors import PySparkNotImplementedError
from pyspark.sql import SparkSession

#: what a session without a SparkContext (Spark Connect) raises
_NO_CONTEXT = (AttributeError, PySparkNotImplementedError)

# Spark settings the pipeline relies on.  Shuffle partitions stay the AQE
# *initial* number: AQE coalesces small partitions at runtime and splits skewed
# ones, so the same value is safe from sf0.001 to 100 TB (raise it on a big
# cluster so one initial partition stays ~128-256 MB).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.streaming.schemaInference": "false",
    # dedup state lives off-heap in RocksDB (bounded by the watermark, but
    # large at high event rates); changelog checkpoints keep commits small
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

#: where streams keep their state in a session that names no provider: Spark's default is a map on the executors'
#: heap, which grows with the backlog.  In RocksDB it lies on disk.  A commit writes a snapshot, as that empties the
#: write buffers (with changelogs those of all idle partitions stay full), so the bound on its memory holds
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
STATE_CONF = {
    PROVIDER: DEFAULT_CONF[PROVIDER],
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
}


@contextlib.contextmanager
def state_on_disk(spark: SparkSession):
    """Streams started within the block keep their state by STATE_CONF, unless
    the session names a provider; of what else it sets, nothing is changed."""
    own = [] if spark.conf.get(PROVIDER, None) else [k for k in STATE_CONF if spark.conf.get(k, None) is None]
    for key in own:
        spark.conf.set(key, STATE_CONF[key])
    try:
        yield
    finally:
        for key in own:
            spark.conf.unset(key)


def build_session(master: str = "local[8]", app: str = "shelfwise",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the pipeline's settings."""
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("SHELFWISE_DRIVER_MEMORY", "4g")
    if extra:
        conf.update(extra)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    try:
        return spark.sparkContext.master.startswith("local")
    except _NO_CONTEXT:
        return (spark.conf.get("spark.master", "") or "").startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Falls back to a fresh folder under the system temp dir only in local mode,
    and then registers it so later ``checkpoint()`` calls use it too.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir.rstrip("/")
    try:
        current = spark.sparkContext.getCheckpointDir()
    except _NO_CONTEXT:
        current = None
    if current:
        # setCheckpointDir appends a per-application UUID folder; use its parent
        return os.path.dirname(current.rstrip("/"))
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage "
            "(HDFS/S3/ABFS) before running the pipeline on a cluster")
    base = tempfile.mkdtemp(prefix="shelfwise-")
    try:
        spark.sparkContext.setCheckpointDir(base)
    except _NO_CONTEXT:  # the runtime setting is all we have
        pass
    spark.conf.set("spark.checkpoint.dir", base)
    return base


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared directory for one run."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint()`` write to the shared folder."""
    base = shared_dir(spark)
    try:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(base)
    except _NO_CONTEXT:
        pass
