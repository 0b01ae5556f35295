"""Session construction and shared-folder helpers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job of this library relies on.  The session time zone fixes
# the calendar columns (order_year/month/day, order_date) derived from
# timestamps; AQE re-plans joins and shuffle partition counts from runtime
# sizes and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Coalesce small shuffles no further than 64k per task, so tiny inputs
    # still spread over the cores (no effect on large shuffles).
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Starting point for a large cluster reading tens of terabytes.  AQE coalesces
# the high initial shuffle partition count down to ``advisoryPartitionSize``
# per task, converts joins whose measured side is small into broadcasts, and
# splits skewed join partitions; decommissioning migrates shuffle blocks off
# executors that are taken away so lost executors do not force recomputation.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
    "spark.stage.maxConsecutiveAttempts": "8",
    "spark.task.maxFailures": "8",
}


def build_session(master: str | None = None, app_name: str = "ledgerline",
                  shuffle_partitions: int | None = None,
                  extra_conf: dict | None = None, cluster: bool = False) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster ``master`` is left to spark-submit and ``cluster=True`` adds
    ``CLUSTER_CONF``; tests pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if cluster:
        conf.update(CLUSTER_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    # getOrCreate may hand back an existing session: pin the settings that
    # change results.
    spark.conf.set("spark.sql.session.timeZone", conf["spark.sql.session.timeZone"])
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a folder every executor can
    reach (HDFS, object store).  Only a local-mode session without it (tests)
    gets a folder under the system temp dir.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder")
        import tempfile
        configured = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder.

    Used for table hand-offs (written tables that cut lineage), round-trip
    writes and streaming logs.  Every call gets a new folder, so concurrent or
    repeated runs never overwrite each other.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/ledgerline/{name}-{uuid.uuid4().hex[:12]}"


def hand_off(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a fresh folder under the shared checkpoint folder and read back.

    Cuts lineage: a lost executor costs only tasks that read the table, and
    every reader sees the same rows.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme (used only by tests that inspect files)."""
    return path[len("file:"):] if path.startswith("file:") else path

