"""Session and shared-storage helpers.

On a cluster, ``spark.checkpoint.dir`` names a shared folder (HDFS / object
store).  We read it from the session and only fall back to a local temporary
folder when the master is ``local[...]`` (tests, laptop runs).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Settings for a large cluster reading ~100 TB (``get_session`` applies them unless
# the master is local; ``cluster_conf()`` does it for a builder of your own):
# many initial shuffle partitions that AQE coalesces to ~256 MB each, 256 MB
# file splits, skew-join splitting for partitions 5x the median and > 512 MB,
# and a broadcast threshold well under executor memory (AQE still decides
# from measured sizes).
CLUSTER_CONF = {
    **DEFAULT_CONF,
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.parquet.filterPushdown": "true",
}


def cluster_conf(builder):
    """Apply ``CLUSTER_CONF`` to a ``SparkSession.Builder`` (the cluster must
    also provide ``spark.checkpoint.dir`` on shared storage)."""
    for k, v in CLUSTER_CONF.items():
        builder = builder.config(k, v)
    return builder


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "tradecast") -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off; on a cluster also
    with ``CLUSTER_CONF``."""
    master = master or os.environ.get("TRADECAST_MASTER", "local[8]")
    b = SparkSession.builder.master(master).appName(app)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if not (master == "local" or master.startswith("local[")):
        b = cluster_conf(b)
    b = b.config("spark.driver.memory", os.environ.get("TRADECAST_DRIVER_MEM", "16g"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting it from the session conf.

    Only a local-mode session may get a machine-local temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if not _is_local(spark):
        raise RuntimeError("spark.checkpoint.dir is not set; a cluster run needs a shared folder")
    local = tempfile.mkdtemp(prefix="tradecast-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


#: Rows of the largest table for each shuffle partition that AQE begins with.
SHUFFLE_ROWS = 250_000


def shuffle_for(spark: SparkSession, rows: int) -> None:
    """Lets the shuffles of the session begin with more partitions where ``rows``
    need them: a fixed number of partitions gives a task a share that grows with
    the tables, until it spills.  AQE merges those that are small, so little
    queries keep their few tasks; a session with more partitions keeps them."""
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    now = spark.conf.get(name, None) or spark.conf.get("spark.sql.shuffle.partitions")
    if -(-rows // SHUFFLE_ROWS) > int(now):
        spark.conf.set(name, str(-(-rows // SHUFFLE_ROWS)))


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for written tables, inside the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tradecast-tables/{name}-{uuid.uuid4().hex[:12]}"
