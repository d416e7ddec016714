"""SparkSession construction and shared settings.

On a cluster the session is created by the platform; ``build_session`` only
fills in settings that are not already set, so cluster-level values (shuffle
partitions, checkpoint folder, broadcast threshold) always win.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every product relies on, applied to the session only where the
# cluster's configuration does not set them. AQE re-plans joins at runtime
# from real shuffle sizes: a join side under the broadcast threshold becomes a
# broadcast join, bigger sides stay sort-merge, and skewed partitions are
# split.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    # Scans read only the pruned columns of each split, so a larger split
    # keeps the task count of a 100 TB scan manageable.
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Fixed at launch: no web UI (no server port), no console progress bars.
LAUNCH_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "memberscope",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the defaults above.

    ``master`` and ``shuffle_partitions`` are for local runs and tests; leave
    them ``None`` under a cluster manager. ``extra`` settings are applied as
    given (launch-time ones such as driver memory only take effect when this
    call starts the JVM).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**LAUNCH_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    cluster = spark.sparkContext.getConf()
    for k, v in DEFAULT_CONF.items():
        if not cluster.contains(k) and k not in (extra or {}):
            spark.conf.set(k, v)
    if shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    _cluster_shuffle_defaults(spark)
    # The checkpoint folder is resolved where it is used (written
    # intermediates, streaming state), so jobs that need none run without it.
    return spark


def _cluster_shuffle_defaults(spark: SparkSession) -> None:
    """On a cluster whose configuration does not size shuffles, start AQE
    with many small shuffle partitions and let it coalesce them to the
    advisory size: big shuffles (order lines) get enough partitions to stay
    in memory, small ones (per-day rows) collapse to a few tasks."""
    sc = spark.sparkContext
    if sc.master.startswith("local"):
        return
    conf = sc.getConf()
    if not conf.contains("spark.sql.shuffle.partitions") and \
            not conf.contains("spark.sql.adaptive.coalescePartitions.initialPartitionNum"):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "8192")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir``, which the cluster sets to a shared
    file system. Only in local mode, when it is unset (tests), a fresh folder
    is made; on a cluster a machine-local folder would not survive the loss
    of that machine, so an unset value is an error there.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: point it at a "
                             "shared folder (HDFS, object store) for this cluster")
        path = tempfile.mkdtemp(prefix="memberscope-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared checkpoint folder for a written intermediate."""
    return os.path.join(checkpoint_dir(spark), name)


def stored_table(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared checkpoint folder and read again: a
    table that any executor can reach, with its lineage cut and its size
    known to the planner."""
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
