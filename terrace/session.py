"""SparkSession defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job of the pipeline relies on.  They are only defaults: a
# cluster submit may override any of them.
DEFAULT_CONF = {
    # Timestamps are stored and compared in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce small shuffle partitions, switch a join to
    # broadcast once a side is measured small, split skewed join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128MB",
    # Split a hot key even when that costs an extra shuffle: one task holding
    # a third of the rows is worse than one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Parquet scan split size; partitions stay well inside executor memory.
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app_name: str = "terrace",
                  shuffle_partitions: int | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the pipeline defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names shared storage and is used as is.  Only
    when it is unset (local tests) a private folder is created and recorded
    in the session, so later calls agree.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None) or _LOCAL_DIRS.get(sc.applicationId)
    if not path:
        if not (sc.master or "").startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        path = tempfile.mkdtemp(prefix="terrace-ckpt-")
        _LOCAL_DIRS[sc.applicationId] = path
    sc.setCheckpointDir(path)
    return path


# Folders created for local sessions that had no spark.checkpoint.dir.
_LOCAL_DIRS: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    return os.path.join(checkpoint_dir(spark), name)


def stream_checkpoint(spark: SparkSession, owner: str, name: str) -> str:
    """Checkpoint folder of stream ``name`` feeding the table at ``owner``.

    Scoped by the target path, so two warehouses sharing the cluster's
    checkpoint folder never read each other's progress.
    """
    import hashlib
    tag = hashlib.sha1(owner.rstrip("/").encode()).hexdigest()[:16]
    return os.path.join(checkpoint_dir(spark), "streams", tag, name)
