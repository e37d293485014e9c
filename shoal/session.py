"""Session construction and scratch locations.

The library never hard-codes where intermediate data lives: on a cluster the
shared folder named by ``spark.checkpoint.dir`` is used; a private one is made
only when the session has none (local runs and tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "shoal",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session with the settings every job here assumes.

    AQE re-plans joins at runtime (broadcast when a side turns out small, split
    skewed partitions, coalesce tiny shuffle partitions). ``shuffle_partitions``
    is the *upper* bound AQE coalesces from; on a cluster leave it to the
    deployment (``None``).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from the session (``spark.checkpoint.dir`` or an already set
    checkpoint directory). Only when neither is set *and* the master is local
    (local runs, tests) is a private folder created and registered; on a
    cluster a missing setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not conf_dir:
        if not sc.master.startswith("local"):
            # a machine-local folder is invisible to other executors and lost with them
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, object store)")
        conf_dir = tempfile.mkdtemp(prefix="shoal-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused location under the checkpoint root."""
    return f"{checkpoint_root(spark).rstrip('/')}/scratch/{name}-{uuid.uuid4().hex[:12]}"


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 * 1024 * 1024
               ) -> dict[str, str]:
    """Settings sized from the input volume and the cluster's cores.

    The shuffle-partition count is an *upper bound* from which AQE coalesces
    small partitions; it is chosen so that a shuffle of the whole input gives
    partitions of about ``target_partition_bytes`` (fits executor memory, spills
    rarely) and never fewer than two waves of tasks. Scan splits are as large
    as the target; skewed shuffle partitions larger than five times the median
    (and the target) are split by AQE.
    """
    import math

    partitions = max(2 * total_cores, math.ceil(input_bytes / target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    }
