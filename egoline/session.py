"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on. AQE re-plans joins at runtime (broadcast
# when a side turns out small, split skewed partitions); UTC keeps timestamp
# parsing of the timeline's "...Z" strings independent of the host.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # remove reliable-checkpoint files once their DataFrame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str = "local[*]", app: str = "egoline",
                shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's defaults.

    On a cluster the master and the shuffle partition count come from
    spark-submit; this helper is for tests, the bench and notebooks.
    """
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def cluster_conf(input_bytes: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Settings for a large run, sized from the input volume.

    Shuffle partitions start near ``input / target`` (AQE then coalesces the
    small ones to ``target_partition_bytes`` each), scan splits are the same
    size, a partition counts as skewed once it is 4x the target and 5x the
    median (AQE splits it), and runtime broadcasts are limited to sides AQE
    has measured under 64 MB.
    """
    parts = max(200, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(16 << 20),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.session.timeZone": "UTC",
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder is set by the deployment (a shared file system) and
    a session without it is an error: no folder of the driver's own machine
    could hold what executors write. A local session gets a folder of its own.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="egoline-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


#: Paths handed out by ``shared_path`` in this process.
_SCRATCH: list[str] = []


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path below the shared checkpoint folder (never host-local on a cluster).

    What is written there must outlive the lazy plans that read it; call
    :func:`release_scratch` when their results have been stored.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    _SCRATCH.append("/".join([base, *parts, uuid.uuid4().hex]))
    return _SCRATCH[-1]


def release_scratch(spark: SparkSession) -> int:
    """Delete what this process wrote below ``shared_path``; returns how many paths there were."""
    n = len(_SCRATCH)
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    while _SCRATCH:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        path.getFileSystem(hadoop).delete(path, True)
    return n


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
