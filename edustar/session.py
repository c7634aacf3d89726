"""Session helpers: a local session for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "edustar",
                  extra: dict | None = None) -> SparkSession:
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         .config("spark.driver.memory", os.environ.get("EDUSTAR_DRIVER_MEMORY", "8g")))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's shared checkpoint folder.

    On a cluster it must be configured (``spark.checkpoint.dir``), since
    checkpoints and materialised layers have to survive executor loss.
    Only a local-mode session without one gets a private temp folder.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS/S3)")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="edustar-ckpt-", dir="/tmp"))
    return sc.getCheckpointDir()


# Target bytes per shuffle partition after compression, and per scan split.
SHUFFLE_PARTITION_BYTES = 200 * 1024 ** 2
SCAN_SPLIT_BYTES = 256 * 1024 ** 2


def cluster_conf(input_bytes: int, shuffle_ratio: float = 0.5) -> dict[str, str]:
    """Session settings sized for ``input_bytes`` of Parquet input on a cluster.

    Shuffle partitions are sized so the largest stage (about ``shuffle_ratio``
    of the input crosses the network: the fact build's enrolment join) gets
    ~200 MB partitions; AQE then coalesces the small stages and splits skewed
    partitions, including behind chained joins (``forceOptimizeSkewedJoin``),
    on top of the explicit hot-key salting. Automatic broadcasts are capped at
    64 MB; the library's own broadcasts are bounded by rows times width. The
    checkpoint folder is not set here: it comes from the cluster
    (``spark.checkpoint.dir`` on shared storage).
    """
    parts = max(200, -(-int(input_bytes * shuffle_ratio) // SHUFFLE_PARTITION_BYTES))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(SHUFFLE_PARTITION_BYTES),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(SCAN_SPLIT_BYTES),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * SHUFFLE_PARTITION_BYTES),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 ** 2),
        "spark.sql.session.timeZone": "UTC",
        # Checkpoints that nothing refers to any more (dense keys, hot-key lists) are removed.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # Tables of one layer are written by concurrent jobs: share the slots
        # between them instead of queueing each behind the first (FIFO).
        "spark.scheduler.mode": "FAIR",
        # Lost executors: retry tasks, and re-launch stragglers elsewhere.
        "spark.task.maxFailures": "8",
        "spark.speculation": "true",
        "spark.decommission.enabled": "true",
        "spark.storage.decommission.shuffleBlocks.enabled": "true",
    }


def object_store_conf(endpoint: str, access_key: str, secret_key: str, path_style: bool = True,
                      ssl: bool = True) -> dict[str, str]:
    """Session settings for an S3-compatible store (pass to ``local_session(extra=...)``
    or the cluster's spark-defaults). Credentials come from the caller."""
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    }
