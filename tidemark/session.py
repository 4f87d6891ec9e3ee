"""Session helpers.

``local_session`` is for tests and the bench only; library functions take the
caller's session and never change its configuration.

``shared_dir`` returns a folder for intermediate tables (staging, lineage
cuts). On a cluster it must be the shared ``spark.checkpoint.dir`` the
cluster names; a machine-local temporary folder is only created when that
setting is unset *and* the master is local (tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", app: str = "tidemark", shuffle_partitions: int = 8,
                  driver_memory: str = "8g", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    try:
        return spark.sparkContext.master.startswith("local")
    except Exception:  # Spark Connect has no SparkContext
        return False


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session (set one only in local mode)."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        try:
            d = spark.sparkContext.getCheckpointDir()
        except Exception:
            d = None
    if d:
        return d
    if not _is_local(spark):
        raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder for intermediate tables")
    d = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    spark.sparkContext.setCheckpointDir(d)
    spark.conf.set("spark.checkpoint.dir", d)
    return d


def shared_dir(spark: SparkSession, name: str = "") -> str:
    """The path of a fresh, unique sub-folder of the shared checkpoint folder (made by the first write)."""
    base = checkpoint_dir(spark).rstrip("/")
    leaf = f"{name}-{uuid.uuid4().hex[:12]}" if name else uuid.uuid4().hex[:12]
    return f"{base}/tidemark/{leaf}"


def remove_dir(spark: SparkSession, path: str) -> None:
    """Remove a staging folder through the file system that Spark wrote it with."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def cluster_conf(largest_shuffle_bytes: int, *, target_partition_bytes: int = 256 << 20,
                 split_bytes: int = 512 << 20, broadcast_bytes: int = 64 << 20) -> dict[str, str]:
    """Settings for a large cluster, sized from the biggest expected shuffle.

    * ``spark.sql.shuffle.partitions`` = shuffle bytes / target partition size
      (AQE then coalesces small ones and splits skewed ones),
    * file splits of ``split_bytes`` so a scan task reads a bounded slice,
    * AQE skew-join and rebalance splitting on, and a fixed broadcast threshold
      so the planner never broadcasts an unbounded side by itself.
    """
    partitions = max(200, -(-int(largest_shuffle_bytes) // int(target_partition_bytes)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(broadcast_bytes),
        "spark.sql.sources.partitionOverwriteMode": "static",
    }
