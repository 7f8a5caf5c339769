"""Session settings and the shared work folder.

Operators never build their own session; they take the caller's. The helpers
here are for tests, the bench and jobs launched from this package.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale. AQE re-plans joins from runtime sizes, splits
# skewed shuffle partitions and coalesces small ones; broadcast stays behind
# Spark's own size estimate (autoBroadcastJoinThreshold), never forced for
# tables that grow with the data.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "perkflow") -> SparkSession:
    """Local session for tests and the bench (one JVM, `cores` task threads)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("PERKFLOW_DRIVER_MEMORY", "8g"))
    )
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def cluster_conf(total_cores: int, partition_bytes: str = "256m") -> dict[str, str]:
    """Suggested settings for a large cluster (pass with --conf to spark-submit).

    Shuffles start with 4 partitions per core and AQE merges them down to
    ``partition_bytes``; input splits are the same size; skewed join
    partitions are split once they are 5x the median and over 1 GB; the
    streaming state store (current-state job) lives in RocksDB, not on the
    JVM heap.
    """
    return {
        **SCALE_CONF,
        "spark.sql.shuffle.partitions": str(max(4 * total_cores, 200)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": partition_bytes,
        "spark.sql.files.maxPartitionBytes": partition_bytes,
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared file system folder and is used
    as is; if it is unset there, this fails instead of guessing, because a
    machine-local folder is not visible to the executors. Only a local master
    (tests, single-machine runs) gets a fresh folder under the temp dir.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not d:
        d = _fallback_dir(spark.sparkContext.master)
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def _fallback_dir(master: str) -> str:
    """A temp folder for local masters only; a cluster must name a shared one."""
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: point it at a shared folder (HDFS, object store) "
            "for checkpoints, stream state and intermediate tables"
        )
    return tempfile.mkdtemp(prefix="perkflow-ckpt-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint dir."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
