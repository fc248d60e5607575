"""Session construction and shared-storage locations."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.partitions": "8",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", app: str = "stockgap", **conf) -> SparkSession:
    """A local session for tests and the bench (cluster jobs bring their own)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in {**LOCAL_DEFAULTS, **conf}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must name shared storage and is used as is; a
    local session (tests, bench) without it gets a folder of its own, once.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="stockgap-ckpt-")
        spark.sparkContext.setCheckpointDir(path)
        path = spark.sparkContext.getCheckpointDir()
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new location for an intermediate table in the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def dense_partitions(pairs: int, days: int, rows_per_task: int = 5_000_000) -> int:
    """Tasks for generating the dense ledger: by its own size (``pairs`` x
    ``days``), not by the size of the sparse rows it is made from."""
    return max(1, -(-pairs * days // rows_per_task))


def cluster_conf(input_bytes: int, executor_cores_total: int) -> dict[str, str]:
    """Settings sized for a cluster run over ``input_bytes`` of fact data.

    Shuffle partitions start at ~256 MB of input each (at least 2 waves of
    the cluster's cores) and AQE coalesces them down at runtime; files are
    split at 256 MB; a partition more than 5x the median and over 512 MB is
    split by the skew-join rule; runtime broadcast only under 64 MB measured.
    """
    mb = 1 << 20
    parts = max(2 * executor_cores_total, input_bytes // (256 * mb))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * mb),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * mb),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * mb),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * mb),
        "spark.sql.shuffle.partitions": str(int(parts)),
        "spark.sql.files.maxPartitionBytes": str(256 * mb),
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    }
