"""Session construction and the shared scratch location.

Scratch data (yearly CSV extracts, round-trip sinks, registered tables) always
lives under the folder the cluster names in ``spark.checkpoint.dir`` so every
executor sees it. Only when that setting is absent (a laptop or a unit test) do
we create a local folder and set it on the session.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "policypanel", extra: dict | None = None) -> SparkSession:
    """A session tuned for these jobs: AQE on (runtime broadcast conversion,
    partition coalescing, skew-join splitting), UI off, UTC clock."""
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_settings(input_bytes: int, executors: int, cores_per_executor: int = 4,
                     target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings sized for a large input: enough shuffle partitions that each holds
    about ``target_partition_bytes`` of the largest shuffle (bounded below by the
    cluster's task slots), AQE to coalesce small ones and split skewed ones, scan
    splits of the same size, and runtime Bloom filters for selective joins.

    For 100 TB on 1,000 executors x 4 cores this gives ~400k shuffle partitions
    before AQE coalescing; the aggregations here shuffle far less than their input
    (partial aggregation), so AQE merges them down at runtime.
    """
    slots = max(1, executors * cores_per_executor)
    partitions = max(slots * 2, -(-int(input_bytes) // int(target_partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    }


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session. Only a local session may lack one; it gets
    a temporary folder."""
    root = spark.conf.get(_CHECKPOINT_KEY, None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"set {_CHECKPOINT_KEY} to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="policypanel-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder path under the shared checkpoint root."""
    root = checkpoint_root(spark)
    sep = "" if root.endswith("/") else "/"
    return f"{root}{sep}policypanel/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python can inspect a local path (tests only)."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)
