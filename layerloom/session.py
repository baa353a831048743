"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def build_session(app_name: str = "layerloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC day boundaries.

    Cluster sizes (shuffle partitions, memory, executors) stay with spark-submit; AQE
    coalesces and splits shuffle partitions from the configured start value.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def cluster_settings(shuffle_bytes: int, cores: int) -> dict[str, str]:
    """Start values for a job whose largest shuffle holds about ``shuffle_bytes``.

    Shuffles start with partitions of about 128 MB, at least two per core, and AQE merges
    small ones; scans read 256 MB per task.
    """
    partition = 128 * 1024**2
    return {
        "spark.sql.shuffle.partitions": str(max(2 * cores, -(-shuffle_bytes // partition))),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition),
        "spark.sql.files.maxPartitionBytes": str(2 * partition),
    }


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for written intermediates, which every executor can reach.

    It lies under ``spark.checkpoint.dir``, or else beside the tables in the warehouse folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
