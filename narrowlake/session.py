"""Session settings and the shared work folder."""

from __future__ import annotations

import posixpath
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.mergeSchema": "false",
    "spark.sql.parquet.compression.codec": "snappy",
}

# Jobs of different series share the cluster; the driver only waits for them.
PARALLEL_JOBS = 4


# Shuffled bytes one task should get; it sorts and spills them within its memory.
TASK_BYTES = 256 * 1024 * 1024


def shuffle_partitions(input_bytes: int, least: int = 200, most: int = 100_000) -> int:
    """Shuffle partitions to start from; run-time coalescing only ever lowers them."""
    return max(least, min(most, -(-input_bytes // TASK_BYTES)))


def build_session(
    app: str = "narrowlake", input_bytes: int | None = None, **overrides: str
) -> SparkSession:
    """Session with the settings above; the cluster's own defaults stay otherwise.

    ``input_bytes``, the size of the tables to be read, sizes the shuffles.
    """
    settings = dict(SETTINGS)
    if input_bytes is not None:
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(
            shuffle_partitions(input_bytes)
        )
    builder = SparkSession.builder.appName(app)
    for key, value in {**settings, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, else one in the warehouse.

    A cluster must name one of them in a store that all machines reach.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if warehouse.startswith("file:") and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return posixpath.join(warehouse, "_shared")


def work_dir(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    return posixpath.join(shared_dir(spark), "narrowlake", f"{label}-{uuid.uuid4().hex}")
