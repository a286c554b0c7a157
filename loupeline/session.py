"""Shared-storage helpers: the one place where a plan is cut by writing it down."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folder: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster in ``spark.checkpoint.dir``.

    A private folder is chosen only for a local master, where driver and executors share the disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    global _local_folder
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return _local_folder


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder on shared storage, below one folder per application so that a finished run is easy to clear."""
    return f"{shared_dir(spark)}/loupeline/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to shared storage and read it back.

    The result has no lineage to recompute, so values that depend on physical placement (range ids,
    positions) stay fixed for every later reader and survive executor loss.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sized(df: DataFrame, name: str) -> DataFrame:
    """``written`` for small aggregates that are joined to large tables.

    The stored size is known when the join is planned: below ``spark.sql.autoBroadcastJoinThreshold`` the large side is
    not shuffled at all, above it Spark falls back to a shuffle join. Nothing is broadcast on a guess.
    """
    return written(df, name)
