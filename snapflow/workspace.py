"""Where intermediate tables and checkpoints go: the folder that every executor can reach."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SHARED_DIR_SETTING = "spark.checkpoint.dir"


def _named_dir(spark: SparkSession) -> str | None:
    return spark.conf.get(SHARED_DIR_SETTING, None) or spark.sparkContext.getCheckpointDir()


def has_shared_dir(spark: SparkSession) -> bool:
    return _named_dir(spark) is not None


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir, else the session's checkpoint folder."""
    named = _named_dir(spark)
    if named is None:
        raise ValueError(f"Set {SHARED_DIR_SETTING} to a folder that all executors share")
    return named.rstrip("/")


def new_run_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder with all that is in it, on any file system Spark can write to; nothing happens if it is absent."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
