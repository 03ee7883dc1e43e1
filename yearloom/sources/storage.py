"""Where tables that a session keeps are written: a folder that driver and executors share."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; where it is unset and all runs on one machine, a temporary one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return spark.sparkContext.getCheckpointDir()


def new_folder(spark: SparkSession, stem: str) -> str:
    return f"{shared_folder(spark)}/{stem}-{uuid4().hex}"


def path_of(spark: SparkSession, folder: str):
    """A path and its file system, whatever store it is in."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, folder: str) -> bool:
    path, store = path_of(spark, folder)
    return store.exists(path)


def drop_folder(spark: SparkSession, folder: str) -> None:
    path, store = path_of(spark, folder)
    store.delete(path, True)
