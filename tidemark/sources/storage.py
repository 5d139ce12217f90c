"""Paths on the session's file system, whichever that is, and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _path(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder, sorted; nothing for a folder that is not there."""
    fs, p = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a glob pattern, in one listing call."""
    fs, p = _path(spark, pattern)
    return sorted(str(s.getPath().toString()) for s in fs.globStatus(p) or [])


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.mkdirs(p)


def size_of(spark: SparkSession, path: str) -> int:
    fs, p = _path(spark, path)
    return fs.getContentSummary(p).getLength()


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.delete(p, True)


def move(spark: SparkSession, path: str, target: str) -> None:
    """Give a folder another place on the same file system."""
    fs, p = _path(spark, path)
    to = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(to.getParent())
    if not fs.rename(p, to):
        raise OSError(f"{path} could not be moved to {target}")


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder all executors can reach, below the checkpoint folder the cluster names.

    Only a session without one, as in tests, gets a folder on this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` by way of a table, for results that are read more than once."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
