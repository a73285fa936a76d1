"""Durable intermediates: written where all executors can read them, so that a lost executor costs no lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Without it a session of one machine uses a folder of its own; any other must name one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{tempfile.gettempdir()}/quern-checkpoints"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it back; the files go when the driver's JVM ends, or earlier by ``discard``."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    files, at = _file_system(spark, path)
    files.deleteOnExit(at)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def scratch(spark: SparkSession, name: str, suffix: str = "") -> str:
    """A fresh path in the shared folder, deleted when the driver's JVM ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}{suffix}"
    files, at = _file_system(spark, path)
    files.deleteOnExit(at)
    return path


def discard(df: DataFrame) -> None:
    """Deletes the files of a stored DataFrame that nothing reads any more."""
    files, at = _file_system(df.sparkSession, df._stored_at)
    files.delete(at, True)
