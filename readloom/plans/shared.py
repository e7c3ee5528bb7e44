"""Tables and files in the folder that all executors share."""

from __future__ import annotations

import os
import tempfile
import uuid
from urllib.parse import urlparse

from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; where that is unset (tests, one machine) a new temporary one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = getattr(spark, "_readloom_dir", None) or "file://" + tempfile.mkdtemp(prefix="readloom-")
        spark._readloom_dir = named
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(named)
    return named


def expire(spark: SparkSession, path: str) -> str:
    """Has the driver's JVM remove what lies at a path when it ends; returns the path."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def cut(df: DataFrame) -> DataFrame:
    """Writes df as Parquet into the shared folder and reads it back: what follows doesn't recompute it and survives
    the loss of executors. Column names and types stay. The folder is removed when the driver ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(expire(spark, path))


def put_file(spark: SparkSession, name: str, data: bytes) -> str:
    """Stores a small file where every task can open it; returns the key for local_file()."""
    folder, name = shared_dir(spark), f"{uuid.uuid4().hex}-{name}"
    if urlparse(folder).scheme in ("", "file"):
        path = os.path.join(urlparse(folder).path, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as f:
            f.write(data)
        return path
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(data))
    out.close()
    spark.sparkContext.addFile(f"{folder}/{name}")
    return f"spark-file:{name}"


def put_table(df: DataFrame) -> str:
    """Writes df as Parquet where every task can open it, whatever its size; returns the key for local_parts(). Rows don't pass
    through the driver: executors open the shared folder or, where it is no mount, fetch the files from it once."""
    spark, name = df.sparkSession, f"table-{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/{name}"
    df.write.parquet(path)
    expire(spark, path)
    if urlparse(path).scheme in ("", "file"):
        return urlparse(path).path
    spark.sparkContext.addFile(path, recursive=True)
    return f"spark-file:{name}"


def local_parts(key: str) -> list[str]:
    """A task's local paths of the files of a table that put_table() stored."""
    folder = local_file(key)
    return [os.path.join(folder, f) for f in sorted(os.listdir(folder)) if f.startswith("part-")]


def local_file(key: str) -> str:
    """A task's local path of a file that put_file() stored."""
    return SparkFiles.get(key.split(":", 1)[1]) if key.startswith("spark-file:") else key


def spread(df: DataFrame, tasks_per_core: int = 2) -> DataFrame:
    """df in enough partitions to occupy the cluster. A table of many splits, as any large one, is left as it is."""
    wanted = df.sparkSession.sparkContext.defaultParallelism * tasks_per_core
    return df if df.rdd.getNumPartitions() * 2 > wanted else df.repartition(wanted)
