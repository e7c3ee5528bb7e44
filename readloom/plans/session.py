"""A session with the settings the library is meant for."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def session(master: str | None = None, name: str = "readloom", **conf: str) -> SparkSession:
    """Starts (or returns) a session; on a cluster leave master and memory to spark-submit."""
    builder = (
        SparkSession.builder.appName(name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = (
            builder.master(master)
            .config("spark.ui.enabled", "false")
            .config("spark.driver.memory", os.environ.get("READLOOM_DRIVER_MEMORY", "12g"))
            .config("spark.sql.shuffle.partitions", os.environ.get("READLOOM_SHUFFLE_PARTITIONS", "8"))
        )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str):
    """A test table as a DataFrame."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
