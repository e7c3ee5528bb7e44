"""Row-wise operators and deduplication over unbounded reads."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..design import Design
from ..operators.extract import classify
from ..plans.session import table
from ..plans.shared import shared_dir

#: How long after a read's first delivery another one is still recognised; the state kept is that of so many days. Reads that come
#: later than so many days after the newest one are left out (late_rows() counts them); to_exact_table() has no such bound.
REDELIVERY = "120 days"


def read_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table (a Parquet file or a folder of them) as a stream of files."""
    path = f"{sf_dir}/{name}.parquet"
    schema = table(spark, sf_dir, name).schema
    if os.path.isfile(path):
        return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
    return spark.readStream.schema(schema).parquet(path)


def unique_reads(stream: DataFrame, within: str = REDELIVERY) -> DataFrame:
    """Each read's first delivery: `sample_name` and `read_idx` name it, `loaded_at` is the event time."""
    timed = stream.withColumn("loaded_at", F.col("loaded_at").cast("timestamp")).withWatermark("loaded_at", within)
    return timed.dropDuplicatesWithinWatermark(["sample_name", "read_idx"])


def late_rows(query) -> int:
    """Rows that a finished query's stateful steps left out because they were older than the watermark."""
    steps = [step for progress in query.recentProgress for step in progress["stateOperators"]]
    return sum(step.get("numRowsDroppedByWatermark") or 0 for step in steps)


def to_exact_table(stream: DataFrame, path: str, checkpoint: str):
    """Each read's first delivery, however late others, or the read itself, come: every batch is compared with the reads that the
    table holds for the batch's days (`run_day`, which redeliveries repeat and by which the table is partitioned), so no state
    is kept and nothing is left out. A batch that is repeated after a failure writes its own folder anew."""
    schema = stream.schema

    def add(batch: DataFrame, number: int) -> None:
        spark, own = batch.sparkSession, f"{path}/batch={number:09d}"
        rows = batch.dropDuplicates(["sample_name", "read_idx"])
        earlier = _folders_before(spark, path, number)
        if earlier:
            days = F.broadcast(batch.select(F.col("run_day").alias("day")).distinct())  # as many as days
            held = spark.read.schema(schema).option("basePath", path).parquet(*earlier).join(days, F.col("run_day").eqNullSafe(F.col("day")), "left_semi")
            rows = rows.join(held.select("sample_name", "read_idx"), ["sample_name", "read_idx"], "left_anti")
        rows.write.mode("overwrite").partitionBy("run_day").parquet(own)

    writer = stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def _folders_before(spark: SparkSession, path: str, number: int) -> list[str]:
    """The folders of the batches before one."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    found = sorted(s.getPath().getName() for s in system.listStatus(folder))
    return [f"{path}/{f}" for f in found if f.startswith("batch=") and int(f.removeprefix("batch=")) < number]


def classified(stream: DataFrame, design: Design = Design()) -> DataFrame:
    """A stream of raw reads with their status and parts; keeps no state."""
    return classify(stream, design)


def to_table(stream: DataFrame, path: str, checkpoint: str, query_name: str | None = None):
    """Appends what has arrived to a Parquet table, exactly once, and ends; returns the streaming query."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.queryName(query_name) if query_name else writer).trigger(availableNow=True).outputMode("append").start()


def stream_unique_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads per sample and day, from a stream of deliveries that writes each read once."""
    folder = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    own = unique_reads(read_stream(spark, sf_dir, "parsed").select("sample_name", "read_idx", "run_day", "loaded_at"))
    query = to_table(own, f"{folder}/reads", f"{folder}/state")
    query.awaitTermination()
    reads = spark.read.schema(own.schema).parquet(f"{folder}/reads")
    return reads.groupBy("sample_name", "run_day").agg(F.count(F.lit(1)).alias("n_reads"))


def stream_exact_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a stream that compares every batch with the table, whatever the deliveries' delay."""
    folder = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    own = read_stream(spark, sf_dir, "parsed").select("sample_name", "read_idx", "run_day", "loaded_at")
    to_exact_table(own, f"{folder}/reads", f"{folder}/state").awaitTermination()
    reads = spark.read.schema(own.schema).parquet(f"{folder}/reads")
    return reads.groupBy("sample_name", "run_day").agg(F.count(F.lit(1)).alias("n_reads"))


QUERIES = {"stream_unique_reads": stream_unique_reads, "stream_exact_reads": stream_exact_reads}
ORACLE = {
    name: "SELECT sample_name, run_day, count(DISTINCT read_idx) AS n_reads FROM parsed GROUP BY ALL" for name in QUERIES
}
