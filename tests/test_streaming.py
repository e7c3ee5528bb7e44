"""Reads as a stream."""

import datetime as dt

from pyspark.sql import functions as F

from readloom.operators.extract import classify
from readloom.plans.reads_view import raw_reads
from readloom.streaming.reads import classified, late_rows, to_exact_table, to_table, unique_reads


def test_redeliveries_are_dropped_across_batches(spark, tmp_path):
    day = dt.datetime(2031, 1, 1)
    rows = [("s", i % 7, day + dt.timedelta(days=i), "x") for i in range(14)] + [("t", 1, day, "x"), (None, None, None, None)]
    kinds = "sample_name string, read_idx long, loaded_at timestamp, event string"
    for k in range(4):  # a file is a batch
        spark.createDataFrame(rows[k * 4 : k * 4 + 4], kinds).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(kinds).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    to_table(unique_reads(stream), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    got = spark.read.schema(kinds).parquet(str(tmp_path / "out")).filter("sample_name is not null")
    assert {(r["sample_name"], r["read_idx"]) for r in got.collect()} == {("s", i) for i in range(7)} | {("t", 1)}
    assert got.count() == 8


def test_late_reads_are_counted_or_kept(spark, tmp_path):
    """A read 300 days behind the newest is beyond the watermark, of which the exact table knows nothing."""
    day = dt.datetime(2031, 1, 1)
    at = lambda n: day + dt.timedelta(days=n)
    files = [[("s", 1, at(0))], [("s", 2, at(300)), ("s", 1, at(301))], [("s", 2, at(302))], [("s", 4, at(303)), ("s", 4, at(303)), ("t", 1, None)],
             [("s", 3, at(0)), ("s", 3, at(1)), ("t", 1, at(303))]]
    kinds = "sample_name string, read_idx long, loaded_at timestamp"
    for k, rows in enumerate(files):
        own = spark.createDataFrame(rows, kinds).withColumn("run_day", F.when(F.col("sample_name") == "s", F.lit(day).cast("date")))
        own.coalesce(1).write.parquet(str(tmp_path / f"in/{k}"))
    schema = f"{kinds}, run_day date"
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    query = to_table(unique_reads(stream(), "120 days"), str(tmp_path / "out"), str(tmp_path / "state"))
    query.awaitTermination()
    kept = {tuple(r) for r in spark.read.schema(schema).parquet(str(tmp_path / "out")).select("sample_name", "read_idx").collect()}
    assert late_rows(query) > 0 and ("s", 3) not in kept
    for _ in range(2):  # the second run finds nothing new
        to_exact_table(stream(), str(tmp_path / "exact"), str(tmp_path / "state2")).awaitTermination()
        got = [tuple(r) for r in spark.read.schema(schema).parquet(str(tmp_path / "exact")).select("sample_name", "read_idx").collect()]
        assert sorted(got) == [("s", 1), ("s", 2), ("s", 3), ("s", 4), ("t", 1)]


def test_classification_of_a_stream(spark, sf_dir, tmp_path):
    reads = raw_reads(spark, sf_dir).filter(F.col("read_idx") < 200_000)
    reads.coalesce(2).write.parquet(str(tmp_path / "in"))
    stream = classified(spark.readStream.schema(reads.schema).parquet(str(tmp_path / "in"))).select("sample", "read_idx", "status")
    to_table(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    got, want = spark.read.parquet(str(tmp_path / "out")), classify(reads).select("sample", "read_idx", "status")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
