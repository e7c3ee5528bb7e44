"""Exact offset chunking against plain counting."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from readloom.operators.chunking import keyed_summary
from readloom.plans.skew_queries import p6_found

SCHEMA = "barcode string, combined_umi string, sample_name string, loaded_at timestamp, part string, k string, chunk int"


def summary(df, chunk_rows):
    states, total = keyed_summary(
        df, F.col("barcode"), {"n_umis": F.col("combined_umi"), "n_samples": F.col("sample_name")}, F.col("loaded_at"), chunk_rows
    )
    return {r["key"]: tuple(r)[1:] for r in states.collect()}, total


def expected(rows):
    out = {}
    for key in {r[0] for r in rows} - {None}:
        own = [r for r in rows if r[0] == key]
        times = [r[3] for r in own if r[3]]
        out[key] = (len(own), len({r[1] for r in own} - {None}), len({r[2] for r in own} - {None}), min(times, default=None), max(times, default=None))
    return out


@pytest.mark.parametrize("chunk_rows, broadcast", [(1, 200_000), (7, 200_000), (7, 2), (100, 0), (100_000, 200_000)])
def test_hot_keys_nulls_and_ties(spark, monkeypatch, chunk_rows, broadcast):
    monkeypatch.setattr("readloom.operators.chunking.BROADCAST_ROWS", broadcast)  # beyond it keys are salted
    rng = random.Random(5)
    day = dt.datetime(2031, 1, 1)
    rows = []
    for i in range(3000):
        key = rng.choice(["hot", "hot", "HOT2", "", None, f"k{rng.randrange(200)}"])
        moment = rng.choice([None, day + dt.timedelta(minutes=rng.randrange(50))])
        rows.append((key, rng.choice([None, "", f"u{rng.randrange(40)}"]), rng.choice([None, f"s{rng.randrange(5)}"]), moment, "x", None, i))
    rows += rows[:300]  # repeated rows count again
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)  # columns named like the operator's own
    got, total = summary(df, chunk_rows)
    assert total == len(rows)
    assert got == expected(rows)


def test_empty_and_very_long(spark):
    assert summary(spark.createDataFrame([], SCHEMA), None) == ({}, 0)
    long = "ACGT" * 200_000
    rows = [(long, long, "s", None, None, None, None)] * 3 + [(None,) * 7]
    got, total = summary(spark.createDataFrame(rows, SCHEMA), 2)
    assert got == {long: (3, 1, 1, None, None)} and total == 4


def test_chunks_are_equal(spark):
    """No group that is summarised on its own is larger than a chunk."""
    df = spark.range(0, 10_000, 1, 8).select(
        F.lit("hot").alias("barcode"), F.col("id").cast("string").alias("combined_umi"), F.lit("s").alias("sample_name"),
        F.lit(None).cast("timestamp").alias("loaded_at"),
    )
    got, _ = summary(df, 999)
    assert got == {"hot": (10_000, 10_000, 1, None, None)}


def test_found(spark, tmp_path):
    rows = [(b, None, "s", None) for b in [" acg\t"] * 2 + ["ACG"] + [None] * 97 + ["T\r"] * 2 + [f"X{i}" for i in range(48)]]
    df = spark.createDataFrame(rows, "barcode string, combined_umi string, sample_name string, loaded_at timestamp")
    df.write.parquet(str(tmp_path / "parsed.parquet"))
    assert [r[0] for r in p6_found(spark, str(tmp_path)).collect()] == ["ACG"]
