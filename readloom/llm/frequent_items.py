"""Most frequent items in bounded memory: Misra-Gries summaries per partition, merged."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Counters per summary: items above a 1/(COUNTERS + 1) share are guaranteed, counts err by at most that share.
COUNTERS = 1000
#: Summaries merged in one task.
FAN_IN = 64
#: Merging steps before the last one where the number of partitions isn't known: with FAN_IN^3 = 262,144 partitions the last one
#: still gets no more than FAN_IN summaries.
STEPS = 2

SCHEMA = "field_name string, part long, item_value string, low long, lost long, weight long"


def reduce_counters(values: np.ndarray, counts: np.ndarray, counters: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Keeps at most `counters` counters: subtracts the next-largest one from all and drops what isn't positive.
    Returns also what was subtracted, the most by which a count is now too low on this account."""
    if len(counts) <= counters:
        return values, counts, 0
    cut = int(np.partition(counts, len(counts) - counters - 1)[len(counts) - counters - 1])
    keep = counts > cut
    return values[keep], counts[keep] - cut, cut


def summarise(batches: Iterator[pa.RecordBatch], counters: int) -> Iterator[pa.RecordBatch]:
    """One summary per field of a partition. A batch's exact counts are a summary without error; it is merged into the
    partition's one and the sum is reduced, so that never more than `counters` plus a batch's items are held."""
    held: dict[str, list] = {}
    part = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        part = batch.column(2)[0].as_py()
        for field in pc.unique(batch.column(0)).to_pylist():
            own = batch.column(1).filter(pc.equal(batch.column(0), field))
            seen = pc.value_counts(own)
            names, n = seen.field(0).to_pylist(), seen.field(1).to_numpy(zero_copy_only=False)
            old_names, old_n, lost, weight = held.get(field, ([], np.zeros(0, np.int64), 0, 0))
            merged = dict(zip(old_names, old_n.tolist()))
            for name, k in zip(names, n.tolist()):
                merged[name] = merged.get(name, 0) + k
            v, c, cut = reduce_counters(np.array(list(merged), object), np.fromiter(merged.values(), np.int64), counters)
            held[field] = [v.tolist(), c, lost + cut, weight + int(n.sum())]
    for field, (names, n, lost, weight) in held.items():
        # the summary's own loss and weight stand in a row without a value
        yield pa.RecordBatch.from_pydict(
            {
                "field_name": pa.array([field] * (len(names) + 1), pa.string()),
                "part": pa.array([part] * (len(names) + 1), pa.int64()),
                "item_value": pa.array([*names, None], pa.string()),
                "low": pa.array([*n.tolist(), 0], pa.int64()),
                "lost": pa.array([0] * len(names) + [lost], pa.int64()),
                "weight": pa.array([0] * len(names) + [weight], pa.int64()),
            }
        )


def merge(summaries: pd.DataFrame, counters: int, fan_in: int = FAN_IN) -> pd.DataFrame:
    """Adds summaries of one field and bundle up and reduces the sum; the bundle's number is the sum's partition."""
    items = summaries[summaries["item_value"].notna()].groupby("item_value", sort=True)["low"].sum()
    values, low, cut = reduce_counters(items.index.to_numpy(object), items.to_numpy(np.int64), counters)
    field, lost, weight = summaries["field_name"].iloc[0], int(summaries["lost"].sum()) + cut, int(summaries["weight"].sum())
    return pd.DataFrame(
        {
            "field_name": field, "part": int(summaries["part"].iloc[0]) // fan_in, "item_value": [*values, None], "low": [*low, 0],
            "lost": [0] * len(values) + [lost], "weight": [0] * len(values) + [weight],
        }
    )


def merging_steps(partitions: int, fan_in: int = FAN_IN) -> int:
    """Steps after which so many partitions have left no more than `fan_in` summaries."""
    steps = 0
    while partitions > fan_in:
        partitions, steps = -(-partitions // fan_in), steps + 1
    return steps


def frequent_items(rows: DataFrame, counters: int = COUNTERS, fan_in: int = FAN_IN, steps: int = STEPS) -> DataFrame:
    """Summary of rows (`field_name`, `item_value`): per field at most `counters` items with `low` <= true count <=
    `low + lost`, and `weight`, the number of non-null values. Every item with more than weight / (counters + 1)
    occurrences is there.

    Null items and fields are ignored, repeated rows count again, empty items are items like others; an empty table or a
    field of nulls gives no row. Memory in any task is bounded by `counters` and a batch (when merging, `fan_in` summaries),
    however many distinct items and partitions there are.
    """
    tagged = rows.select("field_name", "item_value", F.spark_partition_id().cast("long").alias("part")).dropna()
    some = tagged.mapInArrow(lambda batches: summarise(batches, counters), SCHEMA)
    for _ in range(steps):
        bundles = some.groupBy("field_name", F.floor(F.col("part") / fan_in).alias("bundle"))
        some = bundles.applyInPandas(lambda p: merge(p, counters, fan_in), SCHEMA)
    whole = some.groupBy("field_name").applyInPandas(lambda p: merge(p, counters), SCHEMA)
    # the totals join their field's items; at most one row per field
    totals = F.max_by(F.struct("lost", "weight"), F.col("item_value").isNull())
    return (
        whole.groupBy("field_name")
        .agg(totals.alias("t"), F.collect_list(F.when(F.col("item_value").isNotNull(), F.struct("item_value", "low"))).alias("i"))
        .select("field_name", F.explode("i").alias("i"), "t.lost", "t.weight")
        .select("field_name", F.col("i.item_value").alias("item_value"), F.col("i.low").alias("low"), "lost", "weight")
    )
