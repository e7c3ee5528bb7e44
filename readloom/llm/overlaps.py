"""Overlap sizes between many large sets by bottom-k hash sketches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.shared import cut

#: Hashes kept per set: the union's size has a standard error of 1/sqrt(K), 1.6 %.
K = 4096
#: Hashes that a task gathers before it reduces them, and those that it holds at most after.
GATHERED, HELD = 1 << 19, 1 << 22
#: Partitions whose sketches of a set are merged in one step.
FAN_IN = 64
#: Sketches in a block: one task of the pairing holds two blocks, of at most 8 MB each.
BLOCK = 256

SKETCHES = "set_id string, part long, hashes array<long>"


def lowest(batches: Iterator[pa.RecordBatch], k: int, most: int = HELD, gathered: int = GATHERED) -> Iterator[pa.RecordBatch]:
    """The k smallest distinct hashes of each set of a partition of rows (`set_id`, `h`, `part`). Hashes are gathered and
    reduced when as many are new as are held. More than `most` leave at once, so a set may come in several sketches."""
    codes: dict[str, int] = {}
    held, new, n_new, part = np.zeros((2, 0), np.int64), [], 0, 0
    bound = np.zeros(0, np.int64)  # by set: what a hash must not exceed
    for batch in batches:
        if not batch.num_rows:
            continue
        part = batch.column(2)[0].as_py()
        own = batch.column(0).dictionary_encode()
        names = np.array([codes.setdefault(s, len(codes)) for s in own.dictionary.to_pylist()], np.int64)
        bound = np.append(bound, np.full(len(codes) - len(bound), np.iinfo(np.int64).max))
        code, h = names[own.indices.to_numpy()], batch.column(1).to_numpy()
        low = h <= bound[code]
        new.append(np.stack([code[low], h[low]]))
        n_new += int(low.sum())
        if n_new >= max(gathered, held.shape[1]):
            held, bound = _reduced(np.concatenate([held, *new], axis=1), len(codes), k)
            new, n_new = [], 0
            if held.shape[1] > most:
                yield from _rows(held, list(codes), part)
                codes, held, bound = {}, held[:, :0], bound[:0]
    if codes:
        yield from _rows(_reduced(np.concatenate([held, *new], axis=1), len(codes), k)[0], list(codes), part)


def _reduced(rows: np.ndarray, n_sets: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of codes and hashes the k smallest distinct hashes per code, in order; by code the k-th, if there are so many."""
    rows = rows[:, np.lexsort((rows[1], rows[0]))]
    rows = rows[:, np.append(True, (rows[:, 1:] != rows[:, :-1]).any(axis=0))[: rows.shape[1]]]
    place = np.arange(rows.shape[1]) - np.searchsorted(rows[0], np.arange(n_sets))[rows[0]]
    bound = np.full(n_sets, np.iinfo(np.int64).max)
    bound[rows[0][place == k - 1]] = rows[1][place == k - 1]
    return rows[:, place < k], bound


def _rows(held: np.ndarray, names: list[str], part: int) -> Iterator[pa.RecordBatch]:
    """Held hashes as sketches, a bounded number of them in a batch."""
    ends = np.searchsorted(held[0], np.arange(len(names) + 1))
    for i in range(0, len(names), BLOCK):
        own = names[i : i + BLOCK]
        cuts = ends[i : i + len(own) + 1]
        hashes = pa.ListArray.from_arrays(pa.array(cuts - cuts[0], pa.int32()), pa.array(held[1, cuts[0] : cuts[-1]]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(own, pa.string()), pa.array([part] * len(own), pa.int64()), hashes], ["set_id", "part", "hashes"]
        )


def _merged(group: pd.DataFrame, k: int, fan_in: int) -> pd.DataFrame:
    """One sketch of a set's sketches in a bundle; the bundle's number is its partition."""
    hashes = np.unique(np.concatenate(group["hashes"].to_list()))[:k]
    return pd.DataFrame({"set_id": [group["set_id"].iloc[0]], "part": [int(group["part"].iloc[0]) // fan_in], "hashes": [hashes]})


def sketches(sets: DataFrame, k: int = K, fan_in: int = FAN_IN) -> DataFrame:
    """Per `set_id` the k smallest distinct hashes of its `item`s, ascending, as `hashes`.

    Each input partition keeps only its k smallest hashes of a set before the shuffle. Sketches of parts of a set merge into
    the set's by taking the k smallest again, in steps, so that no task holds more than those of `fan_in` partitions of a set.
    Null ids and items are ignored, repeated rows count once, an empty table gives no row, extra columns are not read.
    """
    known = sets.filter(F.col("item").isNotNull() & F.col("set_id").isNotNull())
    hashed = known.select("set_id", F.xxhash64("item").alias("h"), F.spark_partition_id().cast("long").alias("part"))
    some, left = hashed.mapInArrow(lambda batches: lowest(batches, k), SKETCHES), sets.rdd.getNumPartitions()
    while left > fan_in:
        bundles = some.groupBy("set_id", F.floor(F.col("part") / fan_in).alias("bundle"))
        some, left = bundles.applyInPandas(lambda g: _merged(g, k, fan_in), SKETCHES), -(-left // fan_in)
    return some.groupBy("set_id").applyInPandas(lambda g: _merged(g, k, fan_in), SKETCHES).select("set_id", "hashes")


def _unit(h: np.ndarray | int) -> np.ndarray | float:
    """Where a signed 64-bit hash lies in (0, 1]."""
    return (np.asarray(h, np.float64) + 2.0**63 + 1.0) / 2.0**64


def set_size(hashes: np.ndarray, k: int) -> float:
    """Estimated size of a set; exact while the sketch isn't full."""
    return float(len(hashes)) if len(hashes) < k else (k - 1) / float(_unit(hashes[k - 1]))


PAIRS = (
    "set_a string, set_b string, size_a double, size_b double, union_size double, shared double, shared_error double, n_hashes long"
)


def common_counts(hashes: list[np.ndarray]) -> np.ndarray:
    """For each pair of sketches (row < column) their common hashes: all are sorted together, and equal ones stand side by
    side, so only pairs that share a hash cost anything."""
    n = len(hashes)
    both = np.concatenate(hashes) if n else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(n), [len(h) for h in hashes])
    order = np.argsort(both, kind="stable")  # equal hashes in the order of their sketches
    both, owner, found, lag = both[order], owner[order], np.zeros(n * n, np.int64), 1
    at = np.arange(len(both))  # of those that have an equal one `lag` places on
    while True:
        at = at[at + lag < len(both)]
        at = at[both[at] == both[at + lag]]
        if not len(at):
            return found.reshape(n, n)
        found += np.bincount(owner[at] * n + owner[at + lag], minlength=n * n)
        lag += 1


def overlaps(hashes: list[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each pair of ascending sketches (row < column): the estimated union, shared items and the latter's standard error,
    and the hashes these rest on.

    Two sketches are merged up to the hash where the first full one of them ends: below it all hashes of the union are known,
    k of them at least. Their number and the last one's place give the union's size, the common ones among them the shared
    fraction. Without a full one all is exact."""
    n = len(hashes)
    common = common_counts(hashes).astype(float)
    size = np.array([len(h) for h in hashes])
    end = np.array([h[k - 1] if len(h) >= k else np.iinfo(np.int64).max for h in hashes], np.int64)
    below = np.array([np.searchsorted(h, end, "right") for h in hashes]).reshape(n, n)  # of row's hashes, up to column's end
    first = end[:, None] <= end[None, :]  # row's end comes first
    own, other = np.where(first, size[:, None], below), np.where(first, below.T, size[None, :])
    merged = own + other - common
    full = (size[:, None] >= k) | (size[None, :] >= k)
    until = _unit(np.minimum(end[:, None], end[None, :]))
    union = np.where(full, (merged - 1) / until, merged)
    share = common / np.maximum(merged, 1)
    least = 1 / np.maximum(merged, 2)
    spread = np.sqrt(np.maximum(share, least) * (1 - np.minimum(share, 1 - least / 2)) / np.maximum(merged, 1))
    return union, union * share, np.where(full, union * spread, 0.0), merged.astype(np.int64)


def _pairs_of_blocks(group: pd.DataFrame, k: int) -> pd.DataFrame:
    """All pairs of two blocks of sketches, or within one."""
    own = group.iloc[np.argsort([s.encode() for s in group["set_id"]])]
    hashes = [np.asarray(h, np.int64) for h in own["hashes"]]
    names, block = own["set_id"].to_numpy(object), own["block"].to_numpy()
    sizes = np.array([set_size(h, k) for h in hashes])
    a, b = np.triu_indices(len(hashes), 1)
    wanted = (block[a] != block[b]) | (group["x"].iloc[0] == group["y"].iloc[0])
    a, b = a[wanted], b[wanted]
    columns = [names[a], names[b], sizes[a], sizes[b], *[m[a, b] for m in overlaps(hashes, k)]]
    return pd.DataFrame(dict(zip([c.split()[0] for c in PAIRS.split(", ")], columns)))


def estimated_overlaps(sets: DataFrame, k: int = K, block: int = BLOCK) -> DataFrame:
    """For each pair of sets (`set_a` < `set_b` in byte order) the estimated sizes, union and shared items with its
    standard error, and the hashes they rest on (`n_hashes`).

    No set's items are joined: sketches, of at most k hashes, are paired in blocks, so what is shuffled is a sketch for every
    `block` sets, however many hashes two sets have in common. Joined by their hashes, sets alike would give up to k rows a pair."""
    all_sketches = cut(sketches(sets, k))
    n_blocks = max(1, -(-all_sketches.count() // block))
    others = F.sequence(F.lit(0), F.lit(n_blocks - 1))
    placed = all_sketches.withColumn("block", F.pmod(F.xxhash64("set_id"), F.lit(n_blocks)).cast("int"))
    paired = (
        placed.withColumn("o", F.explode(others))
        .withColumn("x", F.least("block", "o"))
        .withColumn("y", F.greatest("block", "o"))
    )
    return paired.groupBy("x", "y").applyInPandas(lambda g: _pairs_of_blocks(g, k), PAIRS)


def share_of_smaller(part: float, k: int = K) -> Column:
    """What a pair's estimate says of whether it shares `part` of its smaller set: true, false or, within five standard errors
    of the fraction and of the sizes, NULL. Pairs of sets smaller than k are known exactly.

    The fraction's error is that of a pair which shares just so much: the estimate's own shrinks where chance leaves few common
    hashes, so pairs of very unequal sets, of which few are expected, would be lost."""
    least, exact, of_size = F.least("size_a", "size_b"), F.col("shared_error") == 0, 5 / k**0.5
    p = lambda by: F.least(F.lit(1.0), F.lit(part * by) * least / F.col("union_size"))
    error = lambda q: 5 * F.sqrt(q * (1 - q) / F.col("n_hashes"))
    share, low, high = F.col("shared") / F.col("union_size"), p(1 - of_size), p(1 + of_size)
    return (
        F.when(exact, F.col("shared") >= F.lit(part) * least - 1e-9)
        .when(share < low - error(low), F.lit(False)).when((share >= high + error(high)) & (high < 1), F.lit(True))
    )


def pairs_sharing(sets: DataFrame, part: float, k: int = K, block: int = BLOCK) -> DataFrame:
    """Pairs (`set_a`, `set_b`) that share at least `part` of their smaller set's items. The sketches settle all pairs but
    those near the bound, whose sets alone are counted exactly.

    Null ids and items are ignored, repeated rows count once, an empty table gives no row, extra columns are not read."""
    near = estimated_overlaps(sets, k, block).withColumn("sure", share_of_smaller(part, k)).select("set_a", "set_b", "sure")
    near = cut(near.filter(F.coalesce("sure", F.lit(True))))
    sure, open_ = near.filter("sure").drop("sure"), near.filter("sure is null").drop("sure")
    if open_.isEmpty():
        return sure
    exact = exact_overlaps(sets, open_).filter(F.col("n_shared") >= F.lit(part) * F.least("n_a", "n_b") - 1e-9)
    return sure.unionByName(exact.select("set_a", "set_b"))


def exact_overlaps(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """Adds the exact `n_a`, `n_b` and `n_shared` to given pairs (`set_a`, `set_b`); only their sets' items are joined. The
    items of a pair's smaller set are looked up in the larger one, so a large set isn't repeated for each small partner. Pairs
    without a common item are left out; `pairs` is read several times."""
    named = pairs.select(F.col("set_a").alias("set_id")).union(pairs.select("set_b")).distinct()
    items = sets.select("set_id", "item").dropna().join(named, "set_id", "left_semi").distinct()
    sizes = cut(items.groupBy("set_id").agg(F.count(F.lit(1)).alias("n")))
    sized = pairs.join(sizes.select(F.col("set_id").alias("set_a"), F.col("n").alias("n_a")), "set_a").join(
        sizes.select(F.col("set_id").alias("set_b"), F.col("n").alias("n_b")), "set_b"
    )
    a_first = F.col("n_a") <= F.col("n_b")
    small, large = F.when(a_first, F.col("set_a")).otherwise(F.col("set_b")), F.when(a_first, F.col("set_b")).otherwise(F.col("set_a"))
    first = sized.withColumns({"small": small, "large": large}).join(items.withColumnRenamed("set_id", "small"), "small")
    return (
        first.join(items.withColumnRenamed("set_id", "large"), ["large", "item"])
        .groupBy("set_a", "set_b", "n_a", "n_b").agg(F.count(F.lit(1)).alias("n_shared"))
    )


def sets_of(df: DataFrame, set_id: Column, item: Column, where: Column) -> DataFrame:
    """Membership rows (`set_id`, `item`) of a table."""
    return df.filter(where).select(set_id.alias("set_id"), item.alias("item"))
