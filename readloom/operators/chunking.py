"""Per-key summaries that no frequent key can unbalance: exact offset chunking.

Keys are counted per input partition, prefix sums over the partitions give each key's offsets, the rows of keys that
are longer than a chunk are numbered and cut into chunks of exactly `chunk_rows` rows, every (key, chunk) is summarised
on its own and the chunks' states are merged in their order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.shared import cut

#: A chunk's rows: at least the first, at most the second; between them a ten-thousandth of the table.
CHUNK_ROWS = (50_000, 1_000_000)
#: So many heavy keys, or offsets of (partition, heavy key), of some 40 bytes each, may be broadcast. Up to 10^10 rows there
#: are no more than 10,000 heavy keys; offsets beyond the limit are joined by (partition, key), as rows are numbered anyway.
BROADCAST_ROWS = 200_000


#: Beyond that, rows are joined with the heavy keys by (key, salt), of so many salts: no task gets all rows of a key.
SALTS = 64


def small(df: DataFrame, rows: int, limit: int | None = None) -> DataFrame:
    """df with a broadcast hint if it has no more rows than allowed."""
    return F.broadcast(df) if rows <= (BROADCAST_ROWS if limit is None else limit) else df


def by_key(rows: DataFrame, heavy: DataFrame, n_heavy: int, how: str) -> DataFrame:
    """Rows with (left_semi) or without (left_anti) a heavy key `k`; `pos` numbers the rows."""
    if n_heavy <= BROADCAST_ROWS:
        return rows.join(F.broadcast(heavy), "k", how)
    salted = heavy.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod("pos", F.lit(SALTS)).cast("int")).join(salted, ["k", "salt"], how).drop("salt")


def keyed_summary(
    df: DataFrame, key: Column, distinct: dict[str, Column], moment: Column, chunk_rows: int | None = None
) -> tuple[DataFrame, int]:
    """One row per non-null key: `key`, `n_rows`, for each name in `distinct` the exact number of its distinct non-null
    values, `first_at` and `last_at` of `moment`; and the number of rows of df, those with a null key included.

    No task holds more than one chunk of a key. Light keys (at most a chunk of rows) are summarised directly, with
    partial states before the shuffle. Repeated rows count again. Null moments are ignored (NULL if a key has no other),
    an empty table gives no row and 0, extra columns of df are not read and may bear any name. Values of any length are
    compared whole. If the input is split differently when it is read again (executors lost between the passes), rows
    may end up in another chunk of their key, which changes the balance but no result.
    """
    d = {f"d{i}": c for i, c in enumerate(distinct.values())}
    rows = df.select(
        key.alias("k"), moment.alias("t"), *[c.alias(n) for n, c in d.items()],
        F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("pos"),
    )
    counts = cut(rows.groupBy("part", "k").agg(F.count(F.lit(1)).alias("n")))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    size = chunk_rows or min(CHUNK_ROWS[1], max(CHUNK_ROWS[0], total // 10_000))

    by_part = Window.partitionBy("k").orderBy("part")
    offsets = (
        counts.filter(F.col("k").isNotNull())
        .withColumn("start", F.sum("n").over(by_part) - F.col("n"))
        .withColumn("of_key", F.sum("n").over(Window.partitionBy("k")))
        .filter(F.col("of_key") > size)
        .select("part", "k", "start")
    )
    offsets = cut(offsets)
    n_offsets, n_heavy = offsets.agg(F.count(F.lit(1)), F.count_distinct("k")).first()
    heavy = offsets.select("k").distinct()

    states = [F.count(F.lit(1)).alias("n"), F.min("t").alias("t0"), F.max("t").alias("t1")] + [
        F.collect_set(n).alias(n) for n in d
    ]
    light = (
        by_key(rows.filter(F.col("k").isNotNull()), heavy, n_heavy, "left_anti").groupBy("k").agg(*states)
        .select("k", "n", "t0", "t1", *[F.size(n).cast("long").alias(n) for n in d])
    )
    if n_offsets == 0:
        return _named(light, distinct), total

    numbered = (
        by_key(rows, heavy, n_heavy, "left_semi")
        .withColumn("i", F.row_number().over(Window.partitionBy("part", "k").orderBy("pos")))
        .join(small(offsets, n_offsets), ["part", "k"], "left")
        .withColumn("chunk", F.floor((F.coalesce("start", F.lit(0)) + F.col("i") - 1) / F.lit(size)))
    )
    chunks = numbered.groupBy("k", "chunk").agg(*states)
    merged = chunks.groupBy("k").agg(F.sum("n").alias("n"), F.min("t0").alias("t0"), F.max("t1").alias("t1"))
    for n in d:
        values = chunks.select("k", F.explode(n).alias("v")).distinct().groupBy("k").agg(F.count(F.lit(1)).alias(n))
        merged = merged.join(values, "k", "left").withColumn(n, F.coalesce(n, F.lit(0)))
    return _named(light.unionByName(merged.select(light.columns)), distinct), total


def _named(states: DataFrame, distinct: dict[str, Column]) -> DataFrame:
    """The result's column names in place of the inner ones."""
    return states.select(
        F.col("k").alias("key"), F.col("n").alias("n_rows"),
        *[F.col(f"d{i}").alias(name) for i, name in enumerate(distinct)],
        F.col("t0").alias("first_at"), F.col("t1").alias("last_at"),
    )
