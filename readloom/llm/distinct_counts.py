"""Distinct counts by stochastic averaging: bit matrices of hash ranks, merged by bitwise union."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a bit matrix: a power of two. The relative standard error is 0.649 / sqrt(ROWS), 2.0 %.
ROWS = 1024
#: Ranks (columns of the matrix) that are kept; the last one takes all higher ranks.
RANKS = 48
#: sqrt(6 ln 2 / pi^2): the standard error that the matrix's Fisher information allows, times sqrt(rows).
ERROR = 0.649


def matrices(df: DataFrame, keys: dict[str, Column], fields: dict[str, Column], rows: int = ROWS) -> DataFrame:
    """Mergeable partial results: per combination of keys, field and matrix row the `bits` of the ranks seen there.

    A value's hash chooses a matrix row and, by its trailing zeros, a rank. Bits are or-ed inside each input partition
    before the shuffle, so a key combination that holds a third of all rows costs at most `rows` rows per partition.
    Null values are no values, null keys are keys; repeated rows change nothing, an empty table gives no row.
    """
    pairs = F.array(*[F.struct(F.lit(n).alias("field_name"), c.alias("v")) for n, c in fields.items()])
    long = df.select(*[c.alias(n) for n, c in keys.items()], F.explode(pairs).alias("p")).filter("p.v is not null")
    shift = rows.bit_length() - 1
    hashed = long.select(*keys, F.col("p.field_name").alias("field_name"), F.xxhash64("p.v").alias("h"))
    rest = F.shiftrightunsigned("h", shift)
    # trailing zeros of rest: the lowest set bit, as a mask, shows the rank itself
    mask = F.least(F.when(rest != 0, rest.bitwiseAND(-rest)).otherwise(F.lit(1 << (RANKS - 1))), F.lit(1 << (RANKS - 1)))
    return (
        hashed.select(*keys, "field_name", F.col("h").bitwiseAND(rows - 1).cast("int").alias("row"), mask.alias("m"))
        .groupBy(*keys, "field_name", "row")
        .agg(F.bit_or("m").alias("bits"))
    )


def estimate(set_rows: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximum-likelihood counts, and their standard errors, from the numbers of rows that have each rank's bit set.

    With n values a bit of rank j (probability 2^-(j+1), the last one twice that of its place) stays clear with
    exp(-n p_j / rows), independently for all bits in the Poisson model; log n is found by Newton steps, and the variance
    is the inverse of the Fisher information there.
    """
    c = np.asarray(set_rows, float)
    p = 2.0 ** -np.arange(1, RANKS + 1)
    p[-1] *= 2
    p = p / rows
    n = np.maximum((c * 2.0 ** np.arange(RANKS)).max(axis=1), 1.0)
    n = np.maximum(n, c.max(axis=1))
    for _ in range(60):
        x = np.clip(n[:, None] * p, 1e-300, 700)
        e = -np.expm1(-x)
        slope = (c * p * np.exp(-x) / e - (rows - c) * p).sum(axis=1)
        info = (rows * p * p * np.exp(-x) / e).sum(axis=1)
        step = np.clip(slope / np.maximum(info * n, 1e-300), -2, 2)
        n = n * np.exp(step)
        if np.all(np.abs(step) < 1e-10):
            break
    x = np.clip(n[:, None] * p, 1e-300, 700)
    info = (rows * p * p * np.exp(-x) / -np.expm1(-x)).sum(axis=1)
    full = c.sum(axis=1) > 0
    return np.where(full, n, 0.0), np.where(full, 1 / np.sqrt(info), 0.0)


def merged_counts(partial: DataFrame, keys: list[str], rows: int = ROWS) -> DataFrame:
    """Estimated distinct counts for every combination of the keys (as in CUBE; `grouping_id` tells an aggregated key
    from a null one): `n_distinct`, `std_error` and the bounds `low`, `high` of three standard errors.

    Matrices merge by bitwise union, each combination from the partial ones, which may come from any number of tables.
    """
    sets = [[*some, "field_name", "row"] for n in range(len(keys) + 1) for some in combinations(keys, n)]
    union = partial.groupingSets(sets, *keys, "field_name", "row").agg(
        F.bit_or("bits").alias("bits"), F.shiftright(F.grouping_id(), 2).alias("grouping_id")
    )
    ranks = [F.sum(F.getbit("bits", F.lit(j)).cast("long")).alias(f"r{j}") for j in range(RANKS)]
    counts = union.groupBy("grouping_id", *keys, "field_name").agg(*ranks)
    packed = counts.select("grouping_id", *keys, "field_name", F.array(*[f"r{j}" for j in range(RANKS)]).alias("set_rows"))

    @F.pandas_udf("struct<n: double, error: double>")
    def fit(column: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in column:
            n, error = estimate(np.stack(s.to_numpy()), rows) if len(s) else (np.zeros(0), np.zeros(0))
            yield pd.DataFrame({"n": n, "error": error})

    return packed.withColumn("e", fit("set_rows")).select(
        "grouping_id", *keys, "field_name", F.round("e.n").cast("long").alias("n_distinct"),
        F.col("e.error").alias("std_error"),
        F.greatest(F.lit(0.0), F.col("e.n") - 3 * F.col("e.error")).alias("low"),
        (F.col("e.n") + 3 * F.col("e.error")).alias("high"),
    )
