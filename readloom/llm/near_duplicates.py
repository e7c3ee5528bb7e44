"""Near-duplicate short strings by PartEnum signatures.

A string's letter positions are the feature domain. Each length is a band of its own; the positions of a band are
partitioned into `parts` segments, and since `max_edits` edits touch at most so many segments, two strings within that
distance agree in some subset of `parts - max_edits` segments. All such subsets are enumerated: the index side of a band
signs each with the letters of its own segments, the other side with the letters found where insertions and deletions
may have moved them. Equal signatures are joined, and every candidate pair is verified with the exact edit distance.
"""

from __future__ import annotations

from itertools import combinations, product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.shared import cut

#: Distinct strings in the largest group up to which 3, 4, ... parts are used: more parts give longer signatures.
PARTS_FOR = ((60_000, 3), (10_000_000, 4))
MOST_PARTS = 5


def shift_tuples(segments: int, longer: int, max_edits: int) -> list[tuple[int, ...]]:
    """How far the untouched segments may have moved in a string longer by `longer` (negative: shorter).

    For equal lengths and at most two edits all moves go one way, so it is enough to look for moves to the right: of two
    strings one finds the other.
    """
    span = range(-max_edits, max_edits + 1)
    found = []
    for s in product(span, repeat=segments):
        cost = abs(s[0]) + sum(abs(b - a) for a, b in zip(s, s[1:])) + abs(longer - s[-1])
        if cost <= max_edits and not (longer == 0 and max_edits <= 2 and min(s) < 0):
            found.append(s)
    return found


def _recipes(longer: int, parts: int, max_edits: int) -> list[str]:
    """SQL of the subsets and shifts to try for a string longer than the band by `longer`: `still` marks those that the
    index side has too."""
    out = []
    for subset in combinations(range(parts), parts - max_edits):
        for shifts in shift_tuples(len(subset), longer, max_edits):
            places = ", ".join(f"'a{j}', {i}, 's{j}', {s}" for j, (i, s) in enumerate(zip(subset, shifts)))
            still = str(longer == 0 and not any(shifts)).lower()
            out.append(f"named_struct('longer', {longer}, 'subset', {sum(1 << i for i in subset)}, 'still', {still}, {places})")
    return out


def _signature(parts: int, max_edits: int) -> str:
    """SQL of the hash of the letters that recipe `p` picks from `v` of `n` letters; NULL if a segment would begin before
    the string."""
    band = "(n - p.longer)"
    starts = [f"cast({band} * p.a{j} div {parts} + 1 + p.s{j} as int)" for j in range(parts - max_edits)]
    lengths = [f"cast({band} * (p.a{j} + 1) div {parts} - {band} * p.a{j} div {parts} as int)" for j in range(parts - max_edits)]
    letters = ", ".join(f"substring(v, {a}, {n})" for a, n in zip(starts, lengths))
    return f"if({' and '.join(f'{a} >= 1' for a in starts)}, xxhash64(grp, {band}, p.subset, {letters}), null)"


def similar_pairs(df: DataFrame, group: Column, value: Column, max_edits: int = 2, parts: int | None = None) -> DataFrame:
    """Pairs of different values that occur in the same group and turn into each other by at most `max_edits`
    insertions, deletions or replacements of one letter: `grp`, `value_a` < `value_b` (byte order), each pair once.

    Rows with a null group or value are ignored, repeated rows count once, empty and one-letter values are compared like
    others, values of any length are compared whole, an empty table gives no row, extra columns are not read. No
    candidate is dropped: a signature shared by many values only costs time (adaptive joins split it).
    """
    # a value that occurs often is one row per partition before the shuffle
    values = cut(
        df.select(group.alias("grp"), value.alias("v")).dropna().distinct().withColumn("n", F.length("v"))
    )
    by_group = values.groupBy("grp").agg(F.count(F.lit(1)).alias("c")).agg(F.coalesce(F.max("c"), F.lit(0)))
    largest = by_group.first()[0]
    parts = parts or next((p for most, p in PARTS_FOR if largest <= most), MOST_PARTS)
    parts = max(parts, max_edits + 1)
    # one number per distinct length; the rarer length looks for the more common one
    lengths = {r["n"]: r["c"] for r in values.groupBy("n").agg(F.count(F.lit(1)).alias("c")).collect()}
    bands = {
        n: [b for b in range(n - max_edits, n + max_edits + 1) if b != n and b in lengths and (lengths[n], n) < (lengths[b], b)]
        for n in lengths
    }
    longers = {n: [0, *[n - b for b in own]] for n, own in bands.items()}
    own = F.coalesce(
        *[F.when(F.col("n").isin([n for n in longers if longers[n] == some]), F.array(*map(F.lit, some)))
          for some in {tuple(x): x for x in longers.values()}.values()],
        F.array(F.lit(0)),
    )
    recipes = ", ".join(f"{d}, array({', '.join(_recipes(d, parts, max_edits))})" for d in range(-max_edits, max_edits + 1))
    sides = (
        values.withColumn("longer", F.explode(own))
        .withColumn("p", F.explode(F.expr(f"element_at(map({recipes}), longer)")))
        .select("grp", "v", F.col("p.still").alias("still"), F.expr(_signature(parts, max_edits)).alias("sig"))
        .filter(F.col("sig").isNotNull())
    )
    left = (
        values.withColumn("p", F.explode(F.expr(f"array({', '.join(r for r in _recipes(0, parts, max_edits) if 'true' in r)})")))
        .select("grp", "v", F.expr(_signature(parts, max_edits)).alias("sig"))
    )
    right = sides.withColumnRenamed("grp", "grp_b").withColumnRenamed("v", "v_b")
    near = (
        (F.col("grp") == F.col("grp_b"))
        & F.when(F.col("still"), F.col("v") < F.col("v_b")).otherwise(F.col("v") != F.col("v_b"))
        & (F.levenshtein("v", "v_b", max_edits) >= 0)
    )
    return (
        left.join(right.hint("merge"), "sig")  # the planner would take the exploded sides for as small as the values
        .filter(near)
        .select("grp", F.least("v", "v_b").alias("value_a"), F.greatest("v", "v_b").alias("value_b"))
        .distinct()
    )
