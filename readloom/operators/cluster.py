"""Barcode counts and the merge of error variants into more abundant barcodes."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..design import Design
from ..plans.shared import cut


def barcode_counts(parsed: DataFrame) -> DataFrame:
    """Reads per sample and barcode; null barcodes are none."""
    return parsed.filter(F.col("barcode").isNotNull()).groupBy("sample", "barcode").agg(F.count(F.lit(1)).alias("cnt"))


def block(barcode: Column, i: int, n: int) -> Column:
    """The i-th of the barcode's n near-equal contiguous blocks."""
    length = F.length(barcode)
    start, end = (F.floor(length * k / n).cast("int") for k in (i, i + 1))
    return F.substring(barcode, start + 1, end - start)


def blocks(barcode: Column, n: int) -> Column:
    """The barcode's blocks as an array of (idx, block)."""
    return F.array(*[F.struct(F.lit(i).alias("idx"), block(barcode, i, n).alias("block")) for i in range(n)])


def merge_edges(counts: DataFrame, design: Design = Design()) -> DataFrame:
    """Possible merges: `sample`, `child`, `parent`, `dist`, `block_idx` (the first block that both share), `parent_cnt`.

    A parent precedes its child in the order of falling counts (then of letters), the child's count is at most
    `cluster_merge_ratio` of the parent's and below `cluster_protect_count`, they share a block in place and differ by
    `cluster_max_dist` edits at most. An equi-join on (sample, block) of barcodes rare enough to be a child with those frequent
    enough to be a parent; a pair with several blocks in common is taken at the first of them, so nothing is left to group.
    """
    n, ratio = design.cluster_max_dist + 1, F.lit(float(design.cluster_merge_ratio))

    def side(own: DataFrame, name: str) -> DataFrame:
        split = own.select("sample", F.col("barcode").alias(name), F.col("cnt").alias(f"{name}_cnt"), F.explode(blocks(F.col("barcode"), n)).alias("b"))
        return split.select("sample", "b.idx", "b.block", name, f"{name}_cnt")

    child = side(counts.filter(F.col("cnt") < design.cluster_protect_count), "child")
    parent = side(counts.filter(F.lit(1.0) <= ratio * F.col("cnt")), "parent")
    first = (F.col("parent_cnt") > F.col("child_cnt")) | (
        (F.col("parent_cnt") == F.col("child_cnt")) & (F.col("parent") < F.col("child"))
    )
    for i in range(n - 1):
        first = first & ~((F.col("idx") > i) & (block(F.col("child"), i, n) == block(F.col("parent"), i, n)))
    return (
        child.join(parent, ["sample", "idx", "block"])
        .filter(first & (F.col("child_cnt") <= ratio * F.col("parent_cnt")))
        .withColumn("dist", F.levenshtein("child", "parent", design.cluster_max_dist))
        .filter(F.col("dist") >= 0)
        .select("sample", "child", "parent", "dist", F.col("idx").alias("block_idx"), "parent_cnt")
    )


def merge_rounds(design: Design) -> int | None:
    """Rounds after which all barcodes are settled, the children in the longest chain of counts; None if only the data tell
    (a ratio of 1 or more). Counts are compared as in `merge_edges`, not by logarithms, which round."""
    ratio, count, rounds = float(design.cluster_merge_ratio), 1, 0
    if ratio >= 1:
        return None if design.cluster_protect_count > 1 else 0
    while ratio > 0 and count < design.cluster_protect_count:
        parent = max(count, math.floor(count / ratio) - 1)
        while count > ratio * parent:
            parent += 1
        if parent == count:  # the ratio is so near 1 that the product rounds up
            return None
        count, rounds = parent, rounds + 1
    return rounds


def assignments(counts: DataFrame, design: Design = Design()) -> DataFrame:
    """`rep` of every barcode of every sample, itself for those that aren't merged.

    A barcode without a possible parent is its own representative. In each round every barcode whose possible parents are
    all settled goes to the nearest of those that stand for themselves (of equally near ones the one of the first shared
    block, then of the highest count, then the first), or stands for itself if there is none. This equals handling
    the barcodes one by one in the order of falling counts.
    """
    edges = cut(merge_edges(counts, design))
    children = edges.select("sample", F.col("child").alias("barcode")).distinct()
    roots = counts.select("sample", "barcode", F.col("barcode").alias("rep")).join(children, ["sample", "barcode"], "left_anti")
    rank = F.struct("dist", "block_idx", (-F.col("parent_cnt")).alias("m"), "parent")
    rounds, done = merge_rounds(design), 0
    left, settled = edges, None
    while rounds is None or done < rounds:
        if rounds is None and left.isEmpty():
            break
        # what is known of parents that may be merged themselves; all others stand for themselves
        known = children.withColumn("rep", F.lit(None).cast("string")) if settled is None else children.join(settled, ["sample", "barcode"], "left")
        known = known.select("sample", F.col("barcode").alias("parent"), "rep", F.lit(True).alias("is_child"))
        is_root = F.col("is_child").isNull() | F.coalesce(F.col("rep") == F.col("parent"), F.lit(False))
        ready = (
            left.join(known, ["sample", "parent"], "left")
            .groupBy("sample", "child")
            .agg(
                F.count_if(F.col("is_child").isNotNull() & F.col("rep").isNull()).alias("open"),
                F.min(F.when(is_root, rank)).alias("best"),
            )
            .filter(F.col("open") == 0)
            .select("sample", F.col("child").alias("barcode"), F.coalesce("best.parent", "child").alias("rep"))
        )
        done += 1
        last = rounds is not None and done == rounds
        ready = ready if last else cut(ready)
        settled = ready if settled is None else settled.unionByName(ready)
        if not last:
            left = left.join(ready.select("sample", F.col("barcode").alias("child")), ["sample", "child"], "left_anti")
            left = cut(left) if rounds is None or done + 1 < rounds else left
    return roots if settled is None else roots.unionByName(settled)


def corrected_counts(counts: DataFrame, design: Design = Design()) -> DataFrame:
    """Reads per sample and representative, and their share of the sample. A barcode without one is an error."""
    rep = F.coalesce("rep", F.raise_error(F.lit("a barcode has no representative")).cast("string"))
    merged = (
        counts.join(assignments(counts, design), ["sample", "barcode"], "left")
        .groupBy("sample", rep.alias("corrected_barcode"))
        .agg(F.sum("cnt").alias("total_count"))
    )
    totals = counts.groupBy("sample").agg(F.sum("cnt").alias("_all"))  # a row per sample
    share = F.col("total_count").cast("double") / F.col("_all").cast("double")
    return merged.join(totals, "sample").withColumn("freq_within_sample", share).drop("_all")


def umi_groups(parsed: DataFrame, design: Design = Design()) -> DataFrame:
    """Per sample and barcode the number of reads and of UMI groups: in read order a UMI's prefix joins its own group, else
    the first group within `umi_group_max_dist` mismatches, else it opens one.

    Reads are first reduced to their distinct prefixes with the first read's number, of which a barcode has at most
    5^`umi_group_len`. These are sorted by barcode and order, and every task walks through its barcodes one after the other,
    holding the groups of one.
    """
    most = design.umi_group_max_dist
    prefix = F.upper(F.substring(F.coalesce("combined_umi", F.lit("")), 1, design.umi_group_len))
    first = (
        parsed.filter(F.col("barcode").isNotNull())
        .groupBy("sample", "barcode", prefix.alias("umi"))
        .agg(F.min("read_idx").alias("at"), F.count(F.lit(1)).alias("n"))
    )
    ordered = first.repartition("sample", "barcode").sortWithinPartitions("sample", "barcode", "at", "umi")
    rows = ordered.select("sample", "barcode", "umi", "n")
    return rows.mapInArrow(lambda b: _walk(b, most), "sample string, barcode string, n_reads long, n_umi_groups long")


class _Groups:
    """The UMI groups of one barcode: what opened them, found by the prefix less one letter."""

    def __init__(self, most: int):
        self.most, self.known, self.n = most, {}, 0

    def add(self, umi: str) -> None:
        keys = [(len(umi), i, umi[:i] + umi[i + 1 :]) for i in range(len(umi))] if self.most == 1 else [len(umi)]
        near = self.most > 0 and any(
            sum(x != y for x, y in zip(umi, g)) <= self.most for k in keys for g in self.known.get(k, ())
        )
        if not near:
            self.n += 1
            for k in keys:
                self.known.setdefault(k, []).append(umi)


def _walk(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Rows in order of barcodes to one row per barcode."""
    names = ["sample", "barcode", "n_reads", "n_umi_groups"]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64()]
    current, groups, reads, out = None, _Groups(most), 0, []
    for batch in batches:
        for sample, barcode, umi, n in zip(*(c.to_pylist() for c in batch.columns)):
            if (sample, barcode) != current:
                if current:
                    out.append((*current, reads, groups.n))
                current, groups, reads = (sample, barcode), _Groups(most), 0
            groups.add(umi)
            reads += n
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
            out = []
    if current:
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((*current, reads, groups.n), kinds)], names)
