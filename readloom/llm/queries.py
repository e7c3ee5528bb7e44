"""Queries of the training-data problems over the test tables."""

from __future__ import annotations

import importlib.util
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cleaning import clean_value
from ..plans.session import table
from ..plans.shared import cut
from .distinct_counts import matrices, merged_counts
from .frequent_items import frequent_items, merging_steps
from .leakage import leaked_spans, leaks
from .near_duplicates import similar_pairs
from .oracle import ORACLE  # noqa: F401
from .overlaps import K, estimated_overlaps, exact_overlaps, pairs_sharing, sets_of
from .quality import judged, junk
from .term_frequencies import mark, term_frequencies
from .tokenizing import token_ids

def _barcode() -> Column:
    return clean_value("barcode")


def _umi() -> Column:
    return clean_value("combined_umi")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of barcodes of a sample that at most two letter edits part."""
    pairs = similar_pairs(table(spark, sf_dir, "parsed"), F.col("sample_name"), _barcode())
    return pairs.select(F.col("grp").alias("sample_name"), F.col("value_a").alias("barcode_a"), F.col("value_b").alias("barcode_b"))


def _reads(df: DataFrame, *values) -> DataFrame:
    """Every read once, however often it was delivered: deliveries differ in loaded_at only."""
    return df.select("sample_name", "read_idx", *values).distinct()


def _field_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads that have a value, of the two fields whose frequent values are asked for."""
    parts = [("parsed", "barcode"), ("unmatched", "sequence_prefix")]
    rows = [
        table(spark, sf_dir, t).select(F.lit(c).alias("field_name"), clean_value(c).alias("item_value"), "sample_name", "read_idx")
        for t, c in parts
    ]
    return rows[0].unionByName(rows[1]).filter(F.col("item_value").isNotNull())


def p2_top_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent values with approximate numbers of reads: `low_reads` <= true number <= `high_reads`."""
    items = frequent_items(_field_reads(spark, sf_dir).distinct(), steps=_steps(spark))
    return items.filter((F.col("low") + F.col("lost")) * 500 >= F.col("weight")).select(
        "field_name", "item_value", F.col("low").alias("low_reads"), (F.col("low") + F.col("lost")).alias("high_reads")
    )


def _exact(rows: DataFrame, items: DataFrame) -> DataFrame:
    """Adds the exact number `n` of reads to a summary's items: at most COUNTERS of each of the two fields, so they are
    collected and broadcast."""
    wanted = [tuple(r) for r in items.select("field_name", "item_value", "low", "lost", "weight").collect()]
    few = rows.sparkSession.createDataFrame(wanted, "field_name string, item_value string, low long, lost long, weight long")
    known = rows.join(F.broadcast(few), ["field_name", "item_value"]).distinct()
    return known.groupBy(*few.columns).agg(F.count(F.lit(1)).alias("n"))


def _steps(spark: SparkSession) -> int:
    """Merging steps for the partitions that a shuffle gives."""
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    return merging_steps(max(int(spark.conf.get(name, None) or 1) for name in names))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values held by at least 1 % of the reads with a value: the summary's candidates, at most 1,000 a field, counted
    exactly."""
    rows = _field_reads(spark, sf_dir)
    items = frequent_items(rows.distinct(), steps=_steps(spark))
    exact = _exact(rows, items.filter((F.col("low") + F.col("lost")) * 100 >= F.col("weight")))
    return exact.filter(F.col("n") * 100 >= F.col("weight")).select("field_name", "item_value")


def p2_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values held by at least 0.2 % of the reads with a value, with their exact number of reads, and whether the summary's bounds
    hold for it."""
    rows = _field_reads(spark, sf_dir)
    items = frequent_items(rows.distinct(), steps=_steps(spark))
    exact = _exact(rows, items.filter((F.col("low") + F.col("lost")) * 500 >= F.col("weight")))
    within = F.col("n").between(F.col("low"), F.col("low") + F.col("lost"))
    return exact.filter(F.col("n") * 500 >= F.col("weight")).select(
        "field_name", "item_value", F.col("n").alias("n_reads"), within.alias("within_bounds")
    )


def _terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read and sample counts of all values with their marks."""
    parsed = table(spark, sf_dir, "parsed")
    reads = _reads(parsed, _barcode().alias("barcode"), _umi().alias("combined_umi"))
    fields = {"barcode": F.col("barcode"), "combined_umi": F.col("combined_umi")}
    terms = cut(term_frequencies(reads, fields, F.col("sample_name")))
    samples = parsed.select(F.count_distinct("sample_name")).first()[0]
    with_umi = terms.filter("field_name = 'combined_umi'").agg(F.coalesce(F.sum("n_reads"), F.lit(0))).first()[0]
    is_barcode = F.col("field_name") == "barcode"
    return mark(
        terms,
        {
            "rare": is_barcode & (F.col("n_reads") == 1),
            "common:in many samples": is_barcode & (F.col("n_records") * 2 >= samples),
            "common:in many reads": ~is_barcode & (F.col("n_reads") * 250 >= with_umi),
        },
    )


def p3_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads and samples of every distinct barcode and UMI, and what speaks against it."""
    return _terms(spark, sf_dir).select(
        "field_name", "item_value", "n_reads", F.col("n_records").alias("n_samples"), F.array_join("marks", ",").alias("marks")
    )


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that are too rare or too common."""
    return _terms(spark, sf_dir).select("field_name", "item_value", F.explode("marks").alias("mark"))


def _memberships(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = table(spark, sf_dir, "barcode_x_sample_counts")
    return sets_of(cells, F.col("sample_name"), _barcode(), F.col("total_count") > 0)


def p4_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Estimated shared barcodes of each pair of samples."""
    return estimated_overlaps(_memberships(spark, sf_dir)).select(
        F.col("set_a").alias("sample_a"), F.col("set_b").alias("sample_b"), "size_a", "size_b", "union_size", "shared", "shared_error"
    )


def _sharing(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    pairs = pairs_sharing(_memberships(spark, sf_dir), 0.3, k)
    return pairs.select(F.col("set_a").alias("sample_a"), F.col("set_b").alias("sample_b"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs that share at least 0.3 of the smaller sample's barcodes: settled by sketches, counted exactly near the bound."""
    return _sharing(spark, sf_dir, K)


def p4_found_by_small_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with 256 hashes a sample, fewer than most samples have barcodes in small tables too."""
    return _sharing(spark, sf_dir, 256)


def p4_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact number of shared barcodes of each pair of samples, and whether the estimate by 256 hashes lies within five
    standard errors of it (and of the sizes' error)."""
    sets = _memberships(spark, sf_dir)
    some = cut(estimated_overlaps(sets, 256))
    exact = exact_overlaps(sets, some.select("set_a", "set_b")).select("set_a", "set_b", "n_shared")
    whole = some.join(exact, ["set_a", "set_b"], "left").withColumn("n_shared", F.coalesce("n_shared", F.lit(0)))
    error = 5 * F.col("shared_error") + F.col("shared") * (5 / 256**0.5)
    return whole.select(
        F.col("set_a").alias("sample_a"), F.col("set_b").alias("sample_b"), "n_shared",
        (F.abs(F.col("shared") - F.col("n_shared")) <= error + 1e-6).alias("within_bounds"),
    )


def p5_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Estimated distinct barcodes and UMIs per day, sample, lane and every combination; bits 4, 2, 1 of `grouping_id`
    tell day, sample and lane that are summed over."""
    keys = {k: F.col(k) for k in ("run_day", "sample_name", "lane_no")}
    partial = matrices(table(spark, sf_dir, "parsed"), keys, {"barcode": _barcode(), "combined_umi": _umi()})
    return merged_counts(partial, list(keys))


def p5_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact distinct counts of the same combinations, and whether the estimate lies within five standard errors."""
    keys = ("run_day", "sample_name", "lane_no")
    rows = table(spark, sf_dir, "parsed").select(*keys, _barcode().alias("barcode"), _umi().alias("combined_umi")).distinct()
    exact = rows.cube(*keys).agg(
        F.grouping_id().alias("grouping_id"), F.count_distinct("barcode").alias("barcode"), F.count_distinct("combined_umi").alias("combined_umi")
    ).unpivot(["grouping_id", *keys], ["barcode", "combined_umi"], "field_name", "n_exact")
    both = p5_distinct(spark, sf_dir).withColumnRenamed("grouping_id", "g")
    same = [F.col(f"e.{c}").eqNullSafe(F.col(f"d.{c}")) for c in (*keys, "field_name")]
    joined = exact.alias("e").join(both.alias("d"), [F.col("e.grouping_id") == F.col("d.g"), *same], "left")
    near = F.abs(F.coalesce("d.n_distinct", F.lit(0)) - F.col("e.n_exact")) <= 5 * F.coalesce("d.std_error", F.lit(0.0)) + 0.5
    return joined.select("e.grouping_id", *[f"e.{c}" for c in (*keys, "field_name", "n_exact")], near.alias("within_bounds"))


def ranks_path() -> str:
    """The vocabulary's rank file on the driver: READLOOM_RANKS, else that of the installed package public_tokenizers."""
    if named := os.environ.get("READLOOM_RANKS"):
        return named
    package = importlib.util.find_spec("public_tokenizers")
    if package is None:
        raise FileNotFoundError("install public_tokenizers or name a rank file in READLOOM_RANKS")
    return os.path.join(os.path.dirname(package.origin), "byte_bpe_50k.tiktoken")


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return token_ids(table(spark, sf_dir, "documents"), ranks_path())


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the passages that leaked into them."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p8_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leaked spans, in words of the document."""
    return leaked_spans(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that are no natural prose."""
    return junk(table(spark, sf_dir, "documents"), table(spark, sf_dir, "common_words"))


def p9_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statistics of every document."""
    from .quality import text_statistics

    return text_statistics(table(spark, sf_dir, "documents"), table(spark, sf_dir, "common_words"))


def p9_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The learned rule list's verdict on every document."""
    return judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "common_words")).select("doc_id", "verdict")


QUERIES = {
    f.__name__: f
    for f in (
        p1_found, p2_found, p2_top_values, p2_bounds, p3_found, p3_terms, p4_found, p4_found_by_small_sketches, p4_overlaps, p4_bounds, p5_distinct, p5_bounds, p7_ids, p8_found,
        p8_spans, p9_found, p9_statistics, p9_verdicts,
    )
}
