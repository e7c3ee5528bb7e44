"""From reads to parsed rows, counters and the tally of unmatched reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..design import Design
from ..functions.sequences import quality_ok, rev_comp, share_kmer
from ..functions.structure import exact_parts, fuzzy_read, primer_possible

PASSED, QUALITY, STRUCTURE, OVERLAP = "passed", "quality_fail", "regex_fail", "overlap_fail"


def classify(reads: DataFrame, design: Design = Design()) -> DataFrame:
    """Adds to reads (`r1_seq`, `r1_qual`, `r2_seq`, `r2_qual`, null for single-end ones) `status` and the parts `p1` (idx,
    umi, barcode, down) and `p2` (idx, umi, down) with `best_overlap_dist`.

    The first failure counts: quality, then structure, then the overlap of paired reads. A null read 1 fails by quality.
    Nothing is shuffled; only reads with a few errors in a primer, or pairs without a shared k-mer, reach Python, once.
    """
    paired = F.col("r2_seq").isNotNull()
    good = quality_ok(F.col("r1_qual"), design.r1_quality_len, design.qmin) & F.col("r1_seq").isNotNull()
    good2 = quality_ok(F.col("r2_qual"), design.r2_quality_len, design.qmin)
    df = reads.withColumn("_good", good & (~paired | good2))
    df = df.withColumn("_f1", F.when(F.col("_good"), exact_parts(F.col("r1_seq"), design, 1)))
    df = df.withColumn("_f2", F.when(F.col("_good") & paired, exact_parts(F.col("r2_seq"), design, 2)))
    near = share_kmer(F.col("_f1.down"), rev_comp(F.col("_f2.down")), design.overlap_k)
    known = F.when(paired, near).otherwise(F.col("_f1.idx").isNotNull())
    df = df.withColumn("_known", F.coalesce(known, F.lit(False)))
    possible = primer_possible(F.col("r1_seq"), design, 1) & (~paired | primer_possible(F.col("r2_seq"), design, 2))
    open_ = F.col("_good") & ~F.col("_known") & possible
    df = df.withColumn("_s", fuzzy_read(F.when(open_, F.col("r1_seq")), F.when(open_, F.col("r2_seq")), design))
    either = lambda fast, slow: F.when(F.col("_known"), F.col(fast)).otherwise(F.col(f"_s.{slow}")).alias(fast[4:])
    df = df.withColumns(
        {
            "p1": F.struct(either("_f1.idx", "idx1"), either("_f1.umi", "umi1"), either("_f1.barcode", "barcode"), either("_f1.down", "down1")),
            "p2": F.struct(either("_f2.idx", "idx2"), either("_f2.umi", "umi2"), either("_f2.down", "down2")),
            "best_overlap_dist": F.when(F.col("_known") & paired, F.lit(0)).otherwise(F.col("_s.dist")),
        }
    )
    df = df.withColumn("_fits", F.col("p1.idx").isNotNull() & (~paired | F.col("p2.idx").isNotNull()))
    apart = paired & (F.col("best_overlap_dist").isNull() | (F.col("best_overlap_dist") > design.overlap_max_mismatch))
    status = (
        F.when(~F.col("_good"), QUALITY).when(~F.col("_fits"), STRUCTURE).when(apart, OVERLAP).otherwise(PASSED)
    )
    return df.withColumn("status", status).drop("_good", "_fits", "_f1", "_f2", "_known", "_s")


def parsed_rows(classified: DataFrame) -> DataFrame:
    """The passed reads' columns; those of read 2 are null for single-end reads."""
    return classified.filter(F.col("status") == PASSED).select(
        "sample", F.when(F.col("r2_seq").isNull(), "SE").otherwise("PE").alias("mode"), "read_idx",
        F.concat("p1.umi", F.coalesce("p2.umi", F.lit(""))).alias("combined_umi"),
        F.concat("p1.idx", F.coalesce("p2.idx", F.lit(""))).alias("combined_index"),
        F.col("p1.barcode").alias("barcode"), F.col("p1.idx").alias("index1"), F.col("p2.idx").alias("index2"),
        F.col("p1.umi").alias("umi1"), F.col("p2.umi").alias("umi2"), "best_overlap_dist",
    )


def read_counters(classified: DataFrame, samples: DataFrame | None = None) -> DataFrame:
    """Per sample the reads by status and the share that passed. With `samples` (`sample`) a row for each of these, zeros for
    those without reads."""
    count = lambda s: F.count_if(F.col("status") == s).alias(s)
    counts = classified.groupBy("sample").agg(
        F.count(F.lit(1)).alias("total_reads"), count(PASSED), count(QUALITY), count(STRUCTURE), count(OVERLAP)
    )
    if samples is not None:
        counts = samples.select("sample").distinct().join(counts, "sample", "left").na.fill(0)
    share = F.try_divide(F.col("passed").cast("double"), F.col("total_reads").cast("double"))
    return counts.withColumn("pass_fraction", F.coalesce(share, F.lit(0.0)))


def unmatched_tally(failed: DataFrame, top: int | None = 50) -> DataFrame:
    """Per `sample` the `sequence_prefix`es of reads that failed the structure, with their number; the `top` most
    frequent, of equally frequent ones those read first. Expects `sample`, `read_idx`, `sequence_prefix`."""
    counts = failed.groupBy("sample", "sequence_prefix").agg(
        F.count(F.lit(1)).alias("n_reads"), F.min("read_idx").alias("first_idx")
    )
    if top is None:
        return counts
    order = Window.partitionBy("sample").orderBy(F.desc("n_reads"), "first_idx", "sequence_prefix")
    return counts.withColumn("place", F.row_number().over(order).cast("long")).filter(F.col("place") <= top)


def unmatched_of(classified: DataFrame) -> DataFrame:
    """The structure failures of classified reads in the form that unmatched_tally() expects."""
    failed = classified.filter(F.col("status") == STRUCTURE)
    return failed.select("sample", "read_idx", F.substring("r1_seq", 1, 60).alias("sequence_prefix"))
