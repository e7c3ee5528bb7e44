"""Check of parsed reads against the expected index of their sample and the tolerant motif."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..design import Design
from ..functions.motifs import motif_tolerant
from ..functions.sequences import index_matches

#: The expected indexes, a row per sample, are broadcast up to so many; beyond they are joined by shuffle.
BROADCAST_SAMPLES = 200_000


def expected_indexes(index_map: DataFrame, order: str) -> DataFrame:
    """One row per `sample`: of several the last in `order` counts. `expected_index` is stripped and upper-cased."""
    strip = F.upper(F.regexp_replace("expected_index", r"^\s+|\s+$", ""))
    return index_map.groupBy("sample").agg(F.max_by(strip, F.col(order)).alias("expected_index"))


def filter_reasons(parsed: DataFrame, expected: DataFrame, design: Design = Design()) -> DataFrame:
    """Adds `filter_reason`: 'index_mismatch', else 'motif_absent', else NULL for reads that are kept. Reads of samples
    without an expected index are left out (see unmapped_samples); a null index or barcode doesn't match."""
    few = expected.count() <= BROADCAST_SAMPLES
    joined = parsed.join(F.broadcast(expected) if few else expected, "sample")
    seen = F.upper(F.coalesce("combined_index", F.lit("")))
    index_ok = index_matches(seen, F.coalesce("expected_index", F.lit("")), design.index_chunk_len, design.index_max_mismatch)
    motif_ok = motif_tolerant(F.coalesce("barcode", F.lit("")), design.barcode_motif, design.motif_max_mismatch)
    reason = F.when(~index_ok, "index_mismatch").when(~motif_ok, "motif_absent")
    return joined.withColumn("filter_reason", reason).drop("expected_index")


def unmapped_samples(parsed: DataFrame, expected: DataFrame) -> DataFrame:
    """Samples with reads but without an expected index."""
    return parsed.select("sample").distinct().join(expected, "sample", "left_anti")


def filter_summary(filtered: DataFrame, samples: DataFrame | None = None) -> DataFrame:
    """Per sample the reads kept and rejected, and the share kept. With `samples` (`sample`) a row for each of these, zeros for
    those without reads."""
    reason = F.col("filter_reason")
    counts = filtered.groupBy("sample").agg(
        F.count_if(reason.isNull()).alias("kept"),
        F.count_if(reason == "index_mismatch").alias("index_mismatch"),
        F.count_if(reason == "motif_absent").alias("motif_absent"),
        F.count(F.lit(1)).alias("total"),
    )
    if samples is not None:
        counts = samples.select("sample").distinct().join(counts, "sample", "left").na.fill(0)
    share = F.try_divide(F.col("kept").cast("double"), F.col("total").cast("double"))
    return counts.withColumn("kept_fraction", F.coalesce(share, F.lit(0.0)))
