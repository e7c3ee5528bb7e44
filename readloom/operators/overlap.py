"""Barcodes across samples: cutoffs, matrices, overlap summary and histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A matrix has a column per sample; more samples than this are refused, the long form has no such limit.
MATRIX_SAMPLES = 10_000


def usable_counts(
    cells: DataFrame, min_count: int = 2, keys: tuple[str, ...] = ("sample",), first: str | None = None
) -> DataFrame:
    """`sample`, `barcode`, `cnt`: cells without an ambiguous base and with at least `min_count` reads each, added up.
    `keys` names what is added up and judged apart: the sample, or the files of a sample. `first` names a column whose least
    value, that of the first usable cell, is kept."""
    clear = ~F.contains(F.upper("barcode"), F.lit("N"))
    kept = cells.filter(F.col("barcode").isNotNull() & clear & (F.col("cnt") >= min_count))
    place = [F.min(first).alias(first)] if first else []
    return kept.groupBy(*keys, "barcode").agg(F.sum("cnt").alias("cnt"), *place)


def relative_abundance(
    counts: DataFrame, fraction: float = 0.0, relative_to: str = "median", keys: tuple[str, ...] = ("sample",)
) -> DataFrame:
    """Adds per sample the barcode's share `freq`, the `reference_freq` (mean or median share), `cutoff_freq`, its
    `fraction`, the sample's `n_total` barcodes, and `dropped`: a share strictly below the cutoff.

    Without a positive fraction, and in samples of one barcode, the references are null and nothing is dropped. Statistics are
    a row per sample, joined back, so a sample that holds a third of all rows isn't gathered in one window.
    """
    if relative_to not in ("mean", "median"):
        raise ValueError(f"relative_to must be 'mean' or 'median', not {relative_to!r}")
    totals = counts.groupBy(*keys).agg(
        F.sum("cnt").alias("sample_total"), F.count(F.lit(1)).alias("n_total"),
        (F.avg(F.col("cnt").cast("double")) if relative_to == "mean" else F.median("cnt")).alias("middle"),
    )
    share = F.col("cnt").cast("double") / F.col("sample_total").cast("double")
    active = (F.lit(fraction) > 0) & (F.col("n_total") > 1) & (F.col("sample_total") > 0)
    reference = F.when(active, F.col("middle") / F.col("sample_total").cast("double"))
    return (
        counts.join(totals, list(keys))
        .withColumn("freq", F.when(F.col("sample_total") > 0, share))
        .withColumn("reference_freq", reference)
        .withColumn("cutoff_freq", F.lit(float(fraction)) * F.col("reference_freq"))
        .withColumn("dropped", F.coalesce(F.col("freq") < F.col("cutoff_freq"), F.lit(False)))
        .drop("middle")
    )


def surviving(counts: DataFrame) -> DataFrame:
    """`sample`, `barcode`, `cnt` of what the cutoff left."""
    return counts.filter(~F.col("dropped")).select("sample", "barcode", "cnt")


def pooled(counts: DataFrame) -> DataFrame:
    """The same, what the cutoff left in the files of one sample added up."""
    return surviving(counts).groupBy("sample", "barcode").agg(F.sum("cnt").alias("cnt"))


def first_places(counts: DataFrame, first: str = "position") -> DataFrame:
    """Per barcode where it first survives: among equals the matrices list it there."""
    return counts.filter(~F.col("dropped")).groupBy("barcode").agg(F.min(first).alias(first))


def with_frequency(counts: DataFrame) -> DataFrame:
    """Adds `freq`, the share of the sample's surviving reads: the matrix in long form."""
    totals = counts.groupBy("sample").agg(F.sum("cnt").alias("all"))
    share = F.col("cnt").cast("double") / F.col("all").cast("double")
    return counts.join(totals, "sample").withColumn("freq", share).drop("all")


def matrix(counts: DataFrame, value: str = "cnt", samples: list[str] | None = None) -> DataFrame:
    """One row per barcode, one column per sample in order of names; gaps are null. Cells are numbers, or texts of which there is
    one each."""
    if samples is None:
        rows = counts.select("sample").distinct().orderBy("sample").limit(MATRIX_SAMPLES + 1).collect()
        samples = [r["sample"] for r in rows]
    if len(samples) > MATRIX_SAMPLES:
        raise ValueError(f"a matrix of more than {MATRIX_SAMPLES} samples; use the long form")
    return counts.groupBy("barcode").pivot("sample", samples).agg((F.max if dict(counts.dtypes)[value] == "string" else F.sum)(value))


def overlap_summary(counts: DataFrame) -> DataFrame:
    """Per barcode the number and the sorted names of its samples and all its reads."""
    return counts.groupBy("barcode").agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.array_join(F.sort_array(F.collect_list("sample")), ";").alias("samples"),  # at most all samples' names
        F.sum("cnt").alias("total_count"),
    )


def map_log(counts: DataFrame, keys: tuple[str, ...] = ("sample",)) -> DataFrame:
    """Per sample what the cutoff dropped."""
    return counts.groupBy(*keys, "n_total", "sample_total", "reference_freq", "cutoff_freq").agg(
        F.count_if("dropped").alias("n_dropped")
    )


def histogram(counts: DataFrame) -> DataFrame:
    """Per sample the barcodes by bin of log10(freq), kept and dropped: `bin` from 0, its edges, `n_kept`, `n_dropped`.

    Bins: twice the square root of the sample's barcodes, between 10 and 60, over the range of all of them (half a unit to
    either side if they are equal); the last bin is closed.
    """
    logged = counts.filter(F.col("freq") > 0).withColumn("x", F.log10("freq"))
    ranges = logged.groupBy("sample").agg(
        F.min("x").alias("x0"), F.max("x").alias("x1"), F.max("n_total").alias("n")
    )
    same = F.col("x0") == F.col("x1")
    ranges = ranges.select(
        "sample", F.when(same, F.col("x0") - 0.5).otherwise(F.col("x0")).alias("lo"),
        F.when(same, F.col("x1") + 0.5).otherwise(F.col("x1")).alias("hi"),
        F.greatest(F.lit(10), F.least(F.lit(60), F.floor(F.sqrt(F.col("n").cast("double")) * 2))).cast("int").alias("n_bins"),
    )
    step = (F.col("hi") - F.col("lo")) / F.col("n_bins")
    place = F.floor((F.col("x") - F.col("lo")) / step).cast("int")
    return (
        logged.join(ranges, "sample")
        .withColumn("bin", F.greatest(F.lit(0), F.least(place, F.col("n_bins") - 1)))
        .groupBy("sample", "bin", "n_bins", "lo", "hi")
        .agg(F.count_if(~F.col("dropped")).alias("n_kept"), F.count_if("dropped").alias("n_dropped"))
        .withColumn("bin_lo", F.col("lo") + step * F.col("bin"))
        .withColumn("bin_hi", F.col("lo") + step * (F.col("bin") + 1))
        .drop("lo", "hi")
    )
