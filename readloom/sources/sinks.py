"""The files that other tools expect. Parquet is the canonical form; these are exports.

Tables that grow with the reads are written by Spark, one file per sample or one sorted file: parts in parallel, which tasks
put together, a task a file. Only tables of a row per sample go through the driver.
"""

from __future__ import annotations

import csv
import io
import math
import os
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import storage
from .tables import PARSED, PARSED_SE


def fixed(value: str | Column, places: int) -> Column:
    """A double from 0 to about 10^9 as text with so many places. The double's exact binary value is rounded, half to even.

    The product with 10^places is taken with its rounding error: the factor's upper half times 10^places has no error, nor has
    the lower half's, so both sides of the tie are told apart.
    """
    d, scale = F.col(value) if isinstance(value, str) else value, F.lit(float(10**places))
    high = d * F.lit(2.0**27 + 1) - (d * F.lit(2.0**27 + 1) - d)
    product = d * scale
    error = (high * scale - product) + (d - high) * scale
    whole = F.floor(product)
    above = (product - whole - F.lit(0.5)) + error
    n = whole + F.when((above > 0) | ((above == 0) & (whole % 2 == 1)), 1).otherwise(0)
    if not places:
        return n.cast("string")
    return F.concat(F.floor(n / 10**places), F.lit("."), F.lpad((n % 10**places).cast("string"), places, "0"))


def _line(values: list, sep: str, end: str = "\n") -> bytes:
    """A line as the csv module writes it."""
    text = io.StringIO()
    csv.writer(text, delimiter=sep, lineterminator=end).writerow(values)
    return text.getvalue().encode()


def _join(folder: str, target: str, names: list[str], sep: str) -> None:
    """Puts Spark's sorted part files behind a header into one file, as streams of bytes."""

    def blocks() -> Iterator[bytes]:
        yield _line(names, sep)
        for part in storage.part_names(folder):
            with storage.open_in(f"{folder}/{part}") as own:
                while block := own.read(1 << 20):
                    yield block

    storage.write_whole(target, blocks())


def _join_all(spark: SparkSession, files: list[tuple[str, str]], names: list[str], sep: str) -> None:
    """_join() of each (folder, target), in tasks."""
    if files:
        whole = [tuple(map(storage.uri, f)) for f in files]  # tasks may have another working folder
        tasks = min(len(files), 2 * spark.sparkContext.defaultParallelism)
        rows = spark.createDataFrame(whole, "folder string, target string").repartition(tasks)
        rows.foreach(lambda r: _join(r["folder"], r["target"], names, sep))


def _options(sep: str) -> dict:
    return {"sep": sep, "emptyValue": "", "nullValue": "", "quote": '"' if sep == "," else "\0"}


def one_file(df: DataFrame, target: str, order: list, shown: list[str]) -> None:
    """One sorted CSV file. Spark sorts and formats in parallel."""
    tmp = f"{target}.{uuid.uuid4().hex}"
    df.orderBy(*order).select(*[F.col(f"`{c}`") for c in shown]).write.csv(storage.uri(tmp), **_options(","))
    _join_all(df.sparkSession, [(tmp, target)], shown, ",")
    storage.remove_folder(tmp)


def per_sample(df: DataFrame, samples: list[str], folder: str, ending: str, sep: str = "\t", with_sample: bool = False) -> None:
    """A file per sample, in the order of the column `_o`, which isn't written; samples without rows get a header only.
    Rows are split by ranges of (sample, order), so that a large sample takes several tasks."""
    storage.make_folder(folder)
    tmp = os.path.join(folder, f"_{uuid.uuid4().hex}")
    keep = [c for c in df.columns if c != "_o" and (c != "sample" or with_sample)]
    ranges = df.withColumn("_s", F.col("sample")).repartitionByRange("_s", "_o").sortWithinPartitions("_s", "_o")
    ranges.select(*keep, "_s").write.partitionBy("_s").csv(storage.uri(tmp), **_options(sep))
    files = [(os.path.join(tmp, f"_s={_escaped(sample)}"), os.path.join(folder, sample + ending)) for sample in samples]
    _join_all(df.sparkSession, files, keep, sep)
    storage.remove_folder(tmp)


def _escaped(name: str) -> str:
    """A partition value as it stands in a path."""
    return "".join(f"%{ord(c):02X}" if c in "\"#%'*/:=?\\{[]^\x7f" or ord(c) < 32 else c for c in name)


def write_parsed(
    parsed: DataFrame, modes: dict[str, str], folder: str, extra: tuple[str, ...] = (), ending: str = ".parsed.tsv"
) -> None:
    """Parsed tables per sample, of 8 columns for paired-end samples and 5 for single-end ones."""
    storage.make_folder(folder)
    for mode, names in (("PE", list(PARSED)), ("SE", PARSED_SE)):
        samples = [s for s, m in modes.items() if m == mode]
        if samples:
            own = parsed.filter(F.col("sample").isin(samples))
            shown = own.select("sample", *[F.col(PARSED[n]).alias(n) for n in names], *extra, F.col("read_idx").alias("_o"))
            per_sample(shown, samples, folder, ending)


def write_stats(counters: DataFrame, folder: str) -> list:
    """The counters of each sample as lines `# Key<TAB>value`; returns the rows (one per sample)."""
    storage.make_folder(folder)
    rows = counters.collect()
    for r in rows:
        keys = ("total_reads", "passed", "quality_fail", "regex_fail", "overlap_fail")
        lines = [f"# {k.capitalize()}\t{r[k]}\n" for k in keys] + [f"# Pass_fraction\t{r['pass_fraction']:.4f}\n"]
        storage.write_whole(os.path.join(folder, f"{r['sample']}.stats.tsv"), ["".join(lines).encode()])
    return rows


def write_unmatched(tally: DataFrame, samples: list[str], folder: str) -> None:
    """The most frequent unmatched prefixes of each sample."""
    shown = tally.select("sample", "sequence_prefix", F.col("n_reads").alias("count"), F.col("place").alias("_o"))
    per_sample(shown, samples, folder, ".unmatched.tsv")


def write_filter_summary(summary: DataFrame, target: str) -> list:
    """`sample,kept,index_mismatch,motif_absent,total,kept_fraction`, in order of samples; returns the rows."""
    rows = summary.orderBy("sample").collect()
    storage.make_folder(os.path.dirname(target) or ".")
    names = ["sample", "kept", "index_mismatch", "motif_absent", "total"]
    lines = [[*names, "kept_fraction"], *([*[r[n] for n in names], f"{r['kept_fraction']:.4f}"] for r in rows)]
    storage.write_whole(target, [_line(values, ",", "\r\n") for values in lines])
    return rows


def write_corrected(corrected: DataFrame, samples: list[str], folder: str) -> None:
    """A CSV file of corrected barcodes per sample, by falling counts."""
    storage.make_folder(folder)
    share = fixed("freq_within_sample", 6).alias("freq_within_sample")
    order = F.struct(-F.col("total_count"), "corrected_barcode").alias("_o")
    shown = corrected.select("sample", "corrected_barcode", "total_count", share, order)
    per_sample(shown, samples, folder, ".corrected_barcodes.csv", ",", with_sample=True)


def _lines_of(row, named: str) -> list[tuple[float, str, str]]:
    """The vertical lines of a histogram: the cutoff share and the reference it comes from."""
    drawn = (("cutoff_freq", "--", f"cutoff {named}"), ("reference_freq", ":", "reference"))
    return [(row[c], style, f"{text}: {row[c]:.2e}") for c, style, text in drawn if row and row[c]]


def write_histograms(histogram: DataFrame, folder: str, lines: dict | None = None, named: str = "") -> list[str]:
    """A picture per sample if matplotlib is there; else none. The bins come from Spark. `lines` has by sample the row of the map
    log, whose cutoff and reference share are drawn; `named` says what the cutoff is."""
    try:
        import matplotlib

        matplotlib.use("Agg")
        import matplotlib.pyplot as plt
    except ImportError:
        return []
    storage.make_folder(folder)
    rows = histogram.orderBy("sample", "bin").collect()  # at most 60 per sample
    out = []
    for sample in sorted({r["sample"] for r in rows}):
        own = [r for r in rows if r["sample"] == sample]
        left, width = [r["bin_lo"] for r in own], [r["bin_hi"] - r["bin_lo"] for r in own]
        kept, dropped = [r["n_kept"] for r in own], [r["n_dropped"] for r in own]
        fig, ax = plt.subplots(figsize=(8, 5))
        ax.bar(left, kept, width, align="edge", label=f"kept ({sum(kept)})")
        ax.bar(left, dropped, width, bottom=kept, align="edge", label=f"dropped ({sum(dropped)})")
        for value, style, text in _lines_of((lines or {}).get(sample), named):
            ax.axvline(math.log10(value), linestyle=style, color="0.3", label=text)
        ax.set(title=f"{sample}: {sum(dropped)} of {sum(kept) + sum(dropped)} dropped", xlabel="log10 of the share of the sample", ylabel="barcodes")
        ax.legend()
        out.append(os.path.join(folder, f"{sample}.count_distribution.png"))
        picture = io.BytesIO()
        fig.savefig(picture, dpi=120)
        storage.write_whole(out[-1], [picture.getvalue()])
        plt.close(fig)
    return out
