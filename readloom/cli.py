"""Command line: extract, filter, cluster, map and run, on files of a shared file system."""

from __future__ import annotations

import argparse
import logging
import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .design import Design
from .operators import cluster, extract, index_filter, overlap
from .plans.session import session
from .plans.shared import cut, spread
from .sources import sinks, storage, tables
from .sources.discovery import SampleFiles, find_samples, sample_names
from .sources.fastq import read_samples

log = logging.getLogger("readloom")


def run_extract(spark: SparkSession, found: dict[str, SampleFiles], outdir: str, design: Design) -> DataFrame:
    """Writes parsed tables, counters and unmatched prefixes of every sample; returns the parsed rows."""
    for s in found.values():
        log.info("[extract] %s (%s): R1=%s R2=%s", s.sample, s.mode, s.r1, s.r2)
    classified = cut(extract.classify(spread(read_samples(spark, found)), design))
    parsed = extract.parsed_rows(classified)
    sinks.write_parsed(parsed, {s.sample: s.mode for s in found.values()}, outdir)
    for r in sinks.write_stats(extract.read_counters(classified, _names(spark, found)), outdir):
        log.info("[extract] %s: passed %d of %d (%.2f%%)", r["sample"], r["passed"], r["total_reads"], 100 * r["pass_fraction"])
    sinks.write_unmatched(extract.unmatched_tally(extract.unmatched_of(classified), design.top_unmatched_n), list(found), outdir)
    return parsed


def _names(spark: SparkSession, samples) -> DataFrame:
    """Names of samples as a table."""
    return spark.createDataFrame([(s,) for s in samples], "sample string")


def run_filter(
    spark: SparkSession, parsed: DataFrame, modes: dict[str, str], index_map: str, outdir: str, design: Design
) -> DataFrame:
    """Writes kept and rejected reads and the summary of the samples named in `modes`, those without reads included; returns the
    kept rows."""
    expected = index_filter.expected_indexes(tables.index_map(spark, index_map), "line_no")
    mapped = _names(spark, modes).join(expected, "sample", "left_semi")
    named = {r["sample"] for r in mapped.collect()}
    for sample in sorted(modes.keys() - named):
        log.warning("[filter] no expected index for sample %s, skipping", sample)
    modes = {s: m for s, m in modes.items() if s in named}
    filtered = cut(index_filter.filter_reasons(parsed, expected, design))
    reason = F.coalesce("filter_reason", F.lit("")).alias("filter_reason")
    for name, rows in (("kept", filtered.filter("filter_reason is null")), ("filtered", filtered.filter("filter_reason is not null"))):
        sinks.write_parsed(rows.withColumn("filter_reason", reason), modes, os.path.join(outdir, name), ("filter_reason",), f".{name}.tsv")
    for r in sinks.write_filter_summary(index_filter.filter_summary(filtered, _names(spark, modes)), os.path.join(outdir, "filter_summary.csv")):
        log.info("[filter] %s: kept %d of %d", r["sample"], r["kept"], r["total"])
    return filtered.filter("filter_reason is null")


def run_cluster(parsed: DataFrame, samples: list[str], outdir: str, design: Design) -> DataFrame:
    """Writes the corrected barcodes of every sample; returns them."""
    corrected = cut(cluster.corrected_counts(cut(cluster.barcode_counts(parsed)), design))
    sinks.write_corrected(corrected, samples, outdir)
    for r in corrected.groupBy("sample").agg(F.count("*").alias("n"), F.sum("total_count").alias("reads")).collect():
        log.info("[cluster] %s: %d corrected barcodes, %d reads", r["sample"], r["n"], r["reads"])
    return corrected


def run_map(cells: DataFrame, outdir: str, min_count: int, fraction: float, relative_to: str, plot: bool) -> None:
    """Writes the two matrices, the overlap summary and the histograms. The cutoff is each file's own; files of one sample
    are added up after it, and the sample's histogram is that of its last file."""
    keys = ("sample", "file")
    storage.make_folder(outdir)
    usable = overlap.usable_counts(cells, min_count, keys, "position")
    judged = cut(overlap.relative_abundance(usable, fraction, relative_to, keys))
    files = overlap.map_log(judged, keys).orderBy(*keys).collect()  # a row per file
    for r in files if fraction > 0 else ():
        if r["cutoff_freq"] is None:
            log.info("[map] %s: no cutoff for %d barcode(s)", r["sample"], r["n_total"])
        else:
            log.info("[map] %s: dropped %d of %d below %g x %s", r["sample"], r["n_dropped"], r["n_total"], fraction, relative_to)
    kept = overlap.pooled(judged)
    summary = overlap.overlap_summary(kept)
    place = overlap.first_places(judged)
    kept_with = overlap.with_frequency(kept).withColumn("shown", sinks.fixed("freq", 6))
    sizes = summary.select("barcode", "n_samples", "total_count")
    names = [r["sample"] for r in kept.select("sample").distinct().orderBy("sample").collect()]
    counts = overlap.matrix(kept_with, "cnt", names).join(sizes, "barcode")
    freqs = overlap.matrix(kept_with, "shown", names).join(sizes, "barcode")
    _ordered_file(counts, place, os.path.join(outdir, "barcode_x_sample_counts.csv"), ["barcode", *names])
    _ordered_file(freqs, place, os.path.join(outdir, "barcode_x_sample_freq.csv"), ["barcode", *names])
    _ordered_file(summary, place, os.path.join(outdir, "barcode_overlap_summary.csv"), ["barcode", "n_samples", "samples", "total_count"])
    log.info("[map] %d distinct barcodes across %d samples", summary.count(), len(names))
    last = judged.groupBy("sample").agg(F.max("file").alias("file"))
    lines = {r["sample"]: r for r in files}  # of several files the last one's
    bins = overlap.histogram(judged.join(last, list(keys)))
    if plot and not sinks.write_histograms(bins, os.path.join(outdir, "plots"), lines, f"{fraction:g} x {relative_to}"):
        log.warning("[map] matplotlib isn't installed; no plots")


def _ordered_file(df: DataFrame, place: DataFrame, target: str, shown: list[str]) -> None:
    """One CSV file: barcodes of most samples first, then of most reads, then as they first survive."""
    keys = [F.desc("n_samples"), F.desc("total_count"), "position"]
    hidden = [c for c in ("n_samples", "total_count") if c not in shown]
    columns = [F.col(f"`{c}`") for c in shown]
    sinks.one_file(df.join(place, "barcode").select(*columns, *hidden, "position"), target, keys, shown)


def _files(folder: str, ending: str) -> list[str]:
    """Paths of the files in a folder whose names end so, in order."""
    return [os.path.join(folder, f) for f in storage.names(folder) if f.endswith(ending)]


def _parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="readloom", description=__doc__)
    top.add_argument("--master", help="Spark master; leave it to spark-submit on a cluster")
    sub = top.add_subparsers(dest="command", required=True)
    for name in ("extract", "filter", "cluster", "map", "run"):
        p = sub.add_parser(name)
        p.add_argument("--outdir", required=True)
        p.add_argument("--config", help="YAML file that overrides the default design")
        if name in ("extract", "run"):
            p.add_argument("--samples", required=True)
            p.add_argument("--fastq-dir", required=True)
            p.add_argument("--mode", choices=["auto", "se", "pe"], default="auto")
        if name == "filter":
            p.add_argument("--parsed-dir", required=True)
        if name in ("filter", "run"):
            p.add_argument("--index-map", required=name == "filter")
        if name == "cluster":
            p.add_argument("--input-dir", required=True)
        if name == "map":
            p.add_argument("--counts-dir", required=True)
        if name == "run":
            p.add_argument("--do-map", action="store_true")
        if name in ("map", "run"):
            at = "map-" if name == "run" else ""
            p.add_argument(f"--{at}min-count", dest="min_count", type=int, default=2)
            p.add_argument(f"--{at}min-rel-abundance", dest="fraction", type=float, default=0.0)
            p.add_argument(f"--{at}relative-to", dest="relative_to", choices=["mean", "median"], default="median")
            p.add_argument(f"--{at}plot", dest="plot", action="store_true")
    return top


def main(argv: list[str] | None = None) -> int:
    """Runs one command; returns the exit code."""
    args = _parser().parse_args(argv)
    logging.basicConfig(stream=sys.stderr, level=logging.INFO, format="%(message)s")
    design, spark = Design.from_yaml(args.config), session(args.master)
    if args.command == "extract":
        run_extract(spark, find_samples(sample_names(args.samples), args.fastq_dir, args.mode), args.outdir, design)
    elif args.command == "filter":
        paths = _files(args.parsed_dir, ".parsed.tsv")
        rows, modes = tables.parsed_tables(spark, paths, ".parsed.tsv"), tables.table_modes(paths, ".parsed.tsv")
        run_filter(spark, rows, modes, args.index_map, args.outdir, design)
    elif args.command == "cluster":
        for ending in (".kept.tsv", ".parsed.tsv"):  # counters and tallies that lie beside aren't read
            paths = _files(args.input_dir, ending)
            if paths:
                break
        else:
            log.error("[cluster] no .kept.tsv or .parsed.tsv files in %s", args.input_dir)
            return 1
        names = [os.path.basename(p).removesuffix(ending) for p in paths]
        run_cluster(tables.parsed_tables(spark, paths, ending), names, args.outdir, design)
    elif args.command == "map":
        cells = tables.corrected_tables(spark, os.path.join(args.counts_dir, "*.csv"))
        run_map(cells, args.outdir, args.min_count, args.fraction, args.relative_to, args.plot)
    else:
        at = lambda folder: os.path.join(args.outdir, folder)
        names = sample_names(args.samples)
        found = find_samples(names, args.fastq_dir, args.mode)
        rows = run_extract(spark, found, at("1_extracted"), design)
        if args.index_map:
            modes = {s.sample: s.mode for s in found.values()}
            rows = run_filter(spark, rows, modes, args.index_map, at("2_filtered"), design)
        corrected = run_cluster(rows, names, at("3_clustered"), design)
        if args.do_map:
            cells = corrected.select("sample", F.col("sample").alias("file"), F.col("corrected_barcode").alias("barcode"), F.col("total_count").alias("cnt"),
                                     F.struct("sample", -F.col("total_count"), "corrected_barcode").alias("position"))
            run_map(cells, at("4_mapped"), args.min_count, args.fraction, args.relative_to, args.plot)
    return 0


if __name__ == "__main__":
    sys.exit(main())
