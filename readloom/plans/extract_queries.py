"""Queries of the operators on raw reads, with their SQL."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..design import Design
from ..functions.sequences import best_overlap_distance, hamming, levenshtein_within, quality_ok, rev_comp
from ..functions.structure import fuzzy_parts
from ..operators import extract
from ..sources import storage
from ..sources.discovery import SampleFiles
from ..sources.fastq import read_fastq, read_fastq_split
from .reads_view import READS_SQL, raw_reads
from .session import table
from .shared import cut, shared_dir

_D = Design()
#: Reads of a compressed FASTQ file, about, and bytes of a range of a plain one, in the scanning queries.
LANE_READS, SPLIT = 200_000, 32 * 1024 * 1024


def quality_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads whose first read is good in index, UMI, primer and barcode."""
    reads = raw_reads(spark, sf_dir)
    return reads.filter(quality_ok(F.col("r1_qual"), _D.r1_quality_len, _D.qmin)).select("sample", "read_idx")


def zip_join_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and second reads, kept apart, side by side again by their number."""
    reads = raw_reads(spark, sf_dir)
    first = reads.select("sample", "read_idx", "r1_seq")
    second = reads.filter("r2_seq is not null").select("sample", "read_idx", "r2_seq")
    return first.join(second, ["sample", "read_idx"])


def _fastq_lines(n: int) -> Column:
    """The record of read n as four lines."""
    return F.concat_ws("\n", F.concat(F.lit("@read"), "read_idx", F.lit(f"/{n}")), f"r{n}_seq", F.lit("+"), f"r{n}_qual")


def _numbered(reads: DataFrame) -> DataFrame:
    """Scanned reads with the number that their header holds."""
    number = F.regexp_extract("r1_header", "@read([0-9]+)/", 1).cast("long").alias("read_idx")
    return reads.select("sample", number, "r1_seq", "r1_qual", "r2_seq", "r2_qual")


def fastq_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw reads written as gzip-compressed FASTQ files, one or two per sample and lane, and read by the data source.

    A lane holds some LANE_READS reads, whatever the size of its sample, since a compressed file takes one task."""
    reads = cut(raw_reads(spark, sf_dir))
    lanes = max(1, -(-reads.count() // LANE_READS))
    lane = F.pmod(F.xxhash64("read_idx"), F.lit(lanes)).alias("lane")
    folder = f"{shared_dir(spark)}/fastq-{os.urandom(6).hex()}"
    files: dict[str, list[str]] = {}
    for n in (1, 2):
        own = reads.filter(F.col(f"r{n}_seq").isNotNull()).select("sample", lane, "read_idx", _fastq_lines(n).alias("value"))
        own = own.repartition("sample", "lane").sortWithinPartitions("sample", "lane", "read_idx").drop("read_idx")
        own.write.partitionBy("sample", "lane").text(f"{folder}/r{n}", compression="gzip")
        for part in storage.files_below(f"{folder}/r{n}"):
            if part.endswith(".gz"):
                files.setdefault(os.path.dirname(part), []).append(f"{folder}/r{n}/{part}")
    found = [SampleFiles(key.split("/")[0].removeprefix("sample="), *paths) for key, paths in sorted(files.items())]
    return _numbered(read_fastq(spark, found))


def fastq_split_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw reads written as plain FASTQ, each sample in sorted part files of many tasks, and read by ranges of bytes."""
    reads = cut(raw_reads(spark, sf_dir))
    folder, samples = f"{shared_dir(spark)}/fastq-{os.urandom(6).hex()}", {1: set(), 2: set()}
    for n in (1, 2):
        own = reads.filter(F.col(f"r{n}_seq").isNotNull()).select("sample", "read_idx", _fastq_lines(n).alias("value"))
        own = own.repartitionByRange("sample", "read_idx").sortWithinPartitions("sample", "read_idx").drop("read_idx")
        own.write.partitionBy("sample").text(f"{folder}/r{n}")
        samples[n] = {f.split("/")[0] for f in storage.files_below(f"{folder}/r{n}") if "/part-" in f}
    path = lambda n, s: f"{folder}/r{n}/{s}" if s in samples[n] else None
    found = [SampleFiles(s.removeprefix("sample="), path(1, s), path(2, s)) for s in sorted(samples[1])]
    return _numbered(read_fastq_split(spark, found, SPLIT))


def extract_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The passed reads of paired-end and single-end samples."""
    return extract.parsed_rows(extract.classify(raw_reads(spark, sf_dir), _D))


def extract_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every read's status."""
    return extract.classify(raw_reads(spark, sf_dir), _D).select("sample", "read_idx", "status")


def extract_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads by status and sample."""
    return extract.read_counters(extract.classify(raw_reads(spark, sf_dir), _D))


def unmatched_of_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent prefixes of raw reads that fail the structure."""
    tally = extract.unmatched_tally(extract.unmatched_of(extract.classify(raw_reads(spark, sf_dir), _D)), _D.top_unmatched_n)
    return tally.select("sample", "sequence_prefix", "n_reads", "place")


def fuzzy_primer_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of first reads whose primer has errors, by the fuzzy structure."""
    reads = raw_reads(spark, sf_dir).filter(F.substring("r1_seq", 15, 21) != _D.inner_p1_primer)
    return reads.withColumn("p", fuzzy_parts(F.col("r1_seq"), _D, 1)).filter("p.idx is not null").select(
        "sample", "read_idx", "p.idx", "p.umi", "p.barcode", "p.down"
    )


def fuzzy_primer_indels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of first reads whose whole primer has lost its eleventh base, or got another one before it. The motif behind tells
    where the barcode begins, so the fuzzy structure has one way to fit."""
    reads = raw_reads(spark, sf_dir).filter(F.substring("r1_seq", 15, 21) == _D.inner_p1_primer)
    until, lost, rest = F.substring("r1_seq", 1, 24), F.expr("substr(r1_seq, 26)"), F.expr("substr(r1_seq, 25)")
    changed = F.when(F.col("read_idx") % 2 == 0, F.concat(until, lost)).otherwise(F.concat(until, F.lit("T"), rest))
    parts = reads.select("sample", "read_idx", fuzzy_parts(changed, _D, 1).alias("p")).filter("p.idx is not null")
    return parts.select("sample", "read_idx", "p.idx", "p.umi", "p.barcode", "p.down")


def sequence_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reverse complement, Hamming and bounded edit distance over raw reads."""
    a, b = F.substring("r1_seq", 15, 21), F.lit(_D.inner_p1_primer)
    return raw_reads(spark, sf_dir).select(
        "sample", "read_idx", rev_comp(F.col("r1_seq")).alias("rc"), hamming(a, b).cast("long").alias("mismatches"),
        levenshtein_within(a, b, 3).cast("long").alias("edits"),
    )


def overlap_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the downstream parts of paired reads are apart."""
    reads = raw_reads(spark, sf_dir).filter("r2_seq is not null")
    down1, down2 = F.expr("substr(r1_seq, 62)"), rev_comp(F.expr("substr(r2_seq, 38)"))
    return reads.select("sample", "read_idx", best_overlap_distance(down1, down2, 20).cast("long").alias("dist"))


def unmatched_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent unmatched prefixes of the table of unmatched reads."""
    reads = table(spark, sf_dir, "unmatched").select(F.col("sample_name").alias("sample"), "read_idx", "sequence_prefix")
    tally = extract.unmatched_tally(reads.filter("sequence_prefix is not null").distinct(), _D.top_unmatched_n)
    return tally.select("sample", "sequence_prefix", "n_reads", "place")


def counters_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reads that the tables hold beside those that the counters name."""
    stats = table(spark, sf_dir, "extract_stats")
    count = lambda t, n: (
        table(spark, sf_dir, t).select("sample_name", "read_idx").distinct().groupBy("sample_name").agg(F.count(F.lit(1)).alias(n))
    )
    return (
        stats.join(count("parsed", "seen_passed"), "sample_name", "left").join(count("unmatched", "seen_unmatched"), "sample_name", "left")
        .select("sample_name", "total_reads", "passed", "regex_fail", F.coalesce("seen_passed", F.lit(0)).alias("seen_passed"),
                F.coalesce("seen_unmatched", F.lit(0)).alias("seen_unmatched"),
                F.coalesce(F.try_divide(F.col("passed").cast("double"), F.col("total_reads").cast("double")), F.lit(0.0)).alias("share"))
    )


QUERIES = {
    f.__name__: f
    for f in (
        quality_filter, zip_join_reads, fastq_scan, fastq_split_scan, extract_parsed, extract_status, extract_counters,
        unmatched_of_reads, fuzzy_primer_extract, fuzzy_primer_indels, sequence_functions, overlap_distance, unmatched_top, counters_check,
    )
}

_P1, _P2 = _D.inner_p1_primer, _D.inner_p2_primer
_MOTIF = "[ACGTN]{5}AC[ACGTN]{5}GA[ACGTN]{5}TC[ACGTN]{5}"
_DISTANCE = """(SELECT min(hamming(substr(a, CAST(i AS INT), 20), substr(b, CAST(j AS INT), 20)))
                FROM range(1, 12) t(i), range(1, 12) u(j))"""
CLASSIFIED_SQL = f"""
    WITH reads AS ({READS_SQL}),
    x AS (SELECT *, substr(r1_seq, 62) AS a, reverse(translate(substr(r2_seq, 38), 'ACGTNacgtn', 'TGCANtgcan')) AS b FROM reads),
    y AS (SELECT *, CASE WHEN r2_seq IS NOT NULL THEN {_DISTANCE} END AS dist FROM x),
    c AS (SELECT *, CASE
            WHEN NOT regexp_matches(r1_qual, '^[^\\x00-\\x39]{{61}}')
              OR r2_seq IS NOT NULL AND NOT regexp_matches(r2_qual, '^[^\\x00-\\x39]{{37}}') THEN 'quality_fail'
            WHEN hamming(substr(r1_seq, 15, 21), '{_P1}') > 3 OR NOT regexp_matches(substr(r1_seq, 36, 26), '^{_MOTIF}$')
              OR r2_seq IS NOT NULL AND hamming(substr(r2_seq, 15, 23), '{_P2}') > 3 THEN 'regex_fail'
            WHEN dist > 4 THEN 'overlap_fail' ELSE 'passed' END AS status FROM y)"""

_TALLY = """ t AS (SELECT sample, sequence_prefix, count(*) AS n_reads, min(read_idx) AS first_idx FROM f GROUP BY ALL),
    o AS (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY n_reads DESC, first_idx, sequence_prefix) AS place FROM t)
    SELECT sample, sequence_prefix, n_reads, place FROM o WHERE place <= 50"""

ORACLE = {
    "quality_filter": f"""
        WITH reads AS ({READS_SQL}) SELECT sample, read_idx FROM reads WHERE regexp_matches(r1_qual, '^[^\\x00-\\x39]{{61}}')""",
    "zip_join_reads": f"WITH reads AS ({READS_SQL}) SELECT sample, read_idx, r1_seq, r2_seq FROM reads WHERE r2_seq IS NOT NULL",
    "fastq_scan": READS_SQL,
    "fastq_split_scan": READS_SQL,
    "extract_status": f"{CLASSIFIED_SQL} SELECT sample, read_idx, status FROM c",
    "extract_counters": f"""{CLASSIFIED_SQL}
        SELECT sample, count(*) AS total_reads, count(*) FILTER (status = 'passed') AS passed,
               count(*) FILTER (status = 'quality_fail') AS quality_fail, count(*) FILTER (status = 'regex_fail') AS regex_fail,
               count(*) FILTER (status = 'overlap_fail') AS overlap_fail,
               count(*) FILTER (status = 'passed')::DOUBLE / count(*) AS pass_fraction FROM c GROUP BY sample""",
    "extract_parsed": f"""{CLASSIFIED_SQL}
        SELECT sample, CASE WHEN r2_seq IS NULL THEN 'SE' ELSE 'PE' END AS mode, read_idx,
               concat(substr(r1_seq, 7, 8), substr(r2_seq, 7, 8)) AS combined_umi,
               concat(substr(r1_seq, 1, 6), substr(r2_seq, 1, 6)) AS combined_index, substr(r1_seq, 36, 26) AS barcode,
               substr(r1_seq, 1, 6) AS index1, substr(r2_seq, 1, 6) AS index2, substr(r1_seq, 7, 8) AS umi1,
               substr(r2_seq, 7, 8) AS umi2, CAST(dist AS INT) AS best_overlap_dist FROM c WHERE status = 'passed'""",
    "unmatched_of_reads": f"""{CLASSIFIED_SQL},
        f AS (SELECT sample, read_idx, substr(r1_seq, 1, 60) AS sequence_prefix FROM c WHERE status = 'regex_fail'), {_TALLY}""",
    "fuzzy_primer_extract": f"""
        WITH reads AS ({READS_SQL}) SELECT sample, read_idx, substr(r1_seq, 1, 6) AS idx, substr(r1_seq, 7, 8) AS umi,
        substr(r1_seq, 36, 26) AS barcode, substr(r1_seq, 62) AS down FROM reads
        WHERE hamming(substr(r1_seq, 15, 21), '{_P1}') BETWEEN 1 AND 3""",
    "fuzzy_primer_indels": f"""
        WITH reads AS ({READS_SQL}) SELECT sample, read_idx, substr(r1_seq, 1, 6) AS idx, substr(r1_seq, 7, 8) AS umi,
        substr(r1_seq, 36, 26) AS barcode, substr(r1_seq, 62) AS down FROM reads WHERE substr(r1_seq, 15, 21) = '{_P1}'
        AND regexp_matches(substr(r1_seq, 36, 26), '^{_MOTIF}$')""",
    "sequence_functions": f"""
        WITH reads AS ({READS_SQL}) SELECT sample, read_idx, reverse(translate(r1_seq, 'ACGTNacgtn', 'TGCANtgcan')) AS rc,
        hamming(substr(r1_seq, 15, 21), '{_P1}') AS mismatches,
        CASE WHEN levenshtein(substr(r1_seq, 15, 21), '{_P1}') <= 3 THEN levenshtein(substr(r1_seq, 15, 21), '{_P1}') END AS edits
        FROM reads""",
    "overlap_distance": f"""
        WITH reads AS ({READS_SQL}),
        x AS (SELECT sample, read_idx, substr(r1_seq, 62) AS a, reverse(translate(substr(r2_seq, 38), 'ACGTNacgtn', 'TGCANtgcan')) AS b
              FROM reads WHERE r2_seq IS NOT NULL)
        SELECT sample, read_idx, {_DISTANCE} AS dist FROM x""",
    "unmatched_top": f"""
        WITH f AS (SELECT DISTINCT sample_name AS sample, read_idx, sequence_prefix FROM unmatched
                   WHERE sequence_prefix IS NOT NULL), {_TALLY}""",
    "counters_check": """
        WITH p AS (SELECT sample_name, count(DISTINCT read_idx) AS n FROM parsed GROUP BY 1),
             u AS (SELECT sample_name, count(DISTINCT read_idx) AS n FROM unmatched GROUP BY 1)
        SELECT s.sample_name, total_reads, passed, regex_fail, coalesce(p.n, 0) AS seen_passed, coalesce(u.n, 0) AS seen_unmatched,
               coalesce(passed::DOUBLE / nullif(total_reads, 0), 0) AS share
        FROM extract_stats s LEFT JOIN p USING (sample_name) LEFT JOIN u USING (sample_name)""",
}
