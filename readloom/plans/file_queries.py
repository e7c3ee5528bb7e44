"""Queries of the files between the stages: tables written as files, found, and read back, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..cli import run_filter, run_map
from ..design import Design
from ..functions.cleaning import clean_value
from ..operators import cluster, extract
from ..sources import sinks, storage, tables
from ..sources.discovery import find_samples
from .barcode_queries import ASSIGNED_SQL, COUNTS_SQL, FILTERED_SQL, barcode_totals
from .extract_queries import CLASSIFIED_SQL
from .reads_view import raw_reads
from .session import table
from .shared import cut, expire, shared_dir

_D = Design()


def _folder(spark: SparkSession, kind: str) -> str:
    path = f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"
    storage.make_folder(path)
    return expire(spark, path)


def _parsed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, str]]:
    """Every parsed read once, and the samples' modes."""
    rows = table(spark, sf_dir, "parsed").select(
        F.col("sample_name").alias("sample"), F.col("read_mode").alias("mode"), "read_idx", "combined_umi", "combined_index",
        clean_value("barcode").alias("barcode"), "index1", "index2", "umi1", "umi2", "best_overlap_dist",
    )
    rows = cut(rows.distinct())
    modes = {r["sample"]: r["mode"] for r in rows.groupBy("sample").agg(F.max("mode").alias("mode")).orderBy("sample").collect()}
    return rows, modes


def _paths(folder: str) -> list[str]:
    return [f"{folder}/{f}" for f in storage.names(folder)]


def parsed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parsed reads written as a table file per sample and read back; texts can't tell empty values from nulls."""
    rows, modes = _parsed(spark, sf_dir)
    folder = _folder(spark, "parsed-files")
    sinks.write_parsed(rows, modes, folder)
    paths = _paths(folder)
    assert tables.table_modes(paths, ".parsed.tsv") == modes
    return tables.parsed_tables(spark, paths, ".parsed.tsv").drop("read_idx")


def kept_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filter stage on the parsed reads: the kept reads of every sample's file."""
    rows, modes = _parsed(spark, sf_dir)
    folder = _folder(spark, "kept-files")
    run_filter(spark, rows, modes, _index_map_file(spark, sf_dir, folder), folder, _D)
    kept = tables.parsed_tables(spark, _paths(f"{folder}/kept"), ".kept.tsv")
    return kept.select("sample", "combined_umi", "combined_index", "barcode")


def _index_map_file(spark: SparkSession, sf_dir: str, folder: str) -> str:
    path = f"{folder}/index_map.csv"
    sinks.one_file(table(spark, sf_dir, "index_map").withColumnRenamed("sample_name", "sample"), path, ["line_no"], ["sample", "expected_index"])
    return path


def filter_summary_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filter stage's summary file, of all mapped samples, those without reads included."""
    rows, modes = _parsed(spark, sf_dir)
    mapped = table(spark, sf_dir, "index_map").select(F.col("sample_name").alias("sample")).distinct()
    modes = {r["sample"]: "PE" for r in mapped.collect()} | modes
    folder = _folder(spark, "summary-file")
    run_filter(spark, rows, modes, _index_map_file(spark, sf_dir, folder), folder, _D)
    kinds = "sample string, kept long, index_mismatch long, motif_absent long, total long, kept_fraction string"
    return spark.read.csv(f"{folder}/filter_summary.csv", header=True, schema=kinds)


def stats_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counters of the raw reads' samples, and of the index map's, which have none, as lines of their files."""
    named = table(spark, sf_dir, "index_map").select(F.col("sample_name").alias("sample"))
    reads = cut(extract.classify(raw_reads(spark, sf_dir), _D).select("sample", "status"))
    folder = _folder(spark, "stats-files")
    sinks.write_stats(extract.read_counters(reads, named.union(reads.select("sample")).distinct()), folder)
    sample = F.regexp_extract(F.url_decode(F.col("_metadata.file_name")), r"^(.*)\.stats\.tsv$", 1)
    return spark.read.text(folder).select(sample.alias("sample"), F.col("value").alias("line"))


def unmatched_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent unmatched prefixes, written as a file per sample and read back."""
    rows = table(spark, sf_dir, "unmatched").select(
        F.col("sample_name").alias("sample"), "read_idx", clean_value("sequence_prefix").alias("sequence_prefix")
    )
    tally = cut(extract.unmatched_tally(rows.filter("sequence_prefix is not null").distinct(), _D.top_unmatched_n))
    folder = _folder(spark, "unmatched-files")
    sinks.write_unmatched(tally, [r["sample"] for r in tally.select("sample").distinct().collect()], folder)
    sample = F.regexp_extract(F.url_decode(F.col("_metadata.file_name")), r"^(.*)\.unmatched\.tsv$", 1)
    lines = spark.read.csv(folder, sep="\t", header=True, schema="sequence_prefix string, count long")
    return lines.select(sample.alias("sample"), "sequence_prefix", F.col("count").alias("n_reads"))


def _corrected_folder(spark: SparkSession, sf_dir: str) -> str:
    corrected = cut(cluster.corrected_counts(cut(barcode_totals(spark, sf_dir)), _D))
    folder = _folder(spark, "corrected-files")
    sinks.write_corrected(corrected, [r["sample"] for r in corrected.select("sample").distinct().collect()], folder)
    return folder


def corrected_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corrected barcodes as a file per sample, shares to the last digit of the text."""
    kinds = "sample string, corrected_barcode string, total_count long, freq_within_sample string"
    return spark.read.csv(_corrected_folder(spark, sf_dir), header=True, schema=kinds)


def matrix_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The map stage on the corrected files: the lines of both matrices and of the overlap summary."""
    folder = _folder(spark, "matrix-files")
    cells = tables.corrected_tables(spark, f"{_corrected_folder(spark, sf_dir)}/*.csv")
    run_map(cells, folder, 2, 0.5, "median", False)
    return spark.read.text(folder).select(F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("line"))


def discovered_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The samples of parsed as FASTQ files would name them, found again by name: mode and number of files."""
    _, modes = _parsed(spark, sf_dir)
    folder = _folder(spark, "discovery")
    for sample, mode in modes.items():
        for ending in ("_S1_L001_R1_001.fastq.gz", "_S1_L001_R2_001.fastq.gz")[: 2 if mode == "PE" else 1]:
            storage.write_whole(f"{folder}/{sample}{ending}", [])
    found = find_samples(list(modes), folder).values()
    rows = [(s.sample, s.mode, 2 if s.r2 else 1) for s in found]
    return spark.createDataFrame(rows, "sample string, mode string, n_files long")


QUERIES = {
    f.__name__: f
    for f in (
        parsed_files, kept_files, filter_summary_file, stats_files, unmatched_files, corrected_files, matrix_files, discovered_samples,
    )
}

_ALL_READS = """
    SELECT DISTINCT sample_name AS sample, read_mode AS mode, read_idx, nullif(combined_umi, '') AS combined_umi,
           nullif(combined_index, '') AS combined_index, {barcode} AS barcode, nullif(index1, '') AS index1, nullif(index2, '') AS index2,
           nullif(umi1, '') AS umi1, nullif(umi2, '') AS umi2, best_overlap_dist FROM parsed"""
_CLEAN = "nullif(upper(trim({}, chr(32) || chr(9) || chr(13))), '')"
_SHARE = "total_count::DOUBLE / (sum(total_count) OVER (PARTITION BY sample))::DOUBLE"
_CORRECTED = f"""{ASSIGNED_SQL},
    corrected AS (SELECT sample, rep AS barcode, CAST(sum(cnt) AS BIGINT) AS total_count
                  FROM counts JOIN assigned USING (sample, barcode) GROUP BY sample, rep)"""
_STATS = " UNION ALL ".join(
    f"SELECT sample, '# {name}' || chr(9) || {value} AS line FROM c"
    for name, value in (
        ("Total_reads", "n"), ("Passed", "p"), ("Quality_fail", "q"), ("Regex_fail", "r"), ("Overlap_fail", "o"),
        ("Pass_fraction", "printf('%.4f', CASE WHEN n = 0 THEN 0::DOUBLE ELSE p::DOUBLE / n END)"),
    )
)

ORACLE = {
    "parsed_files": f"WITH a AS ({_ALL_READS.format(barcode=_CLEAN.format('barcode'))}) SELECT * EXCLUDE (read_idx) FROM a",
    "kept_files": f"""{FILTERED_SQL} SELECT sample, nullif(combined_umi, '') AS combined_umi, nullif(combined_index, '') AS combined_index, barcode
        FROM f JOIN reads USING (sample, read_idx) WHERE filter_reason IS NULL""",
    "filter_summary_file": f"""{FILTERED_SQL}
        SELECT sample, count(*) FILTER (read_idx IS NOT NULL AND filter_reason IS NULL) AS kept,
               count(*) FILTER (filter_reason = 'index_mismatch') AS index_mismatch,
               count(*) FILTER (filter_reason = 'motif_absent') AS motif_absent, count(read_idx) AS total,
               printf('%.4f', CASE WHEN total = 0 THEN 0::DOUBLE ELSE kept::DOUBLE / total END) AS kept_fraction
        FROM expected LEFT JOIN f USING (sample) GROUP BY sample""",
    "stats_files": f"""{CLASSIFIED_SQL},
        s AS (SELECT sample_name AS sample FROM index_map UNION SELECT sample FROM reads),
        t AS (SELECT s.sample, count(c.sample) AS n, count(*) FILTER (status = 'passed') AS p, count(*) FILTER (status = 'quality_fail') AS q,
                     count(*) FILTER (status = 'regex_fail') AS r, count(*) FILTER (status = 'overlap_fail') AS o
              FROM s LEFT JOIN c USING (sample) GROUP BY s.sample)
        {_STATS.replace("FROM c", "FROM t")}""",
    "unmatched_files": f"""
        WITH f AS (SELECT DISTINCT sample_name AS sample, read_idx, {_CLEAN.format('sequence_prefix')} AS sequence_prefix FROM unmatched),
        t AS (SELECT sample, sequence_prefix, count(*) AS n_reads, min(read_idx) AS first_idx FROM f WHERE sequence_prefix IS NOT NULL GROUP BY ALL),
        o AS (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY n_reads DESC, first_idx, sequence_prefix) AS place FROM t)
        SELECT sample, sequence_prefix, n_reads FROM o WHERE place <= 50""",
    "corrected_files": f"""WITH {_CORRECTED}
        SELECT sample, barcode AS corrected_barcode, total_count, printf('%.6f', {_SHARE}) AS freq_within_sample FROM corrected""",
    "matrix_files": f"""WITH {_CORRECTED},
        usable AS (SELECT sample, barcode, total_count AS cnt FROM corrected WHERE NOT contains(barcode, 'N') AND total_count >= 2),
        judged AS (SELECT *, count(*) OVER w AS n_total, cnt::DOUBLE / (sum(cnt) OVER w)::DOUBLE AS freq,
                          (median(cnt) OVER w)::DOUBLE / (sum(cnt) OVER w)::DOUBLE AS reference FROM usable WINDOW w AS (PARTITION BY sample)),
        kept AS (SELECT sample, barcode, cnt FROM judged WHERE n_total = 1 OR NOT freq < CAST(0.5 AS DOUBLE) * reference),
        long AS (SELECT *, printf('%.6f', cnt::DOUBLE / (sum(cnt) OVER (PARTITION BY sample))::DOUBLE) AS share FROM kept),
        grid AS (SELECT b.barcode, s.sample, cnt, share FROM (SELECT DISTINCT barcode FROM kept) b CROSS JOIN (SELECT DISTINCT sample FROM kept) s
                 LEFT JOIN long USING (barcode, sample)),
        head AS (SELECT string_agg(sample, ',' ORDER BY sample) AS names FROM (SELECT DISTINCT sample FROM kept))
        SELECT 'barcode_x_sample_counts.csv' AS file_name, barcode || ',' || string_agg(coalesce(cnt::VARCHAR, ''), ',' ORDER BY sample) AS line
        FROM grid GROUP BY barcode
        UNION ALL SELECT 'barcode_x_sample_freq.csv', barcode || ',' || string_agg(coalesce(share, ''), ',' ORDER BY sample) FROM grid GROUP BY barcode
        UNION ALL SELECT 'barcode_overlap_summary.csv', concat_ws(',', barcode, count(*), string_agg(sample, ';' ORDER BY sample), sum(cnt)) FROM kept GROUP BY barcode
        UNION ALL SELECT unnest(['barcode_x_sample_counts.csv', 'barcode_x_sample_freq.csv']), 'barcode,' || names FROM head
        UNION ALL SELECT 'barcode_overlap_summary.csv', 'barcode,n_samples,samples,total_count'""",
    "discovered_samples": """
        SELECT sample_name AS sample, max(read_mode) AS mode, CASE max(read_mode) WHEN 'PE' THEN 2 ELSE 1 END AS n_files FROM parsed GROUP BY 1""",
}
