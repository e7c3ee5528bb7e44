"""Queries of filtering, clustering and overlap over the parsed reads and the count matrix, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..design import Design
from ..functions.cleaning import clean_value, clean_value_sql
from ..functions.motifs import motif_tolerant
from ..operators import cluster, index_filter, overlap
from ..sources.sinks import fixed
from .reads_view import READS_SQL, raw_reads
from .session import table
from .shared import cut

_D = Design()
#: The fraction of the mean or median share below which a barcode is dropped in the queries.
_CUT = {"mean": 0.05, "median": 0.5}


def parsed_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every parsed read once, with its barcode cleaned."""
    return table(spark, sf_dir, "parsed").select(
        F.col("sample_name").alias("sample"), "read_idx", "combined_umi", "combined_index", clean_value("barcode").alias("barcode")
    ).distinct()


def _expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "index_map").withColumnRenamed("sample_name", "sample")
    return index_filter.expected_indexes(rows, "line_no")


def _filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index_filter.filter_reasons(parsed_reads(spark, sf_dir), _expected(spark, sf_dir), _D)


def expected_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index map as it is used."""
    return _expected(spark, sf_dir)


def unmapped_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples with reads but without an expected index."""
    return index_filter.unmapped_samples(parsed_reads(spark, sf_dir), _expected(spark, sf_dir))


def filter_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why each read is rejected, or NULL."""
    return _filtered(spark, sf_dir).select("sample", "read_idx", "filter_reason")


def filter_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads kept and rejected per sample."""
    return index_filter.filter_summary(_filtered(spark, sf_dir))


def motif_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each distinct barcode holds the motif, with one mismatch."""
    values = parsed_reads(spark, sf_dir).select("barcode").filter("barcode is not null").distinct()
    return values.withColumn("fits", motif_tolerant(F.col("barcode"), _D.barcode_motif, 1))


def barcode_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries of a read repeat its barcode, so the other columns aren't shuffled."""
    rows = table(spark, sf_dir, "parsed").select(F.col("sample_name").alias("sample"), "read_idx", clean_value("barcode").alias("barcode"))
    return cluster.barcode_counts(rows.filter("barcode is not null").distinct())


def barcode_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads per sample and barcode."""
    return barcode_totals(spark, sf_dir)


def barcode_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three blocks of every sample's barcodes."""
    counts = barcode_totals(spark, sf_dir)
    return counts.select("sample", "barcode", F.explode(cluster.blocks(F.col("barcode"), 3)).alias("b")).select(
        "sample", "barcode", F.col("b.idx").cast("long").alias("idx"), "b.block"
    )


def cluster_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Possible merges of rare barcodes into frequent ones."""
    edges = cluster.merge_edges(cut(barcode_totals(spark, sf_dir)), _D)
    return edges.withColumn("dist", F.col("dist").cast("long")).withColumn("block_idx", F.col("block_idx").cast("long"))


def cluster_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every barcode's representative."""
    return cluster.assignments(cut(barcode_totals(spark, sf_dir)), _D)


def corrected_barcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads per sample and representative."""
    return cluster.corrected_counts(cut(barcode_totals(spark, sf_dir)), _D)


def cluster_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads and barcodes per sample before and after the merge of variants: no read is lost."""
    counts = cut(barcode_totals(spark, sf_dir))
    before = counts.groupBy("sample").agg(F.sum("cnt").alias("reads_in"), F.count(F.lit(1)).alias("barcodes_in"))
    after = cluster.corrected_counts(counts, _D).groupBy("sample").agg(
        F.sum("total_count").alias("reads_out"), F.count(F.lit(1)).alias("barcodes_out")
    )
    return before.join(after, "sample", "left")


def umi_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UMI groups per sample and barcode."""
    return cluster.umi_groups(parsed_reads(spark, sf_dir), _D)


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = table(spark, sf_dir, "barcode_x_sample_counts")
    return cells.select(F.col("sample_name").alias("sample"), clean_value("barcode").alias("barcode"), F.col("total_count").alias("cnt"))


def _judged(spark: SparkSession, sf_dir: str, relative_to: str) -> DataFrame:
    return overlap.relative_abundance(overlap.usable_counts(_cells(spark, sf_dir)), _CUT[relative_to], relative_to)


def relative_abundance_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Barcodes below 0.05 of the mean share are dropped."""
    return _judged(spark, sf_dir, "mean").select("sample", "barcode", "cnt", "dropped")


def relative_abundance_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Barcodes below 0.5 of the median share are dropped."""
    return _judged(spark, sf_dir, "median").select("sample", "barcode", "cnt", "dropped")


def map_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the cutoff drops per sample."""
    log = overlap.map_log(_judged(spark, sf_dir, "median"))
    return log.select("sample", "n_total", "sample_total", "n_dropped", "reference_freq", "cutoff_freq")


def _surviving(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.surviving(_judged(spark, sf_dir, "median"))


def map_pooled_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells with an odd and with an even count as if from two files of their sample: the cutoff is each file's own, and what it
    leaves is added up."""
    keys = ("sample", "file")
    cells = _cells(spark, sf_dir).withColumn("file", F.pmod("cnt", F.lit(2)))
    return overlap.pooled(overlap.relative_abundance(overlap.usable_counts(cells, 2, keys), 0.5, "median", keys))


def unmapped_raw_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of the raw reads and of parsed that have no expected index."""
    samples = raw_reads(spark, sf_dir).select("sample").union(table(spark, sf_dir, "parsed").select("sample_name"))
    return index_filter.unmapped_samples(samples, _expected(spark, sf_dir))


def _lines(spark: SparkSession, sf_dir: str, value: str) -> DataFrame:
    """The rows of a matrix as one text each, in order of samples, as the exports have them."""
    text = F.col("cnt").cast("string") if value == "cnt" else fixed("freq", 6)
    wide = overlap.matrix(cut(overlap.with_frequency(_surviving(spark, sf_dir)).withColumn("shown", text)), "shown")
    return wide.select("barcode", F.concat_ws(",", *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in wide.columns[1:]]).alias("cells"))


def matrix_counts_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Barcodes by samples: reads, a line per barcode."""
    return _lines(spark, sf_dir, "cnt")


def matrix_freq_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Barcodes by samples: shares to six places, a line per barcode."""
    return _lines(spark, sf_dir, "freq")


def matrix_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Barcodes by samples: reads."""
    return overlap.matrix(cut(_surviving(spark, sf_dir)))


def matrix_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Barcodes by samples: share of the sample's surviving reads."""
    return overlap.matrix(cut(overlap.with_frequency(_surviving(spark, sf_dir))), "freq")


def matrix_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matrices in long form."""
    return overlap.with_frequency(_surviving(spark, sf_dir))


def overlap_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples and reads of every surviving barcode."""
    return overlap.overlap_summary(_surviving(spark, sf_dir))


def shared_barcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Barcodes that survive in two samples at least."""
    return overlap.overlap_summary(_surviving(spark, sf_dir)).filter("n_samples >= 2").select("barcode", "n_samples")


def surviving_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct barcodes and samples that survive."""
    return _surviving(spark, sf_dir).agg(
        F.count_distinct("barcode").alias("n_barcodes"), F.count_distinct("sample").alias("n_samples")
    )


def freq_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bins of the logarithm of the share, kept and dropped."""
    bins = overlap.histogram(_judged(spark, sf_dir, "median"))
    return bins.select("sample", F.col("bin").cast("long").alias("bin"), F.col("n_bins").cast("long").alias("n_bins"), "n_kept", "n_dropped")


def distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts kept and dropped per sample, as a table of (sample, dropped, cnt, barcodes)."""
    return _judged(spark, sf_dir, "median").groupBy("sample", "dropped", "cnt").agg(F.count(F.lit(1)).alias("n_barcodes"))


QUERIES = {
    f.__name__: f
    for f in (
        expected_index, unmapped_samples, filter_reasons, filter_summary, motif_windows, barcode_counts, barcode_blocks,
        cluster_edges, cluster_assignment, corrected_barcodes, cluster_totals, umi_groups, relative_abundance_mean,
        relative_abundance_median, map_log, map_pooled_files, unmapped_raw_samples, matrix_counts, matrix_freq, matrix_counts_lines,
        matrix_freq_lines, matrix_long, overlap_summary, shared_barcodes, surviving_totals, freq_histogram,
        distribution,
    )
}

_BARCODE = clean_value_sql("barcode")
_READS = f"""reads AS (SELECT DISTINCT sample_name AS sample, read_idx, combined_umi, combined_index, {_BARCODE} AS barcode FROM parsed)"""
_EXPECTED = """expected AS (SELECT sample_name AS sample, arg_max(upper(regexp_replace(expected_index, '^\\s+|\\s+$', '', 'g')), line_no)
                            AS expected_index FROM index_map GROUP BY 1)"""
_FIXED = [(5, "A"), (6, "C"), (12, "G"), (13, "A"), (19, "T"), (20, "C")]
_WINDOW = " + ".join(f"(substr(barcode, k + {i + 1}, 1) <> '{base}')::INT" for i, base in _FIXED)
_FITS = f"length(barcode) >= 26 AND len(list_filter(range(0, length(barcode) - 25), lambda k: {_WINDOW} <= 1)) > 0"
FILTERED_SQL = f"""
    WITH {_READS}, {_EXPECTED},
    j AS (SELECT sample, read_idx, upper(coalesce(combined_index, '')) AS o, expected_index AS e, coalesce(barcode, '') AS barcode
          FROM reads JOIN expected USING (sample)),
    f AS (SELECT sample, read_idx, CASE
            WHEN NOT CASE WHEN length(o) <> length(e) THEN false WHEN length(o) <= 6 THEN hamming(o, e) <= 1
                 ELSE hamming(substr(o, 1, 6), substr(e, 1, 6)) <= 1 AND hamming(substr(o, 7, 6), substr(e, 7, 6)) <= 1 END
            THEN 'index_mismatch' WHEN NOT ({_FITS}) THEN 'motif_absent' END AS filter_reason FROM j)"""
COUNTS_SQL = f"{_READS}, counts AS (SELECT sample, barcode, count(*) AS cnt FROM reads WHERE barcode IS NOT NULL GROUP BY ALL)"
_BLOCKS = """blocks AS (SELECT sample, barcode, cnt, CAST(i AS BIGINT) AS idx,
    substr(barcode, CAST(length(barcode) * i // 3 + 1 AS INT), CAST(length(barcode) * (i + 1) // 3 - length(barcode) * i // 3 AS INT)) AS block
    FROM counts, range(3) t(i))"""
_EDGES = f"""{COUNTS_SQL}, {_BLOCKS},
    edges AS (SELECT c.sample, c.barcode AS child, p.barcode AS parent, min(levenshtein(c.barcode, p.barcode)) AS dist,
                     min(c.idx) AS block_idx, max(p.cnt) AS parent_cnt
              FROM blocks c JOIN blocks p ON c.sample = p.sample AND c.idx = p.idx AND c.block = p.block
              WHERE c.cnt < 25 AND (p.cnt > c.cnt OR p.cnt = c.cnt AND p.barcode < c.barcode)
                AND c.cnt <= CAST(0.1 AS DOUBLE) * p.cnt AND levenshtein(c.barcode, p.barcode) <= 2 GROUP BY ALL)"""
ASSIGNED_SQL = f"""{_EDGES},
    r0 AS (SELECT sample, barcode, barcode AS rep FROM counts ANTI JOIN
           (SELECT sample, child AS barcode FROM edges) USING (sample, barcode)),
    o1 AS (SELECT e.*, r.rep FROM edges e LEFT JOIN r0 r ON r.sample = e.sample AND r.barcode = e.parent),
    r1 AS (SELECT sample, child AS barcode, coalesce(arg_min(parent, (dist, block_idx, -parent_cnt, parent)), child) AS rep
           FROM o1 GROUP BY sample, child HAVING count(*) FILTER (rep IS NULL) = 0),
    k1 AS (SELECT * FROM r0 UNION ALL SELECT * FROM r1),
    o2 AS (SELECT e.*, k.rep FROM edges e LEFT JOIN k1 k ON k.sample = e.sample AND k.barcode = e.parent
           WHERE (e.sample, e.child) NOT IN (SELECT (sample, barcode) FROM r1)),
    r2 AS (SELECT sample, child AS barcode,
                  coalesce(arg_min(parent, (dist, block_idx, -parent_cnt, parent)) FILTER (rep = parent), child) AS rep
           FROM o2 GROUP BY sample, child),
    assigned AS (SELECT * FROM k1 UNION ALL SELECT * FROM r2)"""
_USABLE = f"""cells AS (SELECT sample_name AS sample, {_BARCODE} AS barcode, total_count AS cnt FROM barcode_x_sample_counts),
    usable AS (SELECT sample, barcode, CAST(sum(cnt) AS BIGINT) AS cnt FROM cells
               WHERE barcode IS NOT NULL AND NOT contains(barcode, 'N') AND cnt >= 2 GROUP BY ALL)"""


def _judged_sql(relative_to: str) -> str:
    return f"""{_USABLE},
    totals AS (SELECT sample, sum(cnt) AS sample_total, count(*) AS n_total, {"avg" if relative_to == "mean" else "median"}(cnt) AS middle
               FROM usable GROUP BY sample),
    judged AS (SELECT *, cnt::DOUBLE / sample_total::DOUBLE AS freq,
                      CASE WHEN n_total > 1 THEN middle::DOUBLE / sample_total::DOUBLE END AS reference_freq,
                      CAST({_CUT[relative_to]} AS DOUBLE) * reference_freq AS cutoff_freq,
                      coalesce(freq < cutoff_freq, false) AS dropped FROM usable JOIN totals USING (sample)),
    kept AS (SELECT sample, barcode, cnt FROM judged WHERE NOT dropped),
    long AS (SELECT *, cnt::DOUBLE / (sum(cnt) OVER (PARTITION BY sample))::DOUBLE AS freq FROM kept)"""


_MEDIAN = _judged_sql("median")
_GRID = """grid AS (SELECT b.barcode, s.sample, cnt, freq
    FROM (SELECT DISTINCT barcode FROM kept) b CROSS JOIN (SELECT DISTINCT sample FROM kept) s LEFT JOIN long USING (barcode, sample))"""
ORACLE = {
    "expected_index": f"WITH {_EXPECTED} SELECT * FROM expected",
    "unmapped_samples": f"WITH {_EXPECTED} SELECT DISTINCT sample_name AS sample FROM parsed WHERE sample_name NOT IN (SELECT sample FROM expected)",
    "filter_reasons": f"{FILTERED_SQL} SELECT * FROM f",
    "filter_summary": f"""{FILTERED_SQL}
        SELECT sample, count(*) FILTER (filter_reason IS NULL) AS kept, count(*) FILTER (filter_reason = 'index_mismatch') AS index_mismatch,
               count(*) FILTER (filter_reason = 'motif_absent') AS motif_absent, count(*) AS total,
               count(*) FILTER (filter_reason IS NULL)::DOUBLE / count(*) AS kept_fraction FROM f GROUP BY sample""",
    "motif_windows": f"WITH {_READS} SELECT DISTINCT barcode, {_FITS} AS fits FROM reads WHERE barcode IS NOT NULL",
    "barcode_counts": f"WITH {COUNTS_SQL} SELECT * FROM counts",
    "barcode_blocks": f"WITH {COUNTS_SQL}, {_BLOCKS} SELECT sample, barcode, idx, block FROM blocks",
    "cluster_edges": f"WITH {_EDGES} SELECT * FROM edges",
    "cluster_assignment": f"WITH {ASSIGNED_SQL} SELECT * FROM assigned",
    "corrected_barcodes": f"""WITH {ASSIGNED_SQL}
        SELECT sample, rep AS corrected_barcode, CAST(sum(cnt) AS BIGINT) AS total_count,
               sum(cnt)::DOUBLE / (sum(sum(cnt)) OVER (PARTITION BY sample))::DOUBLE AS freq_within_sample
        FROM counts JOIN assigned USING (sample, barcode) GROUP BY sample, rep""",
    "relative_abundance_mean": f"WITH {_judged_sql('mean')} SELECT sample, barcode, cnt, dropped FROM judged",
    "relative_abundance_median": f"WITH {_MEDIAN} SELECT sample, barcode, cnt, dropped FROM judged",
    "map_log": f"""WITH {_MEDIAN} SELECT sample, n_total, CAST(sample_total AS BIGINT) AS sample_total,
        count(*) FILTER (dropped) AS n_dropped, reference_freq, cutoff_freq FROM judged GROUP BY ALL""",
    "cluster_totals": f"""WITH {ASSIGNED_SQL},
        n AS (SELECT sample, count(*) AS barcodes_out FROM assigned WHERE rep = barcode GROUP BY sample)
        SELECT sample, CAST(sum(cnt) AS BIGINT) AS reads_in, count(*) AS barcodes_in, CAST(sum(cnt) AS BIGINT) AS reads_out,
               any_value(barcodes_out) AS barcodes_out FROM counts JOIN n USING (sample) GROUP BY sample""",
    "umi_groups": f"""WITH {_READS},
        p AS (SELECT sample, barcode, upper(substr(coalesce(combined_umi, ''), 1, 8)) AS umi, min(read_idx) AS first, count(*) AS n
              FROM reads WHERE barcode IS NOT NULL GROUP BY ALL),
        o AS (SELECT sample, barcode, CAST(sum(n) AS BIGINT) AS n_reads, list([umi] ORDER BY first, umi) AS umis FROM p GROUP BY ALL)
        SELECT sample, barcode, n_reads, len(list_reduce(umis, lambda held, new: CASE WHEN len(list_filter(held, lambda g:
                   CASE WHEN length(g) = length(new[1]) AND length(g) > 0 THEN hamming(g, new[1]) <= 1 ELSE false END)) > 0
               THEN held ELSE list_concat(held, new) END)) AS n_umi_groups FROM o""",
    "map_pooled_files": f"""
        WITH cells AS (SELECT sample_name AS sample, {_BARCODE} AS barcode, total_count AS cnt, total_count % 2 AS file FROM barcode_x_sample_counts),
        usable AS (SELECT sample, file, barcode, sum(cnt) AS cnt FROM cells
                   WHERE barcode IS NOT NULL AND NOT contains(barcode, 'N') AND cnt >= 2 GROUP BY ALL),
        judged AS (SELECT *, count(*) OVER w AS n_total, cnt::DOUBLE / (sum(cnt) OVER w)::DOUBLE AS freq,
                          (median(cnt) OVER w)::DOUBLE / (sum(cnt) OVER w)::DOUBLE AS reference
                   FROM usable WINDOW w AS (PARTITION BY sample, file))
        SELECT sample, barcode, CAST(sum(cnt) AS BIGINT) AS cnt FROM judged
        WHERE n_total = 1 OR NOT freq < CAST(0.5 AS DOUBLE) * reference GROUP BY ALL""",
    "unmapped_raw_samples": f"""
        WITH reads AS ({READS_SQL}), {_EXPECTED}
        SELECT sample FROM (SELECT sample FROM reads UNION SELECT sample_name FROM parsed) ANTI JOIN expected USING (sample)""",
    "matrix_counts_lines": f"""WITH {_MEDIAN}, {_GRID}
        SELECT barcode, string_agg(coalesce(cnt::VARCHAR, ''), ',' ORDER BY sample) AS cells FROM grid GROUP BY barcode""",
    "matrix_freq_lines": f"""WITH {_MEDIAN}, {_GRID}
        SELECT barcode, string_agg(CASE WHEN cnt IS NULL THEN '' ELSE printf('%.6f', freq) END, ',' ORDER BY sample) AS cells FROM grid GROUP BY barcode""",
    "matrix_counts": f"WITH {_MEDIAN} FROM (PIVOT kept ON sample USING CAST(sum(cnt) AS BIGINT) GROUP BY barcode)",
    "matrix_freq": f"WITH {_MEDIAN} FROM (PIVOT (SELECT sample, barcode, freq FROM long) ON sample USING sum(freq) GROUP BY barcode)",
    "matrix_long": f"WITH {_MEDIAN} SELECT * FROM long",
    "overlap_summary": f"""WITH {_MEDIAN} SELECT barcode, count(*) AS n_samples, string_agg(sample, ';' ORDER BY sample) AS samples,
        CAST(sum(cnt) AS BIGINT) AS total_count FROM kept GROUP BY barcode""",
    "shared_barcodes": f"WITH {_MEDIAN} SELECT barcode, count(*) AS n_samples FROM kept GROUP BY barcode HAVING count(*) >= 2",
    "surviving_totals": f"WITH {_MEDIAN} SELECT count(DISTINCT barcode) AS n_barcodes, count(DISTINCT sample) AS n_samples FROM kept",
    "freq_histogram": f"""WITH {_MEDIAN},
        x AS (SELECT *, log10(freq) AS x FROM judged),
        b AS (SELECT *, min(x) OVER w AS x0, max(x) OVER w AS x1,
                     CAST(greatest(10, least(60, floor(sqrt(n_total::DOUBLE) * 2))) AS BIGINT) AS n_bins
              FROM x WINDOW w AS (PARTITION BY sample)),
        e AS (SELECT *, CASE WHEN x0 = x1 THEN x0 - 0.5 ELSE x0 END AS lo, CASE WHEN x0 = x1 THEN x1 + 0.5 ELSE x1 END AS hi FROM b)
        SELECT sample, greatest(0, least(CAST(floor((x - lo) / ((hi - lo) / n_bins)) AS BIGINT), n_bins - 1)) AS bin, n_bins,
               count(*) FILTER (NOT dropped) AS n_kept, count(*) FILTER (dropped) AS n_dropped FROM e GROUP BY ALL""",
    "distribution": f"WITH {_MEDIAN} SELECT sample, dropped, cnt, count(*) AS n_barcodes FROM judged GROUP BY ALL",
}
