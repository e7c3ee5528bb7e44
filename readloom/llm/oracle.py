"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from ..functions.cleaning import clean_value_sql
from .quality import CLOSERS, LAST_IN_LINE, WHITE

_BARCODE, _UMI, _PREFIX = (clean_value_sql(c) for c in ("barcode", "combined_umi", "sequence_prefix"))

_FIELD_READS = f"""
    v AS (SELECT DISTINCT 'barcode' AS field_name, {_BARCODE} AS item_value, sample_name, read_idx FROM parsed
          UNION ALL
          SELECT DISTINCT 'sequence_prefix', {_PREFIX}, sample_name, read_idx FROM unmatched),
    g AS (SELECT field_name, item_value, count(*) AS n FROM v WHERE item_value IS NOT NULL GROUP BY ALL),
    c AS (SELECT *, sum(n) OVER (PARTITION BY field_name) AS total FROM g)"""

_TERMS = f"""
    r AS (SELECT DISTINCT sample_name, read_idx, {_BARCODE} AS b, {_UMI} AS u FROM parsed),
    v AS (SELECT 'barcode' AS field_name, b AS item_value, sample_name FROM r
          UNION ALL SELECT 'combined_umi', u, sample_name FROM r),
    g AS (SELECT field_name, item_value, count(*) AS n_reads, count(DISTINCT sample_name) AS n_samples
          FROM v WHERE item_value IS NOT NULL GROUP BY ALL),
    t AS (SELECT *, sum(n_reads) OVER (PARTITION BY field_name) AS total FROM g),
    m AS (SELECT *, CASE WHEN field_name = 'barcode' AND n_reads = 1 THEN 'rare' END AS m1,
                 CASE WHEN field_name = 'barcode' AND n_samples * 2 >= (SELECT count(DISTINCT sample_name) FROM parsed)
                        OR field_name = 'combined_umi' AND n_reads * 250 >= total THEN 'common' END AS m2 FROM t)"""

_STATS = f"""
    d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    w AS (SELECT doc_id, text, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS words FROM d),
    k AS (SELECT list(DISTINCT word) AS known FROM common_words),
    n AS (SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS n_letters,
                 length(regexp_replace(text, '[{WHITE}]+', '', 'g')) AS n_visible,
                 length(regexp_replace(text, '[^\\p{{L}}\\p{{N}}]+', '', 'g')) AS n_alnum,
                 len(regexp_extract_all(text, '[^{WHITE}]{LAST_IN_LINE}')) AS n_lines,
                 len(regexp_extract_all(text, '[{CLOSERS}]{LAST_IN_LINE}')) AS n_closed,
                 len(list_filter(words, lambda x: list_contains(known, x))) AS n_common FROM w, k),
    s AS (SELECT doc_id, n_words, coalesce(n_letters::DOUBLE / nullif(n_words, 0), 0) AS mean_word_length, n_visible,
                 coalesce((n_visible - n_alnum)::DOUBLE / nullif(n_visible, 0), 0) AS symbol_ratio, n_lines,
                 coalesce(n_closed::DOUBLE / nullif(n_lines, 0), 0) AS closed_share,
                 coalesce(n_common::DOUBLE / nullif(n_words, 0), 0) AS common_share FROM n)"""

_SHARED = f"""
    v AS (SELECT DISTINCT sample_name AS s, {_BARCODE} AS b FROM barcode_x_sample_counts WHERE total_count > 0 AND {_BARCODE} IS NOT NULL),
    n AS (SELECT s, count(*) AS n FROM v GROUP BY s),
    p AS (SELECT x.s, y.s AS t, count(*) AS c FROM v x JOIN v y ON x.b = y.b AND x.s < y.s GROUP BY ALL),
    shared AS (SELECT a.s AS sample_a, b.s AS sample_b, coalesce(c, 0) AS n_shared, a.n AS n_a, b.n AS n_b
               FROM n a JOIN n b ON a.s < b.s LEFT JOIN p ON p.s = a.s AND p.t = b.s)"""

#: How many of the four stated marks of junk a text bears.
_MARKS = """((common_share < 0.15)::INT + (closed_share < 0.4)::INT + (symbol_ratio > 0.25)::INT
        + (mean_word_length < 2.5 OR mean_word_length > 9)::INT)"""

ORACLE = {
    "p1_found": f"""
        WITH v AS (SELECT DISTINCT sample_name, {_BARCODE} AS b FROM parsed WHERE {_BARCODE} IS NOT NULL)
        SELECT x.sample_name, x.b AS barcode_a, y.b AS barcode_b FROM v x JOIN v y
        ON x.sample_name = y.sample_name AND x.b < y.b AND abs(length(x.b) - length(y.b)) <= 2
        WHERE levenshtein(x.b, y.b) <= 2""",
    "p2_found": f"WITH {_FIELD_READS} SELECT field_name, item_value FROM c WHERE n * 100 >= total",
    "p2_bounds": f"WITH {_FIELD_READS} SELECT field_name, item_value, n AS n_reads, true AS within_bounds FROM c WHERE n * 500 >= total",
    "p3_found": f"""
        WITH {_TERMS} SELECT field_name, item_value, unnest(list_filter([m1, m2], lambda x: x IS NOT NULL)) AS mark FROM m""",
    "p3_terms": f"""
        WITH {_TERMS} SELECT field_name, item_value, n_reads, n_samples, concat_ws(',', m1, m2) AS marks FROM m""",
    "p4_found": f"WITH {_SHARED} SELECT sample_a, sample_b FROM shared WHERE n_shared * 10 >= 3 * least(n_a, n_b)",
    "p4_found_by_small_sketches": f"WITH {_SHARED} SELECT sample_a, sample_b FROM shared WHERE n_shared * 10 >= 3 * least(n_a, n_b)",
    "p4_bounds": f"WITH {_SHARED} SELECT sample_a, sample_b, n_shared, true AS within_bounds FROM shared",
    "p5_bounds": f"""
        WITH r AS (SELECT run_day, sample_name, lane_no, {_BARCODE} AS barcode, {_UMI} AS combined_umi FROM parsed),
             g AS (SELECT CAST(grouping(run_day, sample_name, lane_no) AS BIGINT) AS grouping_id, run_day, sample_name, lane_no,
                          count(DISTINCT barcode) AS barcode, count(DISTINCT combined_umi) AS combined_umi
                   FROM r GROUP BY CUBE (run_day, sample_name, lane_no))
        SELECT *, true AS within_bounds FROM (UNPIVOT g ON barcode, combined_umi INTO NAME field_name VALUE n_exact)""",
    "p8_found": """
        WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents),
             i AS (SELECT item_id, regexp_extract_all(lower(item_text), '[\\p{L}\\p{N}]+') AS w FROM eval_items),
             g AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 7), lambda k: array_to_string(w[k:k+8], ' '))) AS g FROM d),
             h AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 7), lambda k: array_to_string(w[k:k+8], ' '))) AS g FROM i)
        SELECT DISTINCT doc_id, item_id FROM g JOIN h USING (g)""",
    "p8_spans": """
        WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents),
             i AS (SELECT item_id, regexp_extract_all(lower(item_text), '[\\p{L}\\p{N}]+') AS w FROM eval_items),
             g AS (SELECT doc_id, unnest(range(0, len(w) - 8)) AS pos, unnest(list_transform(range(1, len(w) - 7), lambda k: array_to_string(w[k:k+8], ' '))) AS g FROM d),
             h AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 7), lambda k: array_to_string(w[k:k+8], ' '))) AS g FROM i),
             m AS (SELECT DISTINCT doc_id, item_id, pos FROM g JOIN h USING (g)),
             n AS (SELECT *, coalesce(pos > lag(pos) OVER (PARTITION BY doc_id, item_id ORDER BY pos) + 9, true)::INT AS opens FROM m),
             s AS (SELECT *, sum(opens) OVER (PARTITION BY doc_id, item_id ORDER BY pos) AS span FROM n)
        SELECT doc_id, item_id, min(pos) AS start_word, max(pos) + 9 AS end_word FROM s GROUP BY doc_id, item_id, span""",
    "p9_statistics": f"WITH {_STATS} SELECT * FROM s",
    "p9_found": f"WITH {_STATS} SELECT doc_id FROM s WHERE n_visible > 0 AND {_MARKS} >= 2",
    "p9_verdicts": f"""
        WITH {_STATS} SELECT doc_id, CASE WHEN n_visible = 0 THEN 'blank' WHEN {_MARKS} >= 2 THEN 'junk' ELSE 'prose' END AS verdict FROM s""",
}
