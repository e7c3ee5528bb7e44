"""Raw reads derived from the test table `lineitem`, by one SQL text that Spark and DuckDB both read.

Samples S0 to S2 are paired-end, S3 single-end. Some reads have low quality, a damaged primer, a foreign second read, another
index or a barcode with one replaced letter. A read's number comes from its order's key, since numbering whole samples would
sort each of them in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .session import table

_NUCLEOTIDES = "translate(md5({}), '0123456789abcdef', 'ACGTACGTACGTACGT')"

READS_SQL = f"""
WITH numbered AS (
  SELECT l_suppkey, l_orderkey, l_partkey, l_quantity,
         l_orderkey * 1000 + row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
                                                l_extendedprice, l_quantity) AS read_idx
  FROM lineitem),
base AS (
  SELECT concat('S', CAST(l_suppkey % 4 AS VARCHAR)) AS sample, l_suppkey % 4 AS sno, read_idx, l_orderkey, l_partkey, l_quantity,
         {_NUCLEOTIDES.format("concat('r', CAST(l_partkey % 40 AS VARCHAR))")} AS root,
         {_NUCLEOTIDES.format("concat('u', CAST(l_orderkey AS VARCHAR))")} AS umi,
         {_NUCLEOTIDES.format("concat('x', CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR))")} AS junk
  FROM numbered),
bc AS (
  SELECT *, concat(substr(root,1,5),'AC',substr(root,6,5),'GA',substr(root,11,5),'TC',substr(root,16,5)) AS bc0,
         CAST(CASE WHEN l_orderkey % 50 = 0 THEN 1 + l_partkey % 5 ELSE 0 END AS INT) AS mpos,
         CASE WHEN l_orderkey % 61 = 0 THEN 'GGAACC' WHEN sno = 0 THEN 'GCCAAT' WHEN sno = 1 THEN 'CTAAGG'
              WHEN sno = 2 THEN 'ATTCCG' ELSE 'TGGCAA' END AS idx1,
         CASE WHEN l_orderkey % 37 = 0 THEN 'TTTTTTTTTTTTTTTTTTTTT'
              WHEN l_orderkey % 11 = 0 THEN 'GCCACTCGTGCACCTACGAGG' ELSE 'GCCACTCGAGCACCTAGGAGG' END AS primer1
  FROM base),
v AS (
  SELECT *, CASE WHEN mpos = 0 THEN bc0
                 ELSE concat(substr(bc0,1,mpos-1), translate(substr(bc0,mpos,1),'ACGT','CGTA'), substr(bc0,mpos+1)) END AS barcode
  FROM bc),
s AS (
  SELECT *, concat(idx1, substr(umi,1,8), primer1, barcode, 'CATGTTACCGGATTGCAAGTCTGACGATCA') AS r1_seq,
         CASE WHEN sno = 3 THEN NULL
              ELSE concat('TTAGGC', substr(umi,9,8), 'AATCAGTCCAGTTATGCTGTGAA',
                          CASE WHEN l_orderkey % 29 = 0 THEN substr(junk,1,30)
                               ELSE 'TGATCGTCAGACTTGCAATCCGGTAACATG' END) END AS r2_seq
  FROM v)
SELECT sample, CAST(read_idx AS BIGINT) AS read_idx, r1_seq,
       CASE WHEN l_quantity < 3 THEN concat(repeat('#', 61), repeat('I', CAST(length(r1_seq) AS INT) - 61))
            ELSE repeat('I', CAST(length(r1_seq) AS INT)) END AS r1_qual,
       r2_seq, CASE WHEN r2_seq IS NULL THEN NULL ELSE repeat('I', CAST(length(r2_seq) AS INT)) END AS r2_qual
FROM s
"""


def raw_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`sample`, `read_idx`, `r1_seq`, `r1_qual`, `r2_seq`, `r2_qual`.

    Split by order key into as many tasks as a shuffle has, and at least two per core: reads are far larger than the rows
    they come from, so partitions of the size of the latter would be too few. The numbering needs no further shuffle.
    """
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    columns = ["l_suppkey", "l_orderkey", "l_partkey", "l_quantity", "l_linenumber", "l_extendedprice"]
    rows = table(spark, sf_dir, "lineitem").select(*columns).repartition(tasks, "l_orderkey")
    return spark.sql(READS_SQL.replace("VARCHAR", "STRING").replace("FROM lineitem", "FROM {lineitem}"), lineitem=rows)
