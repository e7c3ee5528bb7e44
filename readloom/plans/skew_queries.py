"""Queries of the problem of a few keys that hold most records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cleaning import clean_value, clean_value_sql
from ..operators.chunking import keyed_summary
from .session import table


def _barcodes(spark: SparkSession, sf_dir: str, chunk_rows: int | None = None) -> tuple[DataFrame, int]:
    return keyed_summary(
        table(spark, sf_dir, "parsed"),
        clean_value("barcode"),
        {"n_umis": clean_value("combined_umi"), "n_samples": F.col("sample_name")},
        F.col("loaded_at"),
        chunk_rows,
    )


def p6_per_barcode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, distinct UMIs and samples, first and last load of every barcode of parsed."""
    return _barcodes(spark, sf_dir)[0].withColumnRenamed("key", "barcode").withColumnRenamed("n_rows", "n_reads")


def p6_per_barcode_in_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with chunks of 500 rows, which many barcodes exceed in small tables too."""
    return _barcodes(spark, sf_dir, 500)[0].withColumnRenamed("key", "barcode").withColumnRenamed("n_rows", "n_reads")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Barcodes that at least 2 % of all rows of parsed hold."""
    states, total = _barcodes(spark, sf_dir)
    return states.filter(F.col("n_rows") * 50 >= F.lit(total)).select(F.col("key").alias("barcode"))


QUERIES = {"p6_found": p6_found, "p6_per_barcode": p6_per_barcode, "p6_per_barcode_in_chunks": p6_per_barcode_in_chunks}

ORACLE = {
    "p6_found": f"""
        SELECT {clean_value_sql("barcode")} AS barcode FROM parsed WHERE {clean_value_sql("barcode")} IS NOT NULL
        GROUP BY 1 HAVING count(*) * 50 >= (SELECT count(*) FROM parsed)""",
    "p6_per_barcode": f"""
        SELECT {clean_value_sql("barcode")} AS barcode, count(*) AS n_reads,
               count(DISTINCT {clean_value_sql("combined_umi")}) AS n_umis, count(DISTINCT sample_name) AS n_samples,
               min(loaded_at) AS first_at, max(loaded_at) AS last_at
        FROM parsed WHERE {clean_value_sql("barcode")} IS NOT NULL GROUP BY 1""",
}
ORACLE["p6_per_barcode_in_chunks"] = ORACLE["p6_per_barcode"]
