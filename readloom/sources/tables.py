"""Text tables between the stages: index maps, parsed and corrected tables."""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import storage

#: Fixed formats: columns of the tables on disk, and their names here.
PARSED = {
    "Combined_UMI": "combined_umi", "Combined_Index": "combined_index", "Barcode": "barcode", "Index1": "index1",
    "Index2": "index2", "UMI1": "umi1", "UMI2": "umi2", "BestOverlapDist": "best_overlap_dist",
}
PARSED_SE = ["Combined_UMI", "Combined_Index", "Barcode", "Index1", "UMI1"]


def _file_name() -> F:
    return F.element_at(F.split(F.url_decode(F.col("_metadata.file_name")), "/"), -1)


def index_map(spark: SparkSession, path: str) -> DataFrame:
    """`line_no`, `sample`, `expected_index` of a CSV file; ValueError if one of the two columns is missing."""
    df = spark.read.csv(storage.uri(path), header=True)
    missing = {"sample", "expected_index"} - set(df.columns)
    if missing:
        raise ValueError(f"{path} has no column {', '.join(sorted(missing))}; it has {df.columns}")
    return df.select(F.monotonically_increasing_id().alias("line_no"), "sample", "expected_index")


def parsed_tables(spark: SparkSession, paths: list[str], ending: str) -> DataFrame:
    """Rows of parsed (or kept) tables, PE and SE alike, `sample` from the file name less `ending`, `read_idx` rising in the
    order of the file. Files with the older column name `Combined UMI` are read too; the Barcode and UMI columns are required."""
    if not paths:
        raise ValueError("no tables to read")
    kinds: dict[str, list[str]] = {}  # files by header: a scan for each kind, however many samples there are
    for path in paths:
        kinds.setdefault(storage.first_line(path), []).append(storage.uri(path))
    parts = []
    for header, own in kinds.items():
        columns = header.replace("Combined UMI", "Combined_UMI").split("\t")
        missing = {"Combined_UMI", "Barcode"} - set(columns)
        if missing:
            raise ValueError(f"{own[0]} has no column {', '.join(sorted(missing))}")
        schema = ", ".join(f"`{c}` string" for c in columns)
        df = spark.read.csv(own, sep="\t", header=True, quote="", escape="", schema=schema, enforceSchema=True)
        have = [F.col(c).alias(n) if c in columns else F.lit(None).cast("string").alias(n) for c, n in PARSED.items()]
        sample = F.regexp_replace(_file_name(), ending.replace(".", r"\.") + "$", "")
        # the block's place in the file, in MB, then the row's in its task
        block = F.shiftleft(F.shiftright(F.col("_metadata.file_block_start"), 20), 33)
        row = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
        parts.append(df.select(sample.alias("sample"), (block + row).alias("read_idx"), *have))
    out = reduce(DataFrame.unionByName, parts)
    distance = F.try_to_number("best_overlap_dist", F.lit("999")).cast("int")
    mode = F.when(F.col("index2").isNull(), "SE").otherwise("PE")
    return out.withColumn("best_overlap_dist", distance).withColumn("mode", mode)


def table_modes(paths: list[str], ending: str) -> dict[str, str]:
    """By the headers of parsed (or kept) tables whether each sample is paired-end (PE) or single-end (SE), rows or none."""
    modes = {}
    for path in paths:
        columns = storage.first_line(path).split("\t")
        modes[os.path.basename(path).removesuffix(ending)] = "PE" if "Index2" in columns else "SE"
    return modes


def corrected_tables(spark: SparkSession, path: str) -> DataFrame:
    """`sample`, `file`, `barcode`, `cnt` and `position` (by file, then line) of corrected-barcode CSV files; a file's sample is
    that of its first line."""
    kinds = "sample string, corrected_barcode string, total_count long, freq_within_sample double"
    df = spark.read.csv(storage.uri(path), header=True, schema=kinds).select(
        "*", F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("position"),
    )
    first = df.groupBy("file").agg(F.min_by("sample", "position").alias("sample"))
    return df.drop("sample").join(first, "file").select(
        "sample", "file", F.col("corrected_barcode").alias("barcode"), F.col("total_count").alias("cnt"), "position"
    )
