"""Occurrences and record counts of every distinct value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def term_frequencies(rows: DataFrame, fields: dict[str, Column], record: Column) -> DataFrame:
    """Per field and distinct value: `n_reads`, the rows that hold it, and `n_records`, the distinct records that do.

    Counts per (field, value, record) are combined by hash inside each input partition before the shuffle, so that a
    value that fills a third of all rows arrives as one row per partition and record. The counts are then summed per
    value, partially first again. Null values are no values, null records count as one record; empty values, values of
    any length and repeated rows count as they stand, an empty table gives no row, extra columns are not read.
    """
    pairs = F.array(*[F.struct(F.lit(name).alias("field_name"), c.alias("item_value")) for name, c in fields.items()])
    terms = rows.select(record.alias("record"), F.explode(pairs).alias("t")).select("t.field_name", "t.item_value", "record")
    per_record = (
        terms.filter(F.col("item_value").isNotNull())
        .groupBy("field_name", "item_value", "record")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return per_record.groupBy("field_name", "item_value").agg(
        F.sum("n").alias("n_reads"), F.count(F.lit(1)).alias("n_records")
    )


def mark(terms: DataFrame, marks: dict[str, Column]) -> DataFrame:
    """Adds `marks`, the names of all frequency bounds a value breaks (an empty array for useful values)."""
    named = F.array(*[F.when(test, F.lit(name.split(":")[0])) for name, test in marks.items()])
    return terms.withColumn("marks", F.array_compact(named))
