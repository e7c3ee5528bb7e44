"""Cleaning of dirty sequence values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Blanks that stray around values: space, tab, carriage return.
BLANKS = " \t\r"


def clean_value(value: Column | str) -> Column:
    """Upper-cased value without blanks at either end; NULL for null, empty and blank values."""
    return F.nullif(F.upper(F.btrim(F.col(value) if isinstance(value, str) else value, F.lit(BLANKS))), F.lit(""))


def clean_value_sql(column: str) -> str:
    """The same in DuckDB's SQL."""
    return f"nullif(upper(trim({column}, chr(32) || chr(9) || chr(13))), '')"
