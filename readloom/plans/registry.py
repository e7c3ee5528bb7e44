"""All queries of the core library."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..streaming import reads as stream_queries
from . import barcode_queries, extract_queries, file_queries, skew_queries

_MODULES = (extract_queries, barcode_queries, file_queries, skew_queries, stream_queries)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Name to callable(spark, sf_dir)."""
    return {name: f for module in _MODULES for name, f in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    """Name to DuckDB SQL of the same result."""
    return {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}
