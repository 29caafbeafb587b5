"""Aggregations: row counts, bounds, grouped sums. All are partial (map-side)
aggregates followed by one small shuffle of per-task partial results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .partition import bounds_columns


def count_rows(df: DataFrame, alias: str = "n") -> DataFrame:
    """``COUNT(*)`` as a one-row DataFrame; a filtered or plain scan reads no more columns than it needs."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def min_max(df: DataFrame, column: str) -> DataFrame:
    """``(min, max)`` of a numeric column as integers (floor; NULL -> 0; NaN and infinities are passed over)."""
    return df.agg(*bounds_columns(df, column))


def group_sum(df: DataFrame, key: str | list[str], value: str, alias: str | None = None) -> DataFrame:
    """``SUM(value) GROUP BY key``; a NULL key is a group of its own."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.sum(value).alias(alias or f"sum_{value}"))
