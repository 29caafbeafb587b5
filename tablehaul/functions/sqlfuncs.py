"""SQL functions the loader's test databases define, as Spark SQL functions."""

from __future__ import annotations

from pyspark.sql import SparkSession


def register_increment(spark: SparkSession, name: str = "increment") -> str:
    """``increment(i) = i + 1`` as a SQL function (inlined by the analyzer; no Python)."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(i BIGINT) RETURNS BIGINT "
              f"RETURN i + 1")
    return name
