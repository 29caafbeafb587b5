"""Range partitioning on one numeric column: bounds, ranges, part labels, part counts.

The range rule: with bounds [lo, hi] and n parts, ``size = (hi - lo + 1) // n``;
part i covers ``[lo + i*size, lo + (i+1)*size)`` and the last part ends at
``hi + 1``. When n exceeds the number of values, size is 0: the first n-1 parts
are empty and the last holds every row. Rows whose column is NULL or outside
``[lo, hi + 1)`` belong to no part. In floating columns NaN counts as NULL, and
infinite values lie outside every range; neither moves the bounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def validate_num(n) -> int:
    if n is None or int(n) < 1:
        raise ValueError("partition_num must be >= 1")
    return int(n)


def plan_ranges(lo: int, hi: int, n: int) -> list[tuple[int, int]]:
    """Half-open integer ranges ``[lower, upper)`` for ``n`` parts over [lo, hi]."""
    n = validate_num(n)
    lo, hi = int(lo), int(hi)
    size = (hi - lo + 1) // n
    ranges = [(lo + i * size, lo + (i + 1) * size) for i in range(n - 1)]
    ranges.append((lo + (n - 1) * size, hi + 1))
    return ranges


def range_predicates(column: str, ranges: list[tuple[int, int]], keep_nulls: bool = False) -> list[str]:
    """One SQL predicate per range (``lower <= c AND c < upper``), optionally one for NULLs."""
    preds = [f"{lo} <= {column} AND {column} < {hi}" for lo, hi in ranges]
    if keep_nulls:
        preds.append(f"{column} IS NULL")
    return preds


def _missing(df: DataFrame, column: str):
    """NULL, or NaN in a floating column."""
    c = F.col(column)
    return c.isNull() | F.isnan(c) if _floating(df, column) else c.isNull()


def bounds_columns(df: DataFrame, column: str):
    """MIN/MAX aggregates of the rule: floor to integer, no finite value (empty input) -> 0."""
    c = F.col(column)
    if _floating(df, column):
        c = F.when(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), c)
    return (F.coalesce(F.floor(F.min(c)).cast("bigint"), F.lit(0).cast("bigint")).alias("min"),
            F.coalesce(F.floor(F.max(c)).cast("bigint"), F.lit(0).cast("bigint")).alias("max"))


def check_numeric(df: DataFrame, column: str) -> None:
    """Only integer, floating and decimal columns can be range-partitioned."""
    from pyspark.sql import types as T
    dt = df.schema[column].dataType
    if not isinstance(dt, T.NumericType):
        raise ValueError(f"cannot partition on {column!r}: {dt.simpleString()} is not numeric")


def partition_bounds(df: DataFrame, column: str) -> DataFrame:
    """One-row DataFrame ``(min, max)`` of ``column`` — a distributed partial aggregate."""
    check_numeric(df, column)
    return df.agg(*bounds_columns(df, column))


def _bounds(df: DataFrame, column: str, bounds) -> tuple[int, int]:
    check_numeric(df, column)
    if bounds is not None:
        if len(bounds) != 2 or None in bounds:
            raise ValueError("bounds needs both a lower and an upper value")
        return int(bounds[0]), int(bounds[1])
    row = partition_bounds(df, column).first()  # one row: two numbers
    return int(row["min"]), int(row["max"])


def part_expr(df: DataFrame, column: str, lo: int, hi: int, n: int, keep_nulls: bool = False):
    """Part index of each row of ``df`` as a column expression (NULL when the row is in no part).

    Integral columns use exact integer division; fractional ones ``floor(x / size)``.
    """
    n = validate_num(n)
    c = F.col(column)
    size = (hi - lo + 1) // n
    if size == 0:
        idx = F.lit(n - 1)
    else:
        if _integral(df, column):
            step = F.expr(f"(CAST(`{column}` AS BIGINT) - {lo}) div {size}")
        else:
            step = F.floor((c - F.lit(lo)) / F.lit(size))
        idx = F.least(step, F.lit(n - 1).cast("bigint")).cast("int")
    expr = F.when(_in_parts(df, column, lo, hi, False), idx)
    if keep_nulls:
        expr = expr.when(_missing(df, column), F.lit(n))
    return expr.cast("int")


def partition_assign(df: DataFrame, column: str, n: int, bounds=None,
                     keep_nulls: bool = False, part_col: str = "part") -> DataFrame:
    """Label each row with its part; drop rows that fall in no part.

    With ``keep_nulls`` NULL (and NaN) rows are kept in an extra part ``n``. Only the
    bounds (two numbers) are computed eagerly; the labelling is a narrow
    projection + filter fused into the scan's stage.
    """
    lo, hi = _bounds(df, column, bounds)
    # filter on the column itself (pushed into the scan), then label
    kept = df.where(_in_parts(df, column, lo, hi, keep_nulls))
    return kept.withColumn(part_col, part_expr(df, column, lo, hi, n, keep_nulls))


def partition_counts(df: DataFrame, column: str, n: int, bounds=None,
                     keep_nulls: bool = False) -> DataFrame:
    """Rows per part, empty parts included, as ``(part, n)``.

    The counting is a partial (map-side) aggregate on the part label, so each
    task ships at most n+1 small rows to the shuffle.
    """
    spark = df.sparkSession
    lo, hi = _bounds(df, column, bounds)
    counts = (df.where(_in_parts(df, column, lo, hi, keep_nulls))
                .select(part_expr(df, column, lo, hi, n, keep_nulls).alias("part"))
                .groupBy("part").agg(F.count(F.lit(1)).alias("n")))
    all_parts = _part_ids(spark, n + (1 if keep_nulls else 0))
    return (all_parts.join(counts, "part", "left")
            .select("part", F.coalesce(F.col("n"), F.lit(0).cast("bigint")).alias("n")))


def _in_parts(df: DataFrame, column: str, lo: int, hi: int, keep_nulls: bool):
    c = F.col(column)
    inside = (c >= F.lit(lo)) & (c < F.lit(hi + 1))
    return inside | _missing(df, column) if keep_nulls else inside


def _integral(df: DataFrame, column: str) -> bool:
    from pyspark.sql import types as T
    return isinstance(df.schema[column].dataType, (T.ByteType, T.ShortType, T.IntegerType,
                                                   T.LongType))


def _floating(df: DataFrame, column: str) -> bool:
    from pyspark.sql import types as T
    return isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType))


def _part_ids(spark: SparkSession, k: int) -> DataFrame:
    return spark.range(k).select(F.col("id").cast("int").alias("part"))
