"""Bag set operations: replication and union of same-schema parts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def replicate(df: DataFrame, times: int, partitions: int | None = None) -> DataFrame:
    """UNION ALL of ``df`` with itself ``times`` times, as one Generate over one scan.

    Each input row is exploded into ``times`` exact copies inside the scan's
    stage: no join and no ``times``-way union in the plan. Filters that do not
    use the copy number are pushed below the Generate by Catalyst.

    The output is ``times`` larger than the input. A caller whose input has too
    few splits for that (a single small file) passes ``partitions``: the input
    rows are then dealt out round-robin first (Spark sorts them for that, so a
    retry deals alike). By default nothing is shuffled.
    """
    if times < 0:
        raise ValueError("times must be >= 0")
    if partitions:
        df = df.repartition(partitions)
    if times == 0:
        return df.limit(0)
    if times == 1:
        return df
    copy = "__tablehaul_copy"
    return (df.withColumn(copy, F.explode(F.sequence(F.lit(1), F.lit(times))))
              .drop(copy))


def union_parts(parts: list[DataFrame], by_name: bool = False) -> DataFrame:
    """Bag concatenation of same-schema parts (order across parts is not kept)."""
    if not parts:
        raise ValueError("no parts")
    if by_name:
        return reduce(lambda a, b: a.unionByName(b), parts)
    return reduce(lambda a, b: a.unionAll(b), parts)
