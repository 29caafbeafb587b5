"""Equi-joins, planned by Catalyst."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def equi_join(left: DataFrame, right: DataFrame, on, how: str = "inner", broadcast_right: bool = False) -> DataFrame:
    """Join on equal keys.

    The planner chooses from the sizes in bytes it knows (and AQE from those it
    measures: a side found small is broadcast at runtime, skewed partitions are
    split). ``broadcast_right`` is for callers who know that the right side is
    bounded, such as a dimension of a fixed size from a source without statistics.
    Nothing runs while the plan is built.
    """
    return left.join(F.broadcast(right) if broadcast_right else right, on, how)
