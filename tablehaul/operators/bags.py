"""INTERSECT ALL and EXCEPT ALL as counts per row, and NOT IN / IN with SQL's NULLs.

Both tables are counted by row where they are read, so a row that is most of a table crosses the exchange once per task. What is left
of a row is given out as often as it counts. Two NULLs are the same here, as in SQL's set operations.

``not_in`` is SQL's NOT IN: a NULL on either side is unknown. Spark plans that as a nested loop over the whole right side; here it
is an anti join on the keys and two numbers about the right side: its rows, and its NULLs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row per different row: _l and _r, how often either table has it."""
    if len(left.columns) != len(right.columns):
        raise ValueError(f"{len(left.columns)} and {len(right.columns)} columns")
    names = [f"_c{i}" for i in range(len(left.columns))]
    a = left.toDF(*names).groupBy(*names).agg(F.count(F.lit(1)).alias("_l"))
    b = right.toDF(*names).groupBy(*names).agg(F.count(F.lit(1)).alias("_r"))
    zero = F.lit(0).cast("long")
    both = a.withColumn("_r", zero).unionByName(b.withColumn("_l", zero))
    return both.groupBy(*names).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))


def _given_out(counts: DataFrame, times: Column, like: DataFrame) -> DataFrame:
    """Each row as often as ``times`` says; a long row of copies is made a thousand at a time."""
    step = 1000
    rows = counts.withColumn("_n", times).where("_n > 0")
    rows = rows.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / step))))
    rows = rows.withColumn("_here", F.least(F.lit(step).cast("long"), F.col("_n") - F.col("_part") * step))
    rows = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_here"))))
    return rows.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(like.columns)])


def intersect_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Each row as often as both tables have it; columns are matched by place and named as in ``left``."""
    return _given_out(_counts(left, right), F.least("_l", "_r"), left)


def except_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Each row as often as ``left`` has it more than ``right``."""
    return _given_out(_counts(left, right), F.col("_l") - F.col("_r"), left)


def _pairs(left: DataFrame, right: DataFrame, on, right_on) -> tuple[list[str], DataFrame, Column]:
    on = [on] if isinstance(on, str) else list(on)
    right_on = on if right_on is None else [right_on] if isinstance(right_on, str) else list(right_on)
    if len(on) != 1 or len(right_on) != 1:
        raise ValueError("one column on either side; rows of several columns have other rules for NULL")
    keys = right.select(F.col(f"`{right_on[0]}`").alias("_key"))
    return on, keys, F.col(f"`{on[0]}`") == F.col("_key")


def is_in(left: DataFrame, right: DataFrame, on: str | Sequence[str], right_on: str | None = None) -> DataFrame:
    """The rows of ``left`` whose ``on`` is among ``right_on``: NULL is not in anything."""
    _, keys, same = _pairs(left, right, on, right_on)
    return left.join(keys, same, "left_semi")


def not_in(left: DataFrame, right: DataFrame, on: str | Sequence[str], right_on: str | None = None) -> DataFrame:
    """The rows of ``left`` whose ``on`` is not in ``right_on``, as SQL has it: all rows where ``right`` is empty, none where it has a
    NULL, and otherwise those with a value that is not among the keys."""
    on, keys, same = _pairs(left, right, on, right_on)
    # two numbers about the right side, as scalar subqueries
    rows, unknown = keys.agg(F.count(F.lit(1))).scalar(), keys.agg(F.count_if(F.col("_key").isNull())).scalar()
    missing = left.join(keys.where(F.col("_key").isNotNull()), same, "left_anti")
    return missing.where((rows == 0) | (F.col(f"`{on[0]}`").isNotNull() & (unknown == 0)))
