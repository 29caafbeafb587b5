"""Cube, rollup and grouping sets, with several distinct counts.

The rows are aggregated once, at the finest level. The other levels are made from that result: only its rows are copied
to each level, not those of the table. A distinct count isn't the sum of finer ones, so each counted column has a result of its
own, the distinct pairs of the dimensions and its values, made once and copied to the levels. Both steps deal their rows over as
many tasks as the table's rows ask for, so a task's share stays the same however large the table is. The levels of all these are
put together by one exchange on (grouping_id, dimensions).

The dimension that a level leaves out is NULL, and ``grouping_id`` tells such a NULL from one in the data: its bits are 1 for
the dimensions left out, the last dimension the lowest.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ADDED_UP = {"sum": (F.sum, F.sum), "count": (F.count, F.sum), "min": (F.min, F.min), "max": (F.max, F.max)}

# Rows of the table for each task that tells apart the values of a distinct count.
DISTINCT_ROWS = 500_000


def cube_sets(dims: Sequence[str]) -> list[tuple[str, ...]]:
    return [s for n in range(len(dims), -1, -1) for s in combinations(dims, n)]


def rollup_sets(dims: Sequence[str]) -> list[tuple[str, ...]]:
    return [tuple(dims[:n]) for n in range(len(dims), -1, -1)]


def _at_levels(fine: DataFrame, dims: list[str], sets: list[tuple[str, ...]]) -> DataFrame:
    """A copy of each row for each level: _g, and the dimensions that the level has."""
    levels = []
    for s in sets:
        number = sum((d not in s) << (len(dims) - 1 - i) for i, d in enumerate(dims))
        levels.append(F.struct(F.lit(number).cast("long").alias("_g"), *[
            (F.col(f"`{d}`") if d in s else F.lit(None).cast(dict(fine.dtypes)[d])).alias(f"_d{i}") for i, d in enumerate(dims)]))
    rest = [c for c in fine.columns if c not in dims]
    return fine.select(F.explode(F.array(*levels)).alias("_level"), *[f"`{c}`" for c in rest]).select("_level.*", *[f"`{c}`" for c in rest])


def levels(df: DataFrame, dims: Sequence[str], aggregates: dict | None = None, distinct: dict[str, str] | None = None,
           sets: str | Sequence[Sequence[str]] = "cube") -> DataFrame:
    """Rows (dims, grouping_id, aggregates, distinct counts) of all levels: "cube", "rollup", or the given sets of dimensions.

    ``aggregates``: name -> (sum, count, min, max or avg, column); the column ``"*"`` counts rows. ``distinct``: name -> column whose
    different values (NULL not among them) are counted. A level that is named twice is there once. The level without
    dimensions has a row for a table without rows too, as in SQL.
    """
    dims, aggregates, distinct = list(dims), dict(aggregates or {}), dict(distinct or {})
    if not aggregates and not distinct:
        raise ValueError("nothing to aggregate")
    chosen = cube_sets(dims) if sets == "cube" else rollup_sets(dims) if sets == "rollup" else [tuple(s) for s in sets]
    unknown = {d for s in chosen for d in s} - set(dims)
    if unknown:
        raise ValueError(f"not a dimension: {sorted(unknown)}")
    chosen = list(dict.fromkeys(tuple(d for d in dims if d in s) for s in chosen))
    key = ["_g", *(f"_d{i}" for i in range(len(dims)))]

    partial, again, shown = [], [], {}
    for i, (name, (fn, column)) in enumerate(aggregates.items()):
        c = F.lit(1) if column == "*" else F.col(f"`{column}`")
        for part in (("sum", "count") if fn == "avg" else (fn,)):
            if part not in ADDED_UP:
                raise ValueError(f"cannot add up {fn!r}")
            fine, coarse = ADDED_UP[part]
            partial.append(fine(c).alias(f"_{part}{i}"))
            again.append(coarse(f"_{part}{i}").alias(f"_{part}{i}"))
        shown[name] = (F.col(f"_sum{i}") / F.col(f"_count{i}") if fn == "avg" else F.coalesce(f"_count{i}", F.lit(0)) if fn == "count"
                       else F.col(f"_{fn}{i}"))
    # one long table of the levels of all parts, each row with the columns of its own part
    pieces = []
    if partial:
        fine = df.groupBy(*[f"`{d}`" for d in dims]).agg(*partial)
        pieces.append(_at_levels(fine, dims, chosen).groupBy(*key).agg(*again))
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // DISTINCT_ROWS)) if distinct else 0
    for i, (name, column) in enumerate(distinct.items()):
        values = df.where(F.col(f"`{column}`").isNotNull()).select(*[f"`{d}`" for d in dims], F.col(f"`{column}`").alias("_v"))
        pairs = values.repartition(tasks, *[f"`{d}`" for d in dims], "_v").distinct()
        at_levels = _at_levels(pairs, dims, chosen).repartition(tasks, *key, "_v")
        counted = at_levels.distinct().groupBy(*key).agg(F.count("_v").alias(f"_n{i}"))
        pieces.append(counted)
        shown[name] = F.coalesce(f"_n{i}", F.lit(0))
    if distinct and not partial:  # levels all of whose values are NULL
        pieces.append(_at_levels(df.select(*[f"`{d}`" for d in dims]).distinct(), dims, chosen).distinct())
    if () in chosen:  # the level of all rows, which is there without rows
        whole = sum(1 << i for i in range(len(dims)))
        none = df.sparkSession.range(1).select(F.lit(whole).cast("long").alias("_g"), *[
            F.lit(None).cast(dict(df.dtypes)[d]).alias(f"_d{i}") for i, d in enumerate(dims)])
        pieces.append(none)
    out = pieces[0]
    for p in pieces[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    rest = [c for c in out.columns if c not in key]
    out = out.groupBy(*key).agg(*[F.max(c).alias(c) for c in rest])  # at most one row has a value
    return out.select(*[F.col(f"_d{i}").alias(d) for i, d in enumerate(dims)], F.col("_g").alias("grouping_id"),
                      *[shown[n].alias(n) for n in [*aggregates, *distinct]])
