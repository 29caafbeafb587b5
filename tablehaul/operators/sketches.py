"""Sketches that are stored and merged: distinct counts (HLL) and quantiles (KLL), of any level made from the parts.

``sketch_parts`` reads the rows once and keeps one small row per part (keys, say a day and a region): its sketches, its row count.
``merge_parts`` makes coarser parts of stored ones without looking at the rows again, over parts of several tables or
days too; merging is associative, so it can be done in any steps. ``estimates`` reads numbers from the sketches.

An HLL sketch of 2**``lg_k`` buckets has a relative standard error of about 0.83 / 2**(lg_k / 2) (2.6 % for 10, at most 4 KB each). A KLL
sketch of size ``k`` has a rank error of about 1.65 % at 200. Merging the parts of a table gives an HLL estimate equal to
one over all rows; a KLL sketch may differ within its error. Both aggregate where the rows are read, so a part with most of the rows
crosses the exchange as one sketch per task.

NULLs are not counted; a part without a value has NULL for a sketch, and its estimates are 0 and NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LG_K = 12
KLL_K = 200
# Families of Spark's KLL functions by the type of a column.
_KLL = {T.ByteType: "bigint", T.ShortType: "bigint", T.IntegerType: "bigint", T.LongType: "bigint", T.FloatType: "double",
        T.DoubleType: "double"}


def _kll(df: DataFrame, column: str) -> tuple[str, Column]:
    kind = df.schema[column].dataType
    family = _KLL.get(type(kind))
    if family is None:
        raise ValueError(f"no quantiles of {column!r}: {kind.simpleString()}")
    c = F.col(f"`{column}`")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        c = F.when(~F.isnan(c), c)
    return family, c.cast(family)


def _countable(df: DataFrame, column: str) -> Column:
    """A column in a type that HLL sketches take."""
    kind, c = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, (T.IntegerType, T.LongType, T.StringType, T.BinaryType)):
        return c
    return c.cast("bigint") if isinstance(kind, (T.ByteType, T.ShortType)) else c.cast("string")


def sketch_parts(df: DataFrame, keys: Sequence[str], distinct: Sequence[str] = (), quantiles: Sequence[str] = (),
                 lg_k: int = LG_K, k: int = KLL_K) -> DataFrame:
    """One row per part: the keys, n_rows, ``hll_<column>`` for each of ``distinct``, ``kll_<column>`` for each of ``quantiles``."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for c in distinct:
        seen = F.count(f"`{c}`")
        aggs.append(F.when(seen > 0, F.hll_sketch_agg(_countable(df, c), lg_k)).alias(f"hll_{c}"))
    for c in quantiles:
        family, value = _kll(df, c)
        aggs.append(F.when(F.count(value) > 0, getattr(F, f"kll_sketch_agg_{family}")(value, k)).alias(f"kll_{c}"))
        aggs.append(F.lit(family).alias(f"kind_{c}"))
    return df.groupBy(*[f"`{x}`" for x in keys]).agg(*aggs)


def _sketched(parts: DataFrame, prefix: str) -> list[str]:
    return [c[len(prefix):] for c in parts.columns if c.startswith(prefix)]


def merge_parts(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Coarser parts, in the same form: the stored ones with equal ``keys`` put together."""
    aggs = [F.sum("n_rows").alias("n_rows")]
    for c in _sketched(parts, "hll_"):
        aggs.append(F.when(F.count(f"hll_{c}") > 0, F.hll_union_agg(f"hll_{c}", True)).alias(f"hll_{c}"))
    kinds = _kinds(parts)
    for c in _sketched(parts, "kll_"):
        merged = getattr(F, f"kll_merge_agg_{kinds[c]}")(f"kll_{c}")
        aggs += [F.when(F.count(f"kll_{c}") > 0, merged).alias(f"kll_{c}"), F.lit(kinds[c]).alias(f"kind_{c}")]
    return parts.groupBy(*[f"`{x}`" for x in keys]).agg(*aggs)


def _kinds(parts: DataFrame) -> dict[str, str]:
    """The family of each quantile column: the same in all parts, so one row tells."""
    names = _sketched(parts, "kind_")
    row = parts.select(*[f"kind_{c}" for c in names]).first() if names else None
    return {c: row[f"kind_{c}"] if row else "double" for c in names}


def estimates(parts: DataFrame, at: Sequence[float] = (0.5,)) -> DataFrame:
    """The parts with numbers for sketches: ``n_distinct_<column>``, and ``q_<column>``, an array of the quantiles ``at``."""
    kinds = _kinds(parts)
    drop = [f"{p}{c}" for p in ("hll_", "kll_", "kind_") for c in _sketched(parts, p)]
    out = {f"n_distinct_{c}": F.coalesce(F.hll_sketch_estimate(f"hll_{c}"), F.lit(0)) for c in _sketched(parts, "hll_")}
    for c in _sketched(parts, "kll_"):
        read = getattr(F, f"kll_sketch_get_quantile_{kinds[c]}")
        out[f"q_{c}"] = F.when(F.col(f"kll_{c}").isNotNull(), F.array(*[read(f"kll_{c}", F.lit(float(q))) for q in at]))
    return parts.withColumns(out).drop(*drop)
