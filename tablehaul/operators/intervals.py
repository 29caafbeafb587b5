"""Joins on ranges: points in intervals, and intervals that overlap, as equi-joins on bins of the axis.

An interval belongs to the level whose bins are at least as long as it is (each level's are GROWTH times those of the
level below), so it lies in two bins at most, however long it is. A point is looked up in its bin of every level in
use; two intervals meet at the higher one of their levels. A pair is found in one bin only: a point has one on a
level, and two intervals meet in the bin where the later one starts. The plan has no nested loop and no cross product;
skewed bins are split by AQE, or by ``salt``.

Which levels are in use, and the length of the shortest bins, come from one aggregate over the intervals (a row per level).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .axis import axis, distance

GROWTH = 8
MAX_LEVEL = 30


def _names(on: str | Sequence[str] | None) -> list[str]:
    return [] if on is None else [on] if isinstance(on, str) else list(on)


def _spans(df: DataFrame, start: str, end: str, keys: list[str], payload: str, closed: bool) -> DataFrame:
    """(keys, _s, _e, payload) of the intervals that are not empty."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(payload)
    out = df.select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)], axis(df, start).alias("_s"), axis(df, end).alias("_e"), row)
    return out.where(F.col("_s") <= F.col("_e") if closed else F.col("_s") < F.col("_e"))


def _level(base) -> Column:
    length = (F.col("_e") - F.col("_s")).cast("double")
    steps = F.ceil(F.log(float(GROWTH), length / F.lit(float(base))))
    return F.when(length <= F.lit(float(base)), F.lit(0)).otherwise(F.least(F.greatest(steps, F.lit(0)), F.lit(MAX_LEVEL))).cast("int")


def _base(spans: list[DataFrame], bin):
    """The shortest bins: given, or the mean length of the intervals."""
    if bin is not None:
        if bin <= 0:
            raise ValueError("bin must be > 0")
        return bin
    lengths = [s.select((F.col("_e") - F.col("_s")).cast("double").alias("n")) for s in spans]
    found = lengths[0].unionAll(lengths[1]) if len(lengths) > 1 else lengths[0]
    mean = found.agg(F.avg("n")).first()[0]
    return mean if mean and mean > 0 else 1.0


def _levels(spans: list[DataFrame]) -> list[int]:
    """The levels in use: at most MAX_LEVEL + 1 rows."""
    return sorted({r[0] for s in spans for r in s.select("_level").distinct().collect()})


def _bin(place: Column, level: Column, base) -> Column:
    return F.floor(place.cast("double") / (F.lit(float(base)) * F.pow(F.lit(float(GROWTH)), level)))


def _binned(spans: DataFrame, base, levels: list[int] | None) -> DataFrame:
    """One row per bin: at the interval's own level, and at those of ``levels`` above it."""
    if levels is None:
        out = spans.withColumn("_at", F.col("_level"))
    else:
        above = F.filter(F.lit(levels).cast("array<int>"), lambda x: x >= F.col("_level"))
        out = spans.withColumn("_at", F.explode(above))
    bins = F.sequence(_bin(F.col("_s"), F.col("_at"), base), _bin(F.col("_e"), F.col("_at"), base))
    return out.withColumn("_bin", F.explode(bins))


def _shown(joined: DataFrame, a: DataFrame, b: DataFrame, left: str, right: str, skip: list[str], suffix: str) -> DataFrame:
    kept = [c for c in b.columns if c not in skip]
    return joined.select(*[F.col(left)[c].alias(c) for c in a.columns],
                         *[F.col(right)[c].alias(c + suffix if c in a.columns else c) for c in kept])


def _salted(many: DataFrame, few: DataFrame, salt: int, payload: str) -> tuple[DataFrame, DataFrame, list[str]]:
    if salt <= 1:
        return many, few, []
    pick = F.pmod(F.xxhash64(payload), F.lit(salt)).cast("int")
    return many.withColumn("_salt", pick), few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1)))), ["_salt"]


def range_join(points: DataFrame, intervals: DataFrame, point: str, start: str, end: str, on: str | Sequence[str] | None = None,
               closed: bool = False, bin=None, salt: int = 1, suffix: str = "_right") -> DataFrame:
    """Every pair of a point and an interval around it: ``start <= point < end`` (``<= end`` where ``closed``), with
    equal ``on`` values where given.

    NULL (or NaN) places, NULL keys and intervals that end before they start match nothing; repeated rows pair
    as often as they occur. ``bin`` is the length of the shortest bins (a number or a timedelta; the mean length of the intervals where None).
    ``salt`` spreads the points of every bin over that many tasks and copies the intervals to each.
    """
    keys = _names(on)
    spans = _spans(intervals, start, end, keys, "_i", closed)
    base = _base([spans], distance(intervals, start, bin))
    spans = spans.withColumn("_level", _level(base))
    levels = _levels([spans])
    row = F.struct(*[F.col(f"`{c}`") for c in points.columns]).alias("_p")
    places = points.select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)], axis(points, point).alias("_x"), row)
    places = places.where(F.col("_x").isNotNull()).withColumn("_at", F.explode(F.lit(levels).cast("array<int>")))
    places = places.withColumn("_bin", _bin(F.col("_x"), F.col("_at"), base))
    many, few, more = _salted(places, _binned(spans, base, None), salt, "_p")
    joined = many.join(few, [*(f"_k{i}" for i in range(len(keys))), "_at", "_bin", *more])
    inside = F.col("_x") <= F.col("_e") if closed else F.col("_x") < F.col("_e")
    return _shown(joined.where((F.col("_s") <= F.col("_x")) & inside), points, intervals, "_p", "_i", keys, suffix)


def interval_join(left: DataFrame, right: DataFrame, left_span: tuple[str, str], right_span: tuple[str, str] | None = None,
                  on: str | Sequence[str] | None = None, closed: bool = False, bin=None, salt: int = 1,
                  suffix: str = "_right") -> DataFrame:
    """Every pair of overlapping intervals (half-open, or with both ends where ``closed``), with equal ``on`` values where given.

    NULLs, empty intervals and repeated rows as in ``range_join``.
    """
    keys = _names(on)
    a = _spans(left, *left_span, keys, "_l", closed)
    b = _spans(right, *(right_span or left_span), keys, "_r", closed)
    base = _base([a, b], distance(left, left_span[0], bin))
    a, b = a.withColumn("_level", _level(base)), b.withColumn("_level", _level(base))
    levels = _levels([a, b])
    a, b = _binned(a, base, levels), _binned(b, base, levels)
    b = b.withColumnsRenamed({"_s": "_s2", "_e": "_e2", "_level": "_level2"})
    many, few, more = _salted(a, b, salt, "_l")
    joined = many.join(few, [*(f"_k{i}" for i in range(len(keys))), "_at", "_bin", *more])
    meet = (F.col("_s") <= F.col("_e2")) & (F.col("_s2") <= F.col("_e")) if closed else (F.col("_s") < F.col("_e2")) & (F.col("_s2") < F.col("_e"))
    own = F.col("_at") == F.greatest("_level", "_level2")
    first = F.col("_bin") == _bin(F.greatest("_s", "_s2"), F.col("_at"), base)
    return _shown(joined.where(own & first & meet), left, right, "_l", "_r", keys, suffix)
