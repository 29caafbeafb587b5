"""As-of join: each left row with the nearest right row before (or after) it on an axis, within equal keys.

Both sides go through one exchange, dealt by key and by bucket of the axis, so a key with most of the rows is
spread over its buckets. Within a bucket a window carries the last right row on; over the borders of
buckets, the last right row of each (key, bucket) does, one small row each. Nothing runs on Python workers, and the plan
is lazy but for one aggregate that chooses the bucket's width where none is given.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .axis import axis, distance, orderable

# Rows of both sides in a bucket, on average over the axis, where the width is chosen here.
BUCKET_ROWS = 200_000


def _width(left: DataFrame, right: DataFrame, rows: int) -> float | int:
    """Even buckets of about ``rows`` rows from the number of rows and the ends of the axis (one row)."""
    both = left.select("_t").unionAll(right.select("_t"))
    found = both.agg(F.count("_t").alias("n"), F.min("_t").alias("lo"), F.max("_t").alias("hi")).first()
    pieces = max(1, (found["n"] or 0) // rows)
    span = (found["hi"] - found["lo"]) if found["n"] else 0
    return span / pieces if span > 0 else 1


def asof_join(left: DataFrame, right: DataFrame, on: str | Sequence[str], left_on: str, right_on: str | None = None,
              direction: str = "backward", tolerance=None, exact: bool = True, how: str = "left", tie_by: Sequence[str] | None = None,
              suffix: str = "_right", bucket=None, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``left`` with the columns of its as-of partner in ``right``.

    The partner has the same ``on`` values and the greatest ``right_on`` <= the row's ``left_on`` (``backward``), or the
    least >= it (``forward``); with ``exact=False`` equal ones don't count. ``tolerance`` bounds the distance (a timedelta
    or a number). Of right rows that tie, the one with the greatest values in ``tie_by`` is taken (backward and forward
    alike; all columns that can be ordered, where it is None). ``bucket`` sets the width of the buckets on the axis.

    A left row comes once, whatever it finds; one with a NULL key or NULL (or NaN) place finds nothing, and right rows with
    one are never found. ``how="inner"`` leaves out rows without a partner. Right columns (without the keys) that clash get ``suffix``.
    """
    if direction not in ("backward", "forward") or how not in ("left", "inner"):
        raise ValueError("direction is backward or forward, how is left or inner")
    keys = [on] if isinstance(on, str) else list(on)
    right_on = right_on or left_on
    sign = 1 if direction == "backward" else -1
    names = [f"_k{i}" for i in range(len(keys))]

    def placed(df: DataFrame, at: str, payload: str) -> DataFrame:
        row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(payload)
        return df.select(*[F.col(f"`{k}`").alias(n) for k, n in zip(keys, names)], (axis(df, at) * sign).alias("_t"), row)

    def whole() -> Column:
        present = F.col("_t").isNotNull()
        for n in names:
            present = present & F.col(n).isNotNull()
        return present

    lefts, rights = placed(left, left_on, "_l"), placed(right, right_on, "_r").where(whole())
    ties = orderable(right) if tie_by is None else list(tie_by)
    rights = rights.withColumn("_tie", F.struct(*[F.col("_r")[c] for c in ties]) if ties else F.lit(0))
    known = lefts.where(whole())
    width = distance(left, left_on, bucket) if bucket is not None else _width(known, rights, bucket_rows)
    if width <= 0:
        raise ValueError("bucket must be > 0")
    number = F.floor(F.col("_t") / F.lit(width)).alias("_b")
    known, rights = known.select("*", number), rights.select("*", number)

    # right rows before or after the left rows of the same place
    both = known.withColumn("_side", F.lit(1 if exact else 0)).unionByName(
        rights.withColumn("_side", F.lit(0 if exact else 1)), allowMissingColumns=True)
    order = ["_t", "_side", F.asc_nulls_first("_tie")]
    seen = Window.partitionBy(*names, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    partner = F.when(F.col("_r").isNotNull(), F.struct("_t", "_r"))
    within = both.withColumn("_near", F.last(partner, ignorenulls=True).over(seen)).where(F.col("_l").isNotNull())

    # one row per (key, bucket) of either side: what its last right row is, and what came before it
    last = rights.groupBy(*names, "_b").agg(F.max_by(F.struct("_t", "_r"), F.struct("_t", "_tie")).alias("_last"))
    asked = known.groupBy(*names, "_b").agg(F.lit(None).cast(last.schema["_last"].dataType).alias("_last"))
    steps = last.unionByName(asked).groupBy(*names, "_b").agg(F.first("_last", ignorenulls=True).alias("_last"))
    before = Window.partitionBy(*names).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = (steps.withColumn("_carried", F.last("_last", ignorenulls=True).over(before)).where(F.col("_carried").isNotNull())
               .select(*names, "_b", "_carried"))
    found = within.join(carried, [*names, "_b"], "left").withColumn("_near", F.coalesce("_near", "_carried"))
    if tolerance is not None:
        far = F.col("_t") - F.col("_near")["_t"] > F.lit(distance(left, left_on, tolerance))
        found = found.withColumn("_near", F.when(~far, F.col("_near")))
    out = found.select("_l", F.col("_near")["_r"].alias("_r"))
    if how == "inner":
        out = out.where(F.col("_r").isNotNull())
    else:
        lost = lefts.where(~F.coalesce(whole(), F.lit(False))).select("_l", F.lit(None).cast(out.schema["_r"].dataType).alias("_r"))
        out = out.unionByName(lost)
    kept = [c for c in right.columns if c not in keys]
    return out.select(*[F.col("_l")[c].alias(c) for c in left.columns],
                      *[F.col("_r")[c].alias(c + suffix if c in left.columns else c) for c in kept])
