"""Columns that rows are ordered by in time or space, as numbers."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def axis(df: DataFrame, column: str) -> Column:
    """``column`` as a number: microseconds of timestamps (zone-less ones by their own clock), days of dates; NaN is NULL."""
    kind, c = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', `{column}`)")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("bigint")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(c), c).cast("double")
    if isinstance(kind, T.DecimalType):
        return c
    if isinstance(kind, T.NumericType):
        return c.cast("bigint")
    raise ValueError(f"cannot order {column!r} on an axis: {kind.simpleString()}")


def distance(df: DataFrame, column: str, value):
    """A distance on the axis of ``column``: a timedelta for times and dates, a number otherwise."""
    if not isinstance(value, timedelta):
        return value
    micros = value // timedelta(microseconds=1)
    return micros // 86_400_000_000 if isinstance(df.schema[column].dataType, T.DateType) else micros


def orderable(df: DataFrame) -> list[str]:
    """The columns that rows can be sorted by."""
    def ok(kind: T.DataType) -> bool:
        if isinstance(kind, T.ArrayType):
            return ok(kind.elementType)
        if isinstance(kind, T.StructType):
            return all(ok(f.dataType) for f in kind.fields)
        return not isinstance(kind, (T.MapType, T.VariantType))
    return [f.name for f in df.schema.fields if ok(f.dataType)]
