"""Synthetic rows by row number: a test source whose values are a function of the index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.setops import union_parts


def _value(i, field: T.StructField):
    dt = field.dataType
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return i.cast(dt)
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return i.cast(dt)
    if isinstance(dt, T.StringType):
        return i.cast("string")
    if isinstance(dt, T.BooleanType):
        if not field.nullable:
            return i % 2 == 0
        return F.when(i % 3 == 0, F.lit(True)).when(i % 3 == 1, F.lit(False)) \
            .otherwise(F.lit(None).cast("boolean"))
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        now = F.current_timestamp().cast(dt)
        return now if not field.nullable else F.when(i % 2 == 0, now)
    raise TypeError(f"generator has no rule for {dt.simpleString()}")


def row_generator(spark: SparkSession, part_rows: Sequence[int], schema: T.StructType | str) -> DataFrame:
    """One part per entry of ``part_rows``; in each part row i (restarting at 0) holds:
    integers and floats = i, strings = str(i), non-null booleans = (i even),
    nullable booleans = true/false/NULL for i mod 3 = 0/1/2, timestamps = now
    (nullable: NULL on odd rows). Each part is a ``spark.range`` — no driver data."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    parts = []
    for n in part_rows:
        i = F.col("id")
        parts.append(spark.range(int(n)).select(
            *[_value(i, f).alias(f.name) for f in schema.fields]))
    return union_parts(parts)
