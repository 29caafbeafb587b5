"""Range rule of partitioned reads (FIXTURES §2 and SURVEY 2.4)."""

import pytest
from pyspark.sql import functions as F

from tablehaul.operators.partition import (partition_assign, partition_bounds, partition_counts,
                                           plan_ranges, range_predicates)

TEST_TABLE = [
    (1, 3, "str1", None, True),
    (2, None, "str2", 2.2, False),
    (0, 5, "a", 3.1, None),
    (3, 7, "b", 3.0, False),
    (4, 9, "c", 7.8, None),
    (1314, 2, None, -10.0, True),
]
TT_SCHEMA = "test_int int, test_nullint int, test_str string, test_float double, test_bool boolean"


def tt(spark):
    return spark.createDataFrame(TEST_TABLE, TT_SCHEMA)


def test_plan_ranges_worked_examples():
    assert plan_ranges(0, 9, 4) == [(0, 2), (2, 4), (4, 6), (6, 10)]
    assert plan_ranges(1, 3, 8) == [(1, 1)] * 7 + [(1, 4)]
    assert plan_ranges(0, 1314, 3) == [(0, 438), (438, 876), (876, 1315)]
    assert plan_ranges(5, 5, 1) == [(5, 6)]
    assert plan_ranges(-10, -1, 2) == [(-10, -5), (-5, 0)]
    with pytest.raises(ValueError):
        plan_ranges(0, 9, 0)


def test_range_predicates_text():
    preds = range_predicates("c", [(0, 2), (2, 10)], keep_nulls=True)
    assert preds == ["0 <= c AND c < 2", "2 <= c AND c < 10", "c IS NULL"]


def test_counts_on_test_int(spark):
    counts = {r.part: r.n for r in partition_counts(tt(spark), "test_int", 3).collect()}
    assert counts == {0: 5, 1: 0, 2: 1}


def test_null_rows_dropped_unless_kept(spark):
    counts = {r.part: r.n for r in partition_counts(tt(spark), "test_nullint", 2).collect()}
    assert counts == {0: 3, 1: 2}
    kept = {r.part: r.n for r in partition_counts(tt(spark), "test_nullint", 2,
                                                     keep_nulls=True).collect()}
    assert kept == {0: 3, 1: 2, 2: 1}


def test_bounds_and_empty_input(spark):
    assert tuple(partition_bounds(tt(spark), "test_int").first()) == (0, 1314)
    empty = tt(spark).where("false")
    assert tuple(partition_bounds(empty, "test_int").first()) == (0, 0)
    fl = spark.createDataFrame([(-2.5,), (9.7,)], "x double")
    assert tuple(partition_bounds(fl, "x").first()) == (-3, 9)


def test_given_bounds_drop_outside_rows(spark):
    parts = partition_assign(tt(spark), "test_int", 2, bounds=(1, 4))
    assert sorted(r.test_int for r in parts.collect()) == [1, 2, 3, 4]
    with pytest.raises(ValueError):
        partition_assign(tt(spark), "test_int", 2, bounds=(1, None))


def test_parts_are_disjoint_and_cover_non_null_rows(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1003 - 500).alias("v"))
    lo, hi = tuple(partition_bounds(df, "v").first())
    values = sorted(r.v for r in df.collect())
    for n in (1, 2, 3, 8, 5000):
        ranges = plan_ranges(lo, hi, n)
        labelled = {(r.v, r.part) for r in partition_assign(df, "v", n).collect()}
        assert len(labelled) == 1000  # every row once, in exactly one part
        for v, part in labelled:
            a, b = ranges[part]
            assert a <= v < b
        assert sorted(v for v, _ in labelled) == values


def test_fractional_column(spark):
    df = spark.createDataFrame([(x / 2,) for x in range(-21, 20)], "x double")
    labelled = partition_assign(df, "x", 4)
    assert labelled.count() == 41  # floor of the minimum keeps -10.5
    preds = range_predicates("x", plan_ranges(-11, 9, 4))
    assert sum(df.where(p).count() for p in preds) == 41


def test_result_independent_of_input_partitioning(spark):
    df = spark.range(0, 5000)
    a = partition_counts(df, "id", 6).orderBy("part").collect()
    b = partition_counts(df.repartition(13), "id", 6).orderBy("part").collect()
    assert a == b


def test_non_numeric_column_is_refused(spark):
    with pytest.raises(ValueError):
        partition_counts(tt(spark), "test_str", 2)
    with pytest.raises(ValueError):
        partition_bounds(tt(spark), "test_str")


def test_nan_counts_as_null(spark):
    inf = float("inf")
    df = spark.createDataFrame([(1.0,), (5.0,), (9.5,), (float("nan"),), (None,), (inf,), (-inf,)], "x double")
    assert tuple(partition_bounds(df, "x").first()) == (1, 9)
    got = partition_assign(df, "x", 2)
    assert sorted((r.x, r.part) for r in got.collect()) == [(1.0, 0), (5.0, 1), (9.5, 1)]
    kept = partition_assign(df, "x", 2, keep_nulls=True)
    assert kept.count() == 5 and kept.where("part = 2").count() == 2
    assert sorted(tuple(r) for r in partition_counts(df, "x", 2, keep_nulls=True).collect()) == [(0, 1), (1, 2), (2, 2)]
