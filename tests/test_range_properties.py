"""Property tests of the range rule (pure planning arithmetic + the Spark part label)."""

from hypothesis import given, settings
from hypothesis import strategies as st

from tablehaul.operators.partition import plan_ranges

bounds = st.tuples(st.integers(-10**12, 10**12), st.integers(0, 10**6)).map(
    lambda t: (t[0], t[0] + t[1]))


@given(bounds, st.integers(1, 2000))
@settings(max_examples=300, deadline=None)
def test_ranges_are_contiguous_and_cover(b, n):
    lo, hi = b
    ranges = plan_ranges(lo, hi, n)
    assert len(ranges) == n
    assert ranges[0][0] == lo and ranges[-1][1] == hi + 1
    for (a, z), (a2, _) in zip(ranges, ranges[1:]):
        assert z == a2 and a <= z
    size = (hi - lo + 1) // n
    if size == 0:
        assert all(a == z for a, z in ranges[:-1])
    else:
        assert all(z - a == size for a, z in ranges[:-1])
        assert ranges[-1][1] - ranges[-1][0] >= size


@given(bounds, st.integers(1, 50), st.data())
@settings(max_examples=200, deadline=None)
def test_every_value_falls_in_exactly_one_range(b, n, data):
    lo, hi = b
    ranges = plan_ranges(lo, hi, n)
    v = data.draw(st.integers(lo, hi))
    hits = [i for i, (a, z) in enumerate(ranges) if a <= v < z]
    assert len(hits) == 1
    size = (hi - lo + 1) // n
    expected = n - 1 if size == 0 else min((v - lo) // size, n - 1)
    assert hits[0] == expected


def test_spark_label_matches_rule(spark):
    from pyspark.sql import functions as F

    from tablehaul.operators.partition import partition_assign
    df = spark.range(-3000, 3000, 7).select((F.col("id") * 13).alias("v"))
    for n in (1, 5, 64, 100000):
        values = range(-3000, 3000, 7)
        ranges = plan_ranges(min(values) * 13, max(values) * 13, n)
        for r in partition_assign(df, "v", n).collect():
            a, z = ranges[r.part]
            assert a <= r.v < z
