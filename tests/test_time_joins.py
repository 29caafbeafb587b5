"""As-of, range and interval joins against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tablehaul.operators.asof import asof_join
from tablehaul.operators.intervals import interval_join, range_join


def events(seed, n, keys="ab", places=40):
    rng = random.Random(seed)
    return [(rng.choice(keys) if rng.random() < 0.95 else None, rng.choice([None, *range(places)] if i % 11 == 0 else range(places)), i)
            for i in range(n)]


def brute_asof(left, right, direction, exact, tolerance, how):
    out = []
    for k, t, i in left:
        found = []
        for k2, t2, j in right:
            if None in (k, t, k2, t2) or k != k2:
                continue
            ahead = (t - t2) if direction == "backward" else (t2 - t)
            if ahead < 0 or (ahead == 0 and not exact) or (tolerance is not None and ahead > tolerance):
                continue
            found.append((-ahead, j, t2))
        best = max(found, default=None)
        if best or how == "left":
            out.append((k, t, i, best[2] if best else None, best[1] if best else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("exact, tolerance, how, bucket", [(True, None, "left", 3), (False, None, "left", None), (True, 2, "inner", 1),
                                                           (False, 5, "left", 7), (True, None, "inner", 1000)])
def test_asof_join(spark, direction, exact, tolerance, how, bucket):
    left = events(1, 150, "aaaaaaab") + [("a", 10, 900)] * 3 + [("only left", 4, 901)]
    right = events(2, 90, "aab") + [("only right", 4, 902)]
    a = spark.createDataFrame(left, "k string, t int, id int")
    b = spark.createDataFrame(right, "k string, t int, id int")
    got = asof_join(a, b, "k", "t", direction=direction, exact=exact, tolerance=tolerance, how=how, bucket=bucket, bucket_rows=20,
                    tie_by=["id"])
    assert got.columns == ["k", "t", "id", "t_right", "id_right"]
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute_asof(left, right, direction, exact, tolerance, how)


def test_asof_join_of_times_types_and_empty_sides(spark):
    day = dt.datetime(2024, 3, 31)
    rows = [(1, day + dt.timedelta(hours=h), h) for h in range(0, 48, 5)]
    a = spark.createDataFrame(rows, "u int, at timestamp_ntz, v int")
    b = spark.createDataFrame([(1, day + dt.timedelta(hours=h, minutes=30), {"h": h}) for h in range(-3, 48, 7)],
                              "u int, seen timestamp_ntz, m map<string, int>")
    got = asof_join(a, b, ["u"], "at", "seen", tolerance=dt.timedelta(hours=4), bucket=dt.timedelta(hours=6)).collect()
    for r in got:
        before = [h for h in range(-3, 48, 7) if h + 0.5 <= r.v and r.v - h - 0.5 <= 4]
        assert (r.m or {}).get("h") == (max(before) if before else None)
    assert len(got) == len(rows)
    assert asof_join(a.limit(0), b, "u", "at", "seen").count() == 0
    assert {r.seen for r in asof_join(a, b.limit(0), "u", "at", "seen").collect()} == {None}
    with pytest.raises(ValueError):
        asof_join(a, b, "u", "at", "seen", direction="nearest")
    floats = spark.createDataFrame([(1, 0.5), (1, float("nan")), (None, 1.0), (1, None), (1, 2.5)], "k int, x double")
    got = asof_join(floats, floats, "k", "x", exact=False).collect()
    assert sorted(str((r.x, r.x_right)) for r in got) == sorted(
        str(x) for x in [(0.5, None), (float("nan"), None), (1.0, None), (None, None), (2.5, 0.5)])


def test_asof_join_spreads_a_hot_key_and_stays_off_python(spark):
    a = spark.range(0, 20_000).select(F.lit(1).alias("k"), F.col("id").alias("t"))
    b = spark.range(0, 20_000, 50).select(F.lit(1).alias("k"), F.col("id").alias("t"), F.col("id").alias("found"))
    got = asof_join(a, b, "k", "t", bucket_rows=500)
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    assert got.where("found <> t - t % 50 OR found IS NULL").count() == 0 and got.count() == 20_000
    # the windows are dealt by key and bucket: no task has the whole key
    dealt = [line for line in plan.split("\n") if "hashpartitioning" in line and "_b" in line]
    assert dealt


def spells(seed, n, longest, keys="ab"):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        s = rng.randrange(200)
        length = rng.choice([0, 1, 2, 5, longest, -3])
        out.append((rng.choice(keys), None if i % 17 == 0 else s, None if i % 19 == 0 else s + length, i))
    return out + out[:5]


def ok(s, e, closed):
    return s is not None and e is not None and (s <= e if closed else s < e)


@pytest.mark.parametrize("closed", [False, True])
@pytest.mark.parametrize("on, bin, salt", [("k", None, 1), (None, 1, 1), ("k", 7, 3), (None, 1000, 2)])
def test_range_join(spark, closed, on, bin, salt):
    points = [("ab"[i % 2], None if i % 13 == 0 else i % 220, i) for i in range(120)] + [(None, 5, 500)]
    rows = spells(3, 80, 900) + [(None, 0, 100, 501)]
    a = spark.createDataFrame(points, "k string, x int, id int")
    b = spark.createDataFrame(rows, "k string, s int, e int, id int")
    got = range_join(a, b, "x", "s", "e", on=on, closed=closed, bin=bin, salt=salt)
    want = [(*p, *((r[0],) if on is None else ()), *r[1:]) for p in points for r in rows
            if p[1] is not None and ok(r[1], r[2], closed) and r[1] <= p[1] and (p[1] <= r[2] if closed else p[1] < r[2])
            and (on is None or (p[0] is not None and p[0] == r[0]))]
    assert sorted([tuple(r) for r in got.collect()], key=str) == sorted(want, key=str)
    plan = got._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("closed", [False, True])
@pytest.mark.parametrize("on, bin, salt", [("k", None, 1), (None, 1, 1), ("k", 7, 3), (None, 1000, 2)])
def test_interval_join(spark, closed, on, bin, salt):
    one, two = spells(5, 70, 300), spells(6, 60, 5000) + [(None, 0, 100, 501)]
    a = spark.createDataFrame(one, "k string, s int, e int, id int")
    b = spark.createDataFrame(two, "k string, s2 int, e2 int, id int")
    got = interval_join(a, b, ("s", "e"), ("s2", "e2"), on=on, closed=closed, bin=bin, salt=salt)
    want = [(*p, *((r[0],) if on is None else ()), *r[1:]) for p in one for r in two
            if ok(p[1], p[2], closed) and ok(r[1], r[2], closed)
            and ((p[1] <= r[2] and r[1] <= p[2]) if closed else (p[1] < r[2] and r[1] < p[2])) and (on is None or p[0] == r[0])]
    assert sorted([tuple(r) for r in got.collect()], key=str) == sorted(want, key=str)
    plan = got._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert interval_join(a.limit(0), b, ("s", "e"), ("s2", "e2"), on=on).count() == 0
