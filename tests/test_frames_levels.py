"""Frames, levels, bags and sketches against Spark's own plans and brute force."""

import collections
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tablehaul.operators.bags import except_all, intersect_all, is_in, not_in
from tablehaul.operators.frames import running
from tablehaul.operators.levels import levels
from tablehaul.operators.pieces import cuts, piece_of
from tablehaul.operators.sketches import estimates, merge_parts, sketch_parts


def table(spark, n=600, seed=1):
    rng = random.Random(seed)
    rows = [(rng.choice(["hot"] * 8 + ["b", None]), rng.choice([None, *range(40)]), i, rng.choice([None, *range(-5, 9)]),
             rng.choice([1.5, None, -2.0, 8.25])) for i in range(n)]
    return spark.createDataFrame(rows, "k string, t int, id int, v int, x double").repartition(4)


def same(a, b):
    return sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.select(*a.columns).collect()), key=str)


@pytest.mark.parametrize("piece_rows", [1, 37, 10**6])
@pytest.mark.parametrize("down", [False, True])
def test_running_equals_the_window(spark, piece_rows, down):
    df = table(spark)
    first, order = (("t", "desc"), [F.col("t").desc(), F.col("id")]) if down else ("t", [F.col("t"), F.col("id")])
    got = running(df, "k", [first, "id"], {"n": "row_number", "s": ("sum", "v"), "c": ("count", "v"), "lo": ("min", "v"), "hi": ("max", "x"),
                                           "a": ("avg", "x")}, piece_rows)
    w = Window.partitionBy("k").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = df.withColumns({"n": F.row_number().over(Window.partitionBy("k").orderBy(*order)), "s": F.sum("v").over(w), "c": F.count("v").over(w),
                           "lo": F.min("v").over(w), "hi": F.max("x").over(w), "a": F.avg("x").over(w)})
    assert same(got.withColumn("a", F.round("a", 6)), want.withColumn("a", F.round("a", 6)))
    got = running(df, ["k"], [first], {"r": "rank", "d": "dense_rank"}, piece_rows)
    ties = Window.partitionBy("k").orderBy(order[0])
    assert same(got, df.withColumns({"r": F.rank().over(ties), "d": F.dense_rank().over(ties)}))


def test_running_spreads_a_hot_key(spark):
    df = spark.range(0, 40_000).select(F.lit(1).alias("k"), "id")
    found = cuts(df, "id", 1000)
    assert 20 < len(found) < 60
    sizes = df.groupBy(piece_of(F.col("id"), found, "bigint")).count().agg(F.max("count")).first()[0]
    assert sizes < 4000
    got = running(df, "k", "id", {"n": "row_number"}, 1000)
    assert got.where("n <> id + 1").count() == 0 and got.count() == 40_000
    assert "Python" not in got._jdf.queryExecution().toString()


def test_running_shuffles_and_sorts_the_rows_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = running(table(spark), "k", ["t", "id"], {"n": "row_number", "s": ("sum", "v")}, 37)
        plan = got._jdf.queryExecution().executedPlan().toString()
        above, rows = plan[:plan.index("Window")], plan[plan.index("Window"):]
        assert "Exchange" not in above and "Sort [" not in above  # the join takes the rows as the window leaves them
        assert rows[:rows.index("Scan")].count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("kind, values", [("int", [5, 1, 9, 3, 7]), ("string", ["b", "é", "a"]), ("double", [float("nan"), 2.5, -1.0]), ("int", [4])])
def test_pieces_count_the_cuts_at_most_the_key(spark, kind, values):
    keys = values + {"int": [0, 4, 10, None], "string": ["", "aa", "z", None], "double": [0.0, 9.0, None]}[kind]
    df = spark.createDataFrame([(k,) for k in keys], f"k {kind}")
    cut = F.size(F.filter(F.lit(values).cast(f"array<{kind}>"), lambda c: c <= F.col("k")))
    want = F.when(F.col("k").isNotNull(), cut)
    assert df.where(~piece_of(F.col("k"), values, kind).eqNullSafe(want)).count() == 0


def test_running_other_types_empty_and_bad(spark):
    df = spark.createDataFrame([("a", f"w{i:03d}", {"m": i}) for i in range(50)], "k string, s string, m map<string, int>")
    assert [r.n for r in running(df, "k", "s", {"n": "row_number"}, 7).orderBy("s").collect()] == list(range(1, 51))
    assert running(df.limit(0), "k", "s", {"n": "rank", "c": ("count", "s")}).count() == 0
    assert running(df, "k", "s", {"s": "row_number"}).columns == ["k", "m", "s"]  # a name that clashes is replaced
    for bad in ("lag", ("median", "s"), None):
        with pytest.raises(ValueError):
            running(df, "k", "s", {"n": bad})


AGGS = {"n": ("count", "*"), "c": ("count", "v"), "s": ("sum", "v"), "lo": ("min", "x"), "hi": ("max", "id"), "a": ("avg", "v")}


def by_spark(df, sets, dims):
    return df.groupingSets(sets, *[F.col(d) for d in dims]).agg(
        F.grouping_id(*dims).alias("grouping_id"), F.count(F.lit(1)).alias("n"), F.count("v").alias("c"), F.sum("v").alias("s"), F.min("x").alias("lo"),
        F.max("id").alias("hi"), F.avg("v").alias("a"), F.countDistinct("v").alias("dv"), F.countDistinct("x").alias("dx"))


@pytest.mark.parametrize("sets", ["cube", "rollup", [["k"], ["t", "k"], [], ["k"]], [["m"]]])
def test_levels_equal_grouping_sets(spark, sets):
    df = table(spark, 400).withColumn("t", F.col("t") % 4).withColumn("m", F.col("id") % 3)
    dims = ["k", "t", "m"]
    from tablehaul.operators.levels import cube_sets, rollup_sets
    chosen = cube_sets(dims) if sets == "cube" else rollup_sets(dims) if sets == "rollup" else list(dict.fromkeys(tuple(sorted(s)) for s in sets))
    want = by_spark(df, [[F.col(d) for d in s] for s in chosen], dims)
    got = levels(df, dims, AGGS, {"dv": "v", "dx": "x"}, sets)
    assert same(got, want)
    assert same(levels(df, dims, None, {"dv": "v"}, sets), want.select(*dims, "grouping_id", "dv"))


def test_levels_copy_the_fine_rows_only(spark):
    df = spark.range(0, 10_000).selectExpr("id % 3 AS a", "id % 2 AS b", "id AS v")
    plan = levels(df, ["a", "b"], {"s": ("sum", "v")})._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and plan.index("Generate") < plan.index("sum(v")  # the copies are above the first aggregate
    empty = df.limit(0)
    assert [tuple(r) for r in levels(empty, ["a", "b"], {"n": ("count", "*"), "s": ("sum", "v")}, {"d": "v"}).collect()] == [(None, None, 3, 0, None, 0)]
    assert levels(empty, ["a"], {"n": ("count", "*")}, sets=[["a"]]).count() == 0
    with pytest.raises(ValueError):
        levels(df, ["a"], {"m": ("median", "v")})
    with pytest.raises(ValueError):
        levels(df, ["a"], {"n": ("count", "*")}, sets=[["z"]])
    with pytest.raises(ValueError):
        levels(df, ["a"])


def test_levels_deal_the_values_over_tasks_by_the_rows(spark, monkeypatch):
    from tablehaul.operators import levels as module
    monkeypatch.setattr(module, "DISTINCT_ROWS", 100)
    got = levels(spark.range(0, 4000).selectExpr("id % 3 AS a", "id % 2 AS b", "id % 900 AS v"), ["a", "b"], None, {"d": "v"}, "rollup")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count(", 40), REPARTITION_BY_NUM") == 2  # before pairs and before levels are told apart: 100 rows for each task
    assert "partial" not in plan[plan.rindex(", 40), REPARTITION_BY_NUM"):]  # no task gathers pairs before they are dealt
    assert got.where("a IS NULL AND b IS NULL").first().d == 900


@pytest.mark.parametrize("seed", [1, 2])
def test_bags_equal_multisets(spark, seed):
    rng = random.Random(seed)

    def rows(n):
        return [(rng.choice([None, 1, 2]), rng.choice([None, "x", "y"])) for _ in range(n)] + [(7, "hot")] * rng.choice([5, 2500])

    one, two = rows(60), rows(40)
    a, b = spark.createDataFrame(one, "p int, q string"), spark.createDataFrame(two, "other int, names string")
    x, y = collections.Counter(one), collections.Counter(two)
    assert collections.Counter(map(tuple, intersect_all(a, b).collect())) == x & y
    assert collections.Counter(map(tuple, except_all(a, b).collect())) == x - y
    assert intersect_all(a, b).columns == ["p", "q"] and except_all(a, a).count() == 0 and intersect_all(a.limit(0), b).count() == 0
    with pytest.raises(ValueError):
        except_all(a, b.select("other"))


@pytest.mark.parametrize("keys", [[], [1, 2], [1, None], [None], [99]])
def test_not_in_and_in_follow_sql(spark, keys):
    a = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (3, "c"), (None, "d")], "k int, s string")
    b = spark.createDataFrame([(k,) for k in keys], "k2 int")
    a.createOrReplaceTempView("bags_a")
    b.createOrReplaceTempView("bags_b")
    for got, word in ((not_in(a, b, "k", "k2"), "NOT IN"), (is_in(a, b, "k", "k2"), "IN")):
        want = spark.sql(f"SELECT * FROM bags_a WHERE k {word} (SELECT k2 FROM bags_b)")
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
        plan = got._jdf.queryExecution().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_merged_sketches_equal_one_pass_and_are_near_the_truth(spark, tmp_path):
    df = spark.range(0, 60_000).selectExpr("id % 40 AS day", "id % 3 AS region", "CAST(pow(id % 7001, 2) AS DOUBLE) AS x", "id % 5003 AS user",
                                           "CAST(id % 5003 AS STRING) AS name", "CAST(id % 9000 AS INT) AS y")
    path = str(tmp_path / "parts")
    sketch_parts(df, ["day", "region"], ["user", "name"], ["x", "y"]).write.parquet(path)
    parts = spark.read.parquet(path)
    assert parts.count() == 120
    steps = estimates(merge_parts(merge_parts(parts, ["region"]), []), at=[0.1, 0.5, 0.9]).first()
    once = estimates(merge_parts(parts, []), at=[0.1, 0.5, 0.9]).first()
    whole = estimates(sketch_parts(df, [], ["user", "name"], ["x", "y"]), at=[0.1, 0.5, 0.9]).first()
    assert steps.n_rows == once.n_rows == whole.n_rows == 60_000
    for name in ("n_distinct_user", "n_distinct_name"):
        assert abs(steps[name] - 5003) < 0.05 * 5003
        assert abs(steps[name] - whole[name]) <= 0.005 * whole[name] and abs(once[name] - whole[name]) <= 0.005 * whole[name]
    exact = sorted(r.x for r in df.select("x").collect())
    for got in (steps, once, whole):
        for q, value in zip((0.1, 0.5, 0.9), got.q_x):
            below = sum(v < value for v in exact) / len(exact)
            upto = sum(v <= value for v in exact) / len(exact)
            assert below - 0.03 <= q <= upto + 0.03
    assert all(isinstance(v, int) for v in once.q_y)


def test_sketches_of_nulls_and_of_nothing(spark):
    df = spark.createDataFrame([("a", None, None), ("a", None, float("nan")), ("b", "x", 1.0), ("b", "x", None)], "k string, s string, x double")
    got = {r.k: r for r in estimates(merge_parts(sketch_parts(df, ["k"], ["s"], ["x"]), ["k"])).collect()}
    assert (got["a"].n_distinct_s, got["a"].q_x, got["a"].n_rows) == (0, None, 2)
    assert (got["b"].n_distinct_s, got["b"].q_x) == (1, [1.0])
    assert sketch_parts(df.limit(0), ["k"], ["s"], ["x"]).count() == 0
    with pytest.raises(ValueError):
        sketch_parts(df, ["k"], quantiles=["s"])
