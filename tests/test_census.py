"""Census operators on the hand-made rows of FIXTURES §1."""

from pyspark.sql import functions as F

from tablehaul.operators import census as C
from tablehaul.operators.setops import replicate, union_parts

# id, econ, region, age_group, keep_type, income before blanking
ROWS = [
    (1, 1, "E12000007", 5, 1, 50000),
    (2, 5, "E12000007", 5, 1, 50000),
    (3, None, "E12000007", 5, 1, 50000),
    (4, 1, "E12000007", 5, 2, 50000),
    (5, -8, "E12000001", 6, 1, 50000),
    (6, 1, "E12000001", 5, 1, 50000),
    (7, 1, "E12000002", 6, 1, 50000),
    (8, 1, "E12000002", 7, 1, 50000),
    (9, 1, None, 6, 1, 50000),
]
SCHEMA = "id long, econ long, region string, age_group long, keep_type long, income long"


def frame(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_blank_by_code_keeps_null_code(spark):
    out = dict(C.blank_by_code(frame(spark)).select("id", "income").collect())
    assert out[2] is None and out[5] is None
    assert out[3] == 50000 and out[1] == 50000


def test_simple_filter(spark):
    ids = {r.id for r in C.simple_filter(C.blank_by_code(frame(spark))).collect()}
    assert ids == {1, 3}


def test_complex_filter_includes_six_on_both_sides(spark):
    ids = {r.id for r in C.complex_filter(C.blank_by_code(frame(spark))).collect()}
    assert ids == {5, 7}


def test_census_project_names(spark):
    raw_cols = [raw for raw, _ in C.CENSUS_COLUMNS]
    df = spark.createDataFrame([tuple(range(19))], ", ".join(f"{c} long" for c in raw_cols))
    out = C.census_project(df)
    assert out.columns == [short for _, short in C.CENSUS_COLUMNS]
    assert len(out.columns) == 19


def test_random_int_range_and_determinism(spark):
    df = spark.range(20000).withColumnRenamed("id", "key")
    for method in ("md5", "xxhash64"):
        a = df.select("key", C.random_int("key", 75, 125, 1949, "weight", method).alias("w"))
        stats = a.agg(F.min("w"), F.max("w"), F.avg("w"), F.countDistinct("w")).first()
        assert stats[0] == 75 and stats[1] == 125 and stats[3] == 51
        assert abs(stats[2] - 100) < 1.0
        # independent of partitioning
        b = df.repartition(7).select("key", C.random_int("key", 75, 125, 1949, "weight",
                                                         method).alias("w"))
        assert a.exceptAll(b).count() == 0


def test_random_int_draws_differ_by_name_and_seed(spark):
    df = spark.range(1000)
    a = df.select(C.random_int("id", 0, 10**9, 1949, "income").alias("v"))
    b = df.select(C.random_int("id", 0, 10**9, 1949, "weight").alias("v"))
    c = df.select(C.random_int("id", 0, 10**9, 7, "income").alias("v"))
    assert a.exceptAll(b).count() > 990 and a.exceptAll(c).count() > 990


def test_replicate_counts_and_plan(spark):
    df = frame(spark)
    rep = replicate(df, 100)
    assert rep.count() == 900
    assert rep.groupBy("id").count().where("count != 100").count() == 0
    plan = rep._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in plan and "Exchange" not in plan and "Union" not in plan
    assert replicate(df, 1).count() == 9 and replicate(df, 0).count() == 0


def test_union_parts(spark):
    df = frame(spark)
    assert union_parts([df, df, df]).count() == 27


def test_filter_pushed_below_replicate(spark, tmp_path):
    path = str(tmp_path / "census")
    C.add_census_measures(frame(spark)).write.parquet(path)
    q = C.simple_filter(replicate(spark.read.parquet(path), 100))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(keep_type), IsNotNull(region), IsNotNull(age_group)" in plan
    assert q.count() == 200


def test_building_plans_runs_no_job(spark, sf_dir):
    from tablehaul.functions.normalize import normalize_table
    from tablehaul.plans.census import census_expand_plan
    from tablehaul.plans.census_source import census_like
    sc = spark.sparkContext
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    sc.setJobGroup("th_build_only", "plan construction")
    try:
        census_expand_plan(census_like(orders))
        normalize_table(orders.join(orders.select("o_orderkey"), "o_orderkey"), "postgres")
        assert sc.statusTracker().getJobIdsForGroup("th_build_only") == []
    finally:
        sc.setJobGroup(None, None)
