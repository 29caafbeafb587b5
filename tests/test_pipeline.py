"""The census job end to end: order of stages, idempotence, plan shape."""

from tablehaul.operators.census import complex_filter, simple_filter
from tablehaul.plans.census import CensusConfig, census_expand_plan, run_census
from tablehaul.plans.census_source import census_like
from tablehaul.plans.spja import spja_three_way
from tablehaul.sources.sql import CatalogSource


def test_run_twice_second_run_writes_nothing(spark, sf_dir, tmp_path):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    src_csv = str(tmp_path / "source.csv")
    census_like(orders).write.csv(src_csv, header=True)
    target = CatalogSource("th_pipe_test", {"census": str(tmp_path / "tables" / "census")})
    cfg = CensusConfig(raw_dir=str(tmp_path / "raw"), expanded_dir=str(tmp_path / "large"),
                       source_path=src_csv, target=target, table="census",
                       publish_path=str(tmp_path / "bucket" / "large" / "census.parquet"))
    first = run_census(spark, cfg)
    assert first.loaded and first.published
    n = orders.count()
    assert first.expanded.count() == 100 * n
    assert spark.table("th_pipe_test.census").count() == 100 * n
    expected_simple = simple_filter(census_expand_plan(census_like(orders))).count()
    assert first.simple.count() == expected_simple
    assert first.complex.count() == complex_filter(census_expand_plan(census_like(orders))).count()
    second = run_census(spark, cfg)
    assert not second.loaded and not second.published
    assert second.simple.count() == expected_simple
    # the read-back subset pushes its filter into the table scan
    plan = second.readback._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "EqualTo(region,E12000007)" in plan
    etl = run_census(spark, CensusConfig(**{**cfg.__dict__, "etl_only": True}))
    assert etl.simple is None and not etl.loaded


def test_spja_filters_reach_scans(spark, sf_dir):
    t = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("customer", "orders", "lineitem")}
    q = spja_three_way(t["customer"], t["orders"], t["lineitem"], priority_col="o_orderpriority")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(c_mktsegment,BUILDING)" in plan
    assert "LessThan(o_orderdate" in plan and "GreaterThan(l_shipdate" in plan
    assert q.count() > 0


def pages(page, df, order_by, n):
    out, offset = [], 0
    while True:
        rows = page(df, order_by, offset, n).collect()
        if not rows:
            return out
        out += rows
        offset += n


def test_pages_neither_repeat_nor_lose_rows(spark):
    from tablehaul.operators.rows import page
    df = spark.range(0, 900).selectExpr("id % 7 AS k", "id DIV 3 AS v").repartition(5)  # ties, and equal rows
    rows = pages(page, df, "k", 250)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, df.collect()))
    assert [r.k for r in rows] == sorted(r.k for r in df.collect())


def test_keyset_pages_push_the_key(spark, tmp_path):
    from tablehaul.operators.rows import page
    spark.range(0, 1000).selectExpr("id % 10 AS a", "id AS b", "id * 2 AS c").write.parquet(str(tmp_path / "t"))
    df, got, after = spark.read.parquet(str(tmp_path / "t")), [], None
    while rows := page(df, ["a", "b"], n=130, after=after).collect():
        got += [(r.a, r.b) for r in rows]
        after = got[-1]
    assert got == sorted((i % 10, i) for i in range(1000))
    plan = page(df, ["a", "b"], n=5, after=(3, 500))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(a,3)" in plan


def test_page_runs_nothing_before_an_action(spark):
    from tablehaul.operators.rows import page
    spark.sparkContext.setJobGroup("paging", "paging")
    page(spark.range(0, 100_000), "id", 50_000, 10)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("paging")
    spark.sparkContext.setJobGroup("none", "none")


def test_limit_then_partition_keeps_negative_fractions(spark):
    import pytest

    from tablehaul.operators.rows import limit_then_partition
    df = spark.createDataFrame([(-1.5,), (0.2,), (3.9,), (None,), (float("nan"),)], "x double")
    got = {r.x: r.part for r in limit_then_partition(df, 10, "x", "x", 2).collect()}
    assert got == {-1.5: 0, 0.2: 0, 3.9: 1}
    with pytest.raises(ValueError):
        limit_then_partition(df, 10, None, "x", 2)
    with pytest.raises(ValueError):
        limit_then_partition(spark.createDataFrame([("a",)], "x string"), 10, "x", "x", 2)


def test_census_expand_notices_other_parameters_and_a_missing_csv(spark, sf_dir, tmp_path):
    import shutil

    from tablehaul.plans.census import census_expand
    raw = census_like(spark.read.parquet(f"{sf_dir}/orders.parquet")).limit(40)
    n = raw.count()
    paths = {"parquet_path": str(tmp_path / "p"), "csv_path": str(tmp_path / "c")}
    assert census_expand(raw, times=2, parquet_path=paths["parquet_path"]).count() == 2 * n
    assert census_expand(raw, times=2, **paths).count() == 2 * n
    assert spark.read.csv(paths["csv_path"], header=True).count() == 2 * n  # made although the parquet was there
    assert census_expand(raw, times=5, **paths).count() == 5 * n
    assert spark.read.csv(paths["csv_path"], header=True).count() == 5 * n
    before = {r.income for r in census_expand(raw, times=5, **paths).collect()}
    assert {r.income for r in census_expand(raw, times=5, seed=3, **paths).collect()} != before
    shutil.rmtree(paths["csv_path"])
    census_expand(raw, times=5, seed=3, **paths)
    assert spark.read.csv(paths["csv_path"], header=True).count() == 5 * n


def test_a_catalog_target_shares_the_expanded_files(spark, sf_dir, tmp_path):
    from tablehaul.plans.census import CensusConfig, run_census
    from tablehaul.sources.sql import CatalogSource
    raw = census_like(spark.read.parquet(f"{sf_dir}/orders.parquet")).limit(30)
    cfg = CensusConfig(raw_dir=str(tmp_path / "raw"), expanded_dir=str(tmp_path / "large"), target=CatalogSource("th_shared_target", {}),
                       publish_path=str(tmp_path / "published"), times=3, write_csv=False)
    first = run_census(spark, cfg, raw)
    assert first.loaded and spark.table("th_shared_target.census").count() == 90
    assert sorted(spark.table("th_shared_target.census").inputFiles()) == sorted(first.expanded.inputFiles())
    again = run_census(spark, cfg, raw)
    assert not again.loaded and not again.published


def test_the_expanded_table_is_dealt_out_and_its_csv_packed(spark, tmp_path, monkeypatch):
    import glob
    import os

    from tablehaul.plans import census
    orders = spark.range(1, 1001).selectExpr("id AS o_orderkey", "id % 97 AS o_custkey").coalesce(1)
    monkeypatch.setattr(census, "TASK_ROWS", 4000)
    got = census.census_expand(census_like(orders), parquet_path=str(tmp_path / "p"), csv_path=str(tmp_path / "c"))
    files = glob.glob(str(tmp_path / "p" / "*.parquet"))
    assert len(files) == 25  # the raw table is one partition
    packed = glob.glob(str(tmp_path / "c" / "*.csv*"))
    assert packed and all(f.endswith(".csv.gz") for f in packed)
    assert sum(map(os.path.getsize, packed)) < 1000 * 100 * 63 / 20
    back = spark.read.csv(str(tmp_path / "c"), header=True, schema=got.schema)
    assert got.count() == 100_000 and back.exceptAll(got).count() == 0 and got.exceptAll(back).count() == 0


def test_the_census_job_encodes_the_copies_once(spark, tmp_path, monkeypatch):
    import os

    from tablehaul.plans import census
    orders = spark.range(1, 501).selectExpr("id AS o_orderkey", "id % 97 AS o_custkey")
    raw = census_like(orders)
    made = {}
    sink = census.csv_sink
    monkeypatch.setattr(census, "csv_sink", lambda df, path, **kw: (made.update(rows=df.count(), **kw), sink(df, path, **kw))[1])
    cfg = CensusConfig(raw_dir=str(tmp_path / "raw"), expanded_dir=str(tmp_path / "large"), target=CatalogSource("th_once_target", {}),
                       publish_path=str(tmp_path / "published"))
    got = run_census(spark, cfg, raw)
    assert made["rows"] == 500 and made["times"] == 100  # each line is made once
    data = [{open(f"{p}/{f}", "rb").read() for f in os.listdir(p) if f.endswith(".parquet")}
            for p in (str(tmp_path / "published"), str(tmp_path / "large" / "census.parquet"))]
    assert data[0] == data[1] and data[0]  # the published files are copies
    want = census_expand_plan(raw)
    csv = spark.read.csv(str(tmp_path / "large" / "census.csv"), header=True, schema=want.schema)
    for df in (got.expanded, got.frames["published"], csv):
        assert df.count() == 50_000 and df.exceptAll(want).count() == want.exceptAll(df).count() == 0


def test_parquet_and_csv_agree_whatever_the_raw_rows_are(spark, tmp_path):
    import random

    from pyspark.sql import functions as F

    from tablehaul.plans.census import census_expand
    raw = census_like(spark.range(1, 301).selectExpr("id AS o_orderkey", "id % 97 AS o_custkey"))
    draw = F.udf(lambda: random.getrandbits(40), "long").asNondeterministic()
    raw = raw.withColumn("resident_id_m", draw())  # another one whenever the plan runs
    got = census_expand(raw, times=3, parquet_path=str(tmp_path / "p"), csv_path=str(tmp_path / "c"))
    csv = spark.read.csv(str(tmp_path / "c"), header=True, schema=got.schema)
    assert got.count() > 0 and csv.exceptAll(got).count() == got.exceptAll(csv).count() == 0
