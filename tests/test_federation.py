"""One SQL statement over two sources."""

from tablehaul.plans.federate import federated_sql

TOWNS = [(1, "north", 10.0), (2, "south", None), (3, "north", 2.5), (4, None, 1.0)]
VISITS = [(1, 3), (1, 4), (2, 5), (3, 1), (9, 7)]


def towns_and_visits(spark):
    return (spark.createDataFrame(TOWNS, "town int, side string, area double"),
            spark.createDataFrame(VISITS, "place int, guests int"))


def test_group_over_two_sources(spark, tmp_path):
    towns, visits = towns_and_visits(spark)
    towns.write.parquet(str(tmp_path / "a" / "towns.parquet"))
    visits.write.parquet(str(tmp_path / "b" / "visits.parquet"))
    sql = ("SELECT side, SUM(guests) AS guests, AVG(area) AS area FROM left_db.towns "
           "JOIN right_db.visits ON town = place GROUP BY side ORDER BY guests")
    rows = federated_sql(spark, {"left_db": str(tmp_path / "a"), "right_db": str(tmp_path / "b")}, sql).collect()
    assert [tuple(r) for r in rows] == [("south", 5, None), ("north", 8, 7.5)]


def test_an_earlier_frame_survives_a_new_registration(spark, tmp_path):
    towns, visits = towns_and_visits(spark)
    towns.write.parquet(str(tmp_path / "a" / "towns.parquet"))
    visits.write.parquet(str(tmp_path / "b" / "towns.parquet"))
    earlier = federated_sql(spark, {"th_same_name": str(tmp_path / "a")}, "SELECT * FROM th_same_name.towns")
    later = federated_sql(spark, {"th_same_name": str(tmp_path / "b")}, "SELECT * FROM th_same_name.towns")
    assert (earlier.count(), later.count()) == (4, 5)


def test_equi_join_runs_nothing_while_planning(spark, sf_dir):
    from tablehaul.operators.join import equi_join
    n = spark.read.parquet(f"{sf_dir}/nation.parquet")
    r = spark.read.parquet(f"{sf_dir}/region.parquet")
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup())
    j = equi_join(n, r.hint("merge"), n.n_regionkey == r.r_regionkey)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup()) == before
    assert "SortMergeJoin" in j._jdf.queryExecution().executedPlan().toString()
    known = equi_join(n, r, n.n_regionkey == r.r_regionkey, broadcast_right=True)
    assert "BroadcastHashJoin" in known._jdf.queryExecution().executedPlan().toString()
    assert j.count() == known.count() == 25


def test_foreign_database_is_never_replaced(spark, sf_dir):
    import pytest

    from tablehaul.plans.federate import register_source
    spark.sql("CREATE DATABASE IF NOT EXISTS th_users_own_db")
    with pytest.raises(ValueError):
        register_source(spark, "th_users_own_db", sf_dir)
    assert spark.catalog.databaseExists("th_users_own_db")
    register_source(spark, "th_fed_src", sf_dir)
    register_source(spark, "th_fed_src", sf_dir)  # its own database is replaced
    assert spark.table("th_fed_src.region").count() == 5
