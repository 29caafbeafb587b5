"""File sources, SQL sources, generator, sinks and idempotence."""

import os

import pytest
from pyspark.sql import types as T

from tablehaul.sinks import (bulk_sink, ddl_types, load_if_incomplete, publish_if_absent,
                             table_count)
from tablehaul.sources.files import csv_infer, csv_multi_scan, csv_scan
from tablehaul.sources.generator import row_generator
from tablehaul.sources.sql import CatalogSource, check_identifier, read_sql
from tablehaul.streaming import arrow_batches, decode_batches, iter_arrow_batches

DATA = os.path.join(os.path.dirname(__file__), "data")


def test_csv_infer_golden(spark):
    s = csv_infer(spark, f"{DATA}/infer_0.csv")
    got = [(f.name, f.dataType.simpleString(), f.nullable) for f in s.fields]
    assert got == [("c0", "bigint", False), ("c1", "double", False), ("c2", "boolean", True),
                   ("c3", "string", True), ("c4", "double", False), ("c5", "string", True),
                   ("c6", "string", False), ("c7", "string", True)]


def test_csv_multi_scan_two_files(spark):
    df = csv_multi_scan(spark, [f"{DATA}/uint_0.csv", f"{DATA}/uint_1.csv"])
    rows = sorted(tuple(r) for r in df.collect())
    assert len(rows) == 11
    assert rows == [tuple(5 * r + c for c in range(1, 6)) for r in range(11)]
    assert all(isinstance(f.dataType, T.LongType) for f in df.schema.fields)


def test_csv_multi_scan_empty_string_cells(spark):
    df = csv_multi_scan(spark, [f"{DATA}/infer_0.csv"])
    r = {row.c0: row for row in df.collect()}
    assert r[2].c3 == "" and r[1].c2 is None and r[2].c7 == ""


def test_csv_scan_infers_and_missing_path_fails(spark, tmp_path):
    df = csv_scan(spark, f"{DATA}/uint_0.csv")
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["bigint"] * 5
    assert df.count() == 4
    with pytest.raises(Exception):
        csv_scan(spark, str(tmp_path / "missing.csv"))


def test_row_generator_parts(spark):
    df = row_generator(spark, [4, 7], "a long, b double, c boolean not null, d string, e double")
    rows = df.collect()
    assert [r.a for r in rows] == list(range(4)) + list(range(7))
    assert all(r.c == (r.a % 2 == 0) and r.d == str(r.a) and r.b == float(r.a) for r in rows)


def _catalog(spark, tmp_path):
    from tests.test_partition import TEST_TABLE, TT_SCHEMA
    path = str(tmp_path / "test_table")
    spark.createDataFrame(TEST_TABLE, TT_SCHEMA).write.parquet(path)
    return CatalogSource("th_test_src", {"test_table": path}).attach(spark)


def test_read_sql_variants(spark, tmp_path):
    src = _catalog(spark, tmp_path)
    assert read_sql(spark, src, "SELECT * FROM test_table").count() == 6
    parts = read_sql(spark, src, ["SELECT * FROM test_table WHERE test_int < 2",
                                  "SELECT * FROM test_table WHERE test_int >= 2"])
    assert parts.count() == 6
    by_range = read_sql(spark, src, "SELECT * FROM test_table", partition_on="test_nullint",
                        partition_num=2)
    assert by_range.count() == 5  # the NULL row is not read
    kept = read_sql(spark, src, "SELECT * FROM test_table", partition_on="test_nullint",
                    partition_num=2, keep_nulls=True)
    assert kept.count() == 6
    given = read_sql(spark, src, "SELECT * FROM test_table", partition_on="test_int",
                     partition_range=(0, 3), partition_num=2)
    assert sorted(r.test_int for r in given.collect()) == [0, 1, 2, 3]
    meta = read_sql(spark, src, "SELECT test_int, test_str FROM test_table", schema_only=True)
    assert meta.columns == ["test_int", "test_str"] and meta.count() == 0
    with pytest.raises(ValueError):
        read_sql(spark, src, "SELECT * FROM test_table", partition_on="test_int",
                 partition_num=0)
    with pytest.raises(ValueError):
        read_sql(spark, src, "SELECT * FROM test_table", partition_on="test_str",
                 partition_num=2)
    with pytest.raises(ValueError):
        read_sql(spark, src, "SELECT * FROM test_table", partition_on="test_int",
                 partition_range=(0, None), partition_num=2)


def test_group_sum_golden(spark, tmp_path):
    src = _catalog(spark, tmp_path)
    got = {r[0]: round(r[1], 6) for r in read_sql(
        spark, src, "SELECT test_bool, SUM(test_float) FROM test_table GROUP BY test_bool").collect()}
    assert got == {None: 10.9, False: 5.2, True: -10.0}


def test_identifiers():
    with pytest.raises(ValueError):
        check_identifier("census; DROP TABLE x")
    assert check_identifier("db.census_2021") == "db.census_2021"


def test_ddl_types():
    s = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.LongType()),
                      T.StructField("c", T.DoubleType()), T.StructField("d", T.DateType())])
    assert ddl_types(s) == {"a": "INTEGER", "b": "BIGINT", "c": "DOUBLE PRECISION", "d": "TEXT"}


def test_publish_if_absent_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "pub")
    df = spark.range(10)
    assert publish_if_absent(df, path) is True
    assert publish_if_absent(spark.range(3), path) is False
    assert spark.read.parquet(path).count() == 10
    assert publish_if_absent(spark.range(3), path, replace=True) is True
    assert spark.read.parquet(path).count() == 3


def test_load_if_incomplete(spark, tmp_path):
    target = CatalogSource("th_test_target", {"t": str(tmp_path / "t")}).attach(spark)
    df = spark.range(100).selectExpr("id", "date_from_unix_date(CAST(id AS INT)) AS flag",
                                     "CAST(id AS INT) AS i")
    assert table_count(spark, target, "t") == 0
    assert load_if_incomplete(df, target, "t", 100) is True
    assert load_if_incomplete(df, target, "t", 100) is False
    loaded = spark.table("th_test_target.t")
    assert loaded.count() == 100
    assert dict((f.name, f.dataType.simpleString()) for f in loaded.schema.fields) == {
        "id": "bigint", "flag": "string", "i": "int"}
    assert load_if_incomplete(df, target, "t", 150) is True  # short table reloads, no duplicates
    assert spark.table("th_test_target.t").count() == 100
    bulk_sink(df, target, "t")  # append
    assert spark.table("th_test_target.t").count() == 200
    assert load_if_incomplete(df, target, "t", 100) is True  # a table loaded twice is not complete
    assert spark.table("th_test_target.t").count() == 100


def test_arrow_batches(spark):
    df = spark.range(0, 25, numPartitions=1)
    assert sorted(r.n_rows for r in arrow_batches(df, 10).collect()) == [5, 10, 10]
    assert decode_batches(arrow_batches(df, 10), df.schema).count() == 25
    sizes = [b.num_rows for b in iter_arrow_batches(df, 10)]
    assert sizes == [10, 10, 5]


def test_parquet_sink_bounds_file_size(spark, tmp_path):
    import glob

    from tablehaul.sinks import parquet_sink
    path = str(tmp_path / "bounded")
    parquet_sink(spark.range(0, 1000, numPartitions=1), path, max_records_per_file=300)
    assert len(glob.glob(f"{path}/*.parquet")) == 4
    assert spark.read.parquet(path).count() == 1000


def test_arrow_batches_mixed_types(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    batches = list(iter_arrow_batches(df, 2500))
    assert [b.num_rows for b in batches[:-1]] == [2500] * (len(batches) - 1)
    assert sum(b.num_rows for b in batches) == df.count()
    assert str(batches[0].schema.field("l_shipdate").type) == "timestamp[us]"
    assert decode_batches(arrow_batches(df, 1000), df.schema).exceptAll(df).count() == 0


def test_half_written_folder_is_landed_anew(spark, tmp_path):
    from tablehaul.sources.files import land_raw
    source, raw = str(tmp_path / "src"), tmp_path / "raw"
    spark.range(50).selectExpr("id", "id * 2 AS x").write.csv(source, header=True)
    (raw / "census.csv" / "_temporary").mkdir(parents=True)
    (raw / "census.csv" / "part-00000.csv").write_text("id,x\n0,0\n")
    assert land_raw(spark, source, str(raw)).count() == 50
    plain = tmp_path / "plain"
    plain.mkdir()
    (plain / "census.csv").write_text("id,x\n1,2\n3,4\n")
    assert land_raw(spark, source, str(plain)).count() == 2  # a plain file counts as landed


def test_types_come_from_all_rows_and_columns_from_headers(spark, tmp_path):
    late = tmp_path / "late.csv"
    late.write_text("n,m\n" + "".join(f"{i},{i}\n" for i in range(10_000)) + "1.5,x\n")
    df = csv_scan(spark, str(late))
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["double", "string"]
    assert df.count() == 10_001 and df.where("n = 1.5").count() == 1
    (tmp_path / "ab.csv").write_text("a,b\n1,x\n")
    (tmp_path / "ba.csv").write_text("b,a\ny,2\n")
    (tmp_path / "ac.csv").write_text("a,c\n1,x\n")
    both = csv_multi_scan(spark, [str(tmp_path / "ab.csv"), str(tmp_path / "ba.csv")])
    assert sorted(map(tuple, both.collect())) == [(1, "x"), (2, "y")]
    with pytest.raises(ValueError):
        csv_multi_scan(spark, [str(tmp_path / "ab.csv"), str(tmp_path / "ac.csv")])
    folder = tmp_path / "folder"
    folder.mkdir()
    (folder / "1.csv").write_text("a,b\n1,x\n")
    (folder / "2.csv").write_text("b,a\ny,2\n")
    mixed = csv_scan(spark, str(folder))  # within one folder, too
    assert mixed.columns == ["a", "b"] and sorted(map(tuple, mixed.collect())) == [(1, "x"), (2, "y")]


def test_headers_of_many_files_take_no_job_each(spark, tmp_path):
    import gzip
    folder = tmp_path / "many files"
    folder.mkdir()
    for i in range(300):
        (folder / f"{i}.csv").write_text(f"n,m\n{i},{-i}\n" if i % 3 else f"m,n\n{-i},{i}\n")
    (folder / "empty.csv").write_text("")
    (folder / "zipped.csv.gz").write_bytes(gzip.compress(b"m,n\n-1000,1000\n"))
    (folder / "_hidden.csv").write_text("not,read\n1,2\n")
    spark.sparkContext.setJobGroup("headers", "headers")
    df = csv_scan(spark, str(folder), schema="n long, m long")
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("headers"))
    spark.sparkContext.setJobGroup("none", "none")
    assert jobs <= 4  # listing the files, at most
    assert sorted(r.n for r in df.collect()) == [*range(300), 1000] and df.where("n <> -m").count() == 0
    (folder / "quoted.csv").write_text('"two\nlines","say ""m"""\n1,2\n')
    from tablehaul.sources.files import _header
    assert _header(spark, (folder / "quoted.csv").as_uri()) == ("two\nlines", 'say "m"')
    assert _header(spark, (folder / "empty.csv").as_uri()) == ()


def test_landing_reads_the_source_once(spark, tmp_path):
    from tablehaul.sources.files import land_raw
    source = tmp_path / "source.csv"
    source.write_text("n,x,s,t,e\n1,1.50,a,2024-01-01T00:00:00,\n-2,2,,2024-01-02T00:00:00,\n")
    landed = land_raw(spark, str(source), str(tmp_path / "raw"), preview=1)
    assert [(f.name, f.dataType.simpleString()) for f in landed.schema.fields] == [
        ("n", "bigint"), ("x", "double"), ("s", "string"), ("t", "string"), ("e", "string")]
    assert sorted(map(tuple, landed.collect())) == [(-2, 2.0, None, "2024-01-02T00:00:00", None), (1, 1.5, "a", "2024-01-01T00:00:00", None)]
    kept = [line for f in (tmp_path / "raw" / "census.csv").glob("part*") for line in f.read_text().split("\n")]
    assert any(line.startswith("1,1.50,a") for line in kept)  # cells as they came
    source.write_text("n,x,s,t,e\n")
    assert land_raw(spark, str(source), str(tmp_path / "raw"), preview=0).count() == 2  # landed before: not read again


def test_partitioned_read_puts_each_part_in_one_task(spark, tmp_path):
    from pyspark.sql import functions as F
    path = str(tmp_path / "t")
    spark.range(0, 1000, numPartitions=7).selectExpr("IF(id % 10 = 0, NULL, id) AS k", "id AS v").write.parquet(path)
    src = CatalogSource("th_parts_src", {"t": path})
    for n in (1, 8):
        df = read_sql(spark, src, "SELECT * FROM t", partition_on="k", partition_num=n, keep_nulls=True, part_col="part", deal=True)
        placed = df.withColumn("task", F.spark_partition_id())
        assert df.rdd.getNumPartitions() == n + 1
        assert placed.where("task <> part").count() == 0 and placed.count() == 1000
        assert placed.where("part = %d AND k IS NOT NULL" % n).count() == 0
        labelled = read_sql(spark, src, "SELECT * FROM t", partition_on="k", partition_num=n, keep_nulls=True, part_col="part")
        assert "Exchange" not in labelled._jdf.queryExecution().toString()  # the label alone moves no row
        assert sorted(map(tuple, labelled.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    assert read_sql(spark, src, "SELECT * FROM t", partition_on="k", partition_num=8).columns == ["k", "v"]


def test_a_moved_source_is_read_from_its_new_place(spark, tmp_path):
    for name, n in (("a", 3), ("b", 5)):
        spark.range(n).write.parquet(str(tmp_path / name / "t"))
        assert CatalogSource("th_moved_src", {"t": str(tmp_path / name / "t")}).table(spark, "t").count() == n


def files_of(folder):
    return sorted(os.path.join(folder, f) for f in os.listdir(folder) if not f.startswith(("_", ".")))


def test_publishing_finished_files_copies_their_bytes(spark, tmp_path):
    source, path = str(tmp_path / "made"), str(tmp_path / "published")
    spark.range(1000).selectExpr("id", "IF(id % 7 = 0, NULL, 'é' || id) AS t").repartition(6).write.parquet(source)
    df = spark.read.parquet(source)
    os.makedirs(path)  # what a publish that broke off left there
    open(os.path.join(path, "part-00000-old.parquet"), "w").close()
    assert publish_if_absent(df, path, files=source) is True
    assert sorted(open(f, "rb").read() for f in files_of(path)) == sorted(open(f, "rb").read() for f in files_of(source))
    assert len(files_of(path)) == 6 and all(f.endswith(".parquet") for f in files_of(path))
    assert os.path.exists(os.path.join(path, "_SUCCESS")) and not os.path.exists(os.path.join(path, "_staged"))
    assert spark.read.parquet(path).exceptAll(df).count() == 0
    assert publish_if_absent(spark.range(3), path, files=source) is False
    assert publish_if_absent(df, path, replace=True, files=source) is True
    assert spark.read.parquet(path).count() == 1000


def test_publishing_falls_back_to_rows(spark, tmp_path, monkeypatch):
    from tablehaul.sinks import core
    source = str(tmp_path / "made")
    spark.range(1000).repartition(3).write.parquet(source)
    df = spark.read.parquet(source)
    monkeypatch.setattr(core, "COPY_FILE_BYTES", 100)  # files too large to be held by a task
    assert publish_if_absent(df, str(tmp_path / "large"), files=source) is True
    monkeypatch.undo()
    os.remove(os.path.join(source, "_SUCCESS"))  # not finished
    assert publish_if_absent(df, str(tmp_path / "unfinished"), files=source) is True
    assert spark.read.parquet(str(tmp_path / "large")).count() == spark.read.parquet(str(tmp_path / "unfinished")).count() == 1000
    open(os.path.join(source, "_SUCCESS"), "w").close()
    with pytest.raises(ValueError):
        publish_if_absent(df, source, replace=True, files=source)  # onto itself
    assert spark.read.parquet(source).count() == 1000


@pytest.mark.parametrize("times", [2, 3, 2500])
def test_repeated_csv_lines_are_those_of_replicated_rows(spark, tmp_path, times):
    from tablehaul.operators.setops import replicate
    from tablehaul.sinks import csv_sink
    rows = [(i, t, None if i % 3 else i / 4) for i, t in enumerate([None, "", " a ", "a,b", 'say "x"', "two\nlines", "#", "\\", "é", "-"])]
    df = spark.createDataFrame(rows, "`id` long, `a, \"b\"` string, `x``y` double").coalesce(1)
    csv_sink(replicate(df, times), str(tmp_path / "plain"))
    csv_sink(df, str(tmp_path / "fast"), times=times)
    plain, fast = ([open(f, "rb").read() for f in files_of(str(tmp_path / p))] for p in ("plain", "fast"))
    assert plain == fast and len(fast) == 1
    # several files, packed: a header in each, no more than so many records in one
    csv_sink(df.repartition(2), str(tmp_path / "cut"), compression="gzip", max_records_per_file=2 * times, times=times)
    files = files_of(str(tmp_path / "cut"))
    assert len(files) >= 5 and all(f.endswith(".csv.gz") for f in files)
    read = spark.read.schema("id long, t string, x double")
    assert all(0 < read.csv(f, header=True, multiLine=True).count() <= 2 * times for f in files)
    got = read.csv(str(tmp_path / "cut"), header=True, multiLine=True)
    want = read.csv(str(tmp_path / "plain"), header=True, multiLine=True)
    assert got.count() == len(rows) * times and got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_repeated_csv_of_no_rows_has_a_header(spark, tmp_path):
    from tablehaul.sinks import csv_sink
    csv_sink(spark.createDataFrame([], "a long, b string"), str(tmp_path / "none"), times=100)
    assert spark.read.csv(str(tmp_path / "none"), header=True).columns == ["a", "b"]


def test_each_cell_is_tried_until_a_pattern_fits(spark, tmp_path):
    from tablehaul.sources.files import _facts
    (tmp_path / "t.csv").write_text("a,b,c,d,e,f\n1,1,true,2020-01-01T00:00:00,,x\n-2,2.5,FALSE,,,1\n,3,true,2020-01-01T00:00:01,,true\n")
    s = csv_infer(spark, str(tmp_path / "t.csv"))
    assert [(f.dataType.simpleString(), f.nullable) for f in s.fields] == [
        ("bigint", True), ("double", False), ("boolean", False), ("timestamp", True), ("string", True), ("string", False)]
    df = spark.createDataFrame([("1", "x")], "a string, b string")
    assert len(_facts(df)) == 2  # one aggregate a column
