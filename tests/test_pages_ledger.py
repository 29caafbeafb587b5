"""The page index and the ledger of loads."""

import random
import threading

import pytest
from pyspark.sql import functions as F

from tablehaul.operators.pages import PageIndex
from tablehaul.sinks import LedgerTable
from tablehaul.sources.fs import list_names, write_new


@pytest.fixture(scope="module")
def shop(spark, tmp_path_factory):
    rng = random.Random(1)
    rows = [(rng.choice([None, 1, 2, 2, 2, 5]), rng.choice(["x", "y", None]), i % 50, {"m": i % 2}) for i in range(1500)]
    rows += [(2, "same", 7, {"m": 1})] * 1500  # half of the table is one row
    df = spark.createDataFrame(rows, "a int, b string, c int, extra map<string, int>").repartition(6)
    return rows, PageIndex.build(df, ["a", "b"], str(tmp_path_factory.mktemp("index")), range_rows=200)


def by_order(rows):
    def least(v):
        return (v is not None, v if v is not None else 0)
    return sorted(rows, key=lambda r: (least(r[0]), (r[1] is not None, r[1] or ""), least(r[2])))


@pytest.mark.parametrize("offset, n", [(0, 10), (195, 10), (1490, 777), (2990, 10), (2999, 5), (3000, 5), (10**9, 3), (5, 0)])
def test_any_page(shop, offset, n):
    rows, index = shop
    want = by_order(rows)[offset:offset + n]
    got = index.page(offset, n, number="row_no").collect()
    assert [r.row_no for r in got] == list(range(offset, offset + len(want)))
    assert [(r.a, r.b, r.c) for r in got] == [w[:3] for w in want]
    assert index.page(offset, n).columns == ["a", "b", "c", "extra"]


def test_every_row_is_on_one_page_and_ranges_are_even(shop):
    rows, index = shop
    assert index.count() == len(rows)
    sizes = [r.n for r in index.fences().collect()]
    assert len(sizes) == 15 and max(sizes) < 450  # the row that is half of the table is cut, too
    got = [tuple(r) for p in range(0, 3000, 700) for r in index.page(p, 700).collect()]
    assert sorted(got, key=str) == sorted(rows, key=str)


def test_a_deep_page_reads_no_more_than_the_first(shop):
    _, index = shop
    first, deep = index.page(0, 50), index.page(2900, 50)
    assert len(first.inputFiles()) <= 2 and len(deep.inputFiles()) <= 2
    assert "_place" in deep._jdf.queryExecution().toString().split("PushedFilters")[-1]


@pytest.mark.parametrize("n", [0, 1, 199, 200, 1234, 3000, 5000])
def test_first_rows(shop, n):
    rows, index = shop
    assert sorted([(r.a, r.b, r.c) for r in index.first(n).collect()], key=str) == sorted([r[:3] for r in by_order(rows)[:n]], key=str)


def test_seek_and_open(spark, shop):
    rows, index = shop
    again = PageIndex.open(spark, index.path)
    for key in [(2, "x"), (2, "same"), (5, "y"), (9, ""), (None, None), (1, None)]:
        want = sum(by_order([r, (*key, None)])[0] is r and r[:2] != key for r in rows)
        assert again.seek(key) == want, key
    with pytest.raises(ValueError):
        again.seek(3)
    with pytest.raises(ValueError):
        PageIndex.open(spark, index.path + "/nothing")


def test_index_of_an_empty_table(spark, tmp_path):
    index = PageIndex.build(spark.range(0), "id", str(tmp_path / "none"))
    assert index.count() == 0 and index.page(0, 5).count() == 0 and index.first(3).count() == 0 and index.seek(4) == 0
    with pytest.raises(ValueError):
        PageIndex.build(spark.range(3), "missing", str(tmp_path / "bad"))


@pytest.mark.parametrize("part_rows, parts", [(200_000, 1), (1000, 20)])
def test_small_ranges_share_a_part(spark, tmp_path, monkeypatch, part_rows, parts):
    from tablehaul.operators import pages
    monkeypatch.setattr(pages, "PART_ROWS", part_rows)
    df = spark.range(0, 20_000).select((F.col("id") * 7919 % 20_000).alias("k"), "id")
    index = PageIndex.build(df, "k", str(tmp_path / "index"), range_rows=100)
    # what the driver samples and is told grows with the parts, not with the ranges
    assert sum(n.startswith("_part=") for n in list_names(spark, f"{index.path}/rows")) == parts
    assert index.fences().count() >= 200 and index.fences().agg(F.max("n")).first()[0] == 100
    for offset in (0, 950, 1999, 12_345, 19_990):
        assert [r.k for r in index.page(offset, 150).collect()] == list(range(offset, min(offset + 150, 20_000)))
        assert index.seek(offset) == offset and index.first(offset).agg(F.count("k"), F.max("k")).first()[0] == offset


def test_large_limit_goes_by_ranges(spark, monkeypatch):
    from tablehaul.operators import rows as R
    df = spark.range(0, 1000).select(F.col("id"), (F.col("id") % 7).cast("double").alias("x"))
    want = sorted(map(tuple, R.limit_then_partition(df, 300, "id", "x", 3).collect()))
    monkeypatch.setattr(R, "PAGE_ROWS", 100)
    assert sorted(map(tuple, R.limit_then_partition(df, 300, "id", "x", 3).collect())) == want and len(want) == 300


# ---- ledger ---------------------------------------------------------------------------

def test_write_new_has_one_winner(spark, tmp_path):
    path, won = str(tmp_path / "claims" / "one"), []
    threads = [threading.Thread(target=lambda i=i: won.append((i, write_new(spark, path, f"writer {i}")))) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sum(ok for _, ok in won) == 1
    winner = next(i for i, ok in won if ok)
    assert (tmp_path / "claims" / "one").read_text() == f"writer {winner}"
    assert list_names(spark, str(tmp_path / "claims")) == ["one"]


def test_retried_half_finished_and_concurrent_loads(spark, tmp_path):
    target = LedgerTable(spark, str(tmp_path / "t"))
    df = spark.range(0, 1000)
    assert target.load(df, "first") and not target.load(df, "first")  # tried again

    broken = df.select(F.when(F.col("id") == 999, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        target.load(broken, "second")
    target.stage(df, "second")  # its driver died before the entry
    assert target.count() == target.read().count() == 1000

    done = []
    threads = [threading.Thread(target=lambda: done.append(target.load(spark.range(1000, 1500), "second"))) for _ in range(4)]
    threads += [threading.Thread(target=lambda i=i: done.append(target.load(spark.range(2000 + i, 2001 + i), f"other{i}"))) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert done.count(True) == 5 and done.count(False) == 3
    assert sorted(r.id for r in target.read().collect()) == [*range(1500), *range(2000, 2004)]
    assert target.count() == 1504
    assert len(target.sweep()) >= 2 and target.read().count() == 1504 and not target.sweep()


def test_two_loads_staged_before_either_is_entered(spark, tmp_path):
    target = LedgerTable(spark, str(tmp_path / "t"))
    one, two = target.stage(spark.range(5), "day"), target.stage(spark.range(5), "day")
    assert target.commit(two) and not target.commit(one)
    assert target.read().count() == 5
    assert list_names(spark, f"{target.path}/loads") == [two["folder"]]


def test_replacing_and_incomplete_tables(spark, tmp_path):
    target = LedgerTable(spark, str(tmp_path / "t"))
    with pytest.raises(ValueError):
        target.read()
    target.load(spark.range(3), "part")
    assert target.load_if_incomplete(spark.range(10), "whole", 10) and target.read().count() == 10
    assert not target.load_if_incomplete(spark.range(10), "whole", 10)
    assert target.load(spark.range(4), "part", replace=True) and target.count() == 4  # its namesake is no part of the table now
    with pytest.raises(ValueError, match="columns differ"):
        target.load(spark.range(3).selectExpr("id AS other"), "odd")
    with pytest.raises(ValueError, match="not a name"):
        target.load(spark.range(3), "a/b")
    assert [e.load.split("-")[0] for e in target.entries()] == ["part", "whole", "part"]


def test_empty_load_and_odd_columns(spark, tmp_path):
    target = LedgerTable(spark, str(tmp_path / "t"))
    df = spark.createDataFrame([(1, None, {"a": [1.5]})], "`odd name` int, `x:y` string, m map<string, array<double>>")
    assert target.load(df.limit(0), "none") and target.load(df, "one")
    assert target.read().schema == df.schema and target.read().collect() == df.collect()
