"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    return repr(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(hashlib.md5("|".join(_norm(r[i]) for i in order).encode()).hexdigest()
                  for r in rows)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.fixture(scope="module")
def plain(spark):
    """A session that the library did not set up: SQL settings are Spark's own."""
    from tablehaul.session import DEFAULT_CONF
    session = spark.newSession()
    for key in DEFAULT_CONF:
        if key.startswith("spark.sql."):
            session.conf.unset(key)
    return session


def _family(kind):
    """The family of a column type of either engine."""
    kind = str(kind).lower()
    if kind.endswith("[]") or kind.startswith("array"):
        return "list"
    for family, names in {"integer": ("tinyint", "smallint", "int", "bigint", "hugeint", "long"),
                          "float": ("float", "double"), "text": ("varchar", "string"), "bytes": ("blob", "binary"),
                          "boolean": ("boolean",), "date": ("date",), "decimal": ("decimal",), "time": ("time(", "time"),
                          }.items():
        if kind in names or (family == "decimal" and kind.startswith("decimal")):
            return family
    return "timestamp" if kind.startswith("timestamp") else kind.split("(")[0]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "income" in df.columns
    assert df.where("region <> 'E12000007' OR age_group <> 5 OR income IS NULL").count() == 0


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(plain, sf_dir, duck, name):
    df = E.queries()[name](plain, sf_dir)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    oracle = E.oracle_sql().get(name)
    if oracle is None:  # those of the training-data operators are compared with brute force in their own tests
        assert len(rows) > 0
        return
    res = duck.sql(oracle)
    assert sorted(cols) == sorted(res.columns)
    spark_types = {n: _family(t) for n, t in df.dtypes}
    assert spark_types == {n: _family(t) for n, t in zip(res.columns, res.types)}
    orows = res.fetchall()
    assert len(rows) == len(orows)
    assert _digest(cols, rows) == _digest(res.columns, orows)


def test_arrow_batches_gives_the_rows_of_lineitem(spark, sf_dir):
    queries, sql = E.queries(), E.oracle_sql()
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    got = queries["arrow_batches"](spark, sf_dir)
    assert got.schema.simpleString() == lineitem.schema.simpleString()
    assert got.exceptAll(lineitem).count() == 0 and lineitem.exceptAll(got).count() == 0
    assert sql["arrow_batches"] == "SELECT * FROM lineitem"
