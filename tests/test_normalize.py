"""Normalisation rules on the type-matrix fixtures (FIXTURES §3)."""

import datetime
import decimal

import pytest
from pyspark.sql import types as T

from tablehaul.functions.normalize import (empty_as_null, epoch_text_timestamp, normalize_column,
                                           normalize_table, resolve_dynamic)

UUIDS = ["a0eebc99-9c0b-4ef8-bb6d-6bb9bd380a11", "A0EEBC99-9C0B-4EF8-BB6D-6BB9BD380A11",
         "{a0eebc99-9c0b4ef8-bb6d6bb9-bd380a11}", "a0eebc999c0b4ef8bb6d6bb9bd380a11"]


def one(spark, values, ddl):
    return spark.createDataFrame([(v,) for v in values], ddl)


def test_uuid_spellings(spark):
    df = one(spark, UUIDS, "u string")
    got = {r.u for r in normalize_table(df, "postgres", "arrow", {"u": "uuid"}).collect()}
    assert got == {"a0eebc99-9c0b-4ef8-bb6d-6bb9bd380a11"}


def test_timestamptz_to_utc(spark):
    df = one(spark, ["1970-01-01 00:00:01-00", "2000-02-28 12:00:10-04",
                     "2038-01-18 23:59:59+08", "1901-12-14 00:00:00.062547-12", None], "t string")
    rows = normalize_table(df, "postgres", "pandas", {"t": "timestamptz"}).collect()
    assert [r.t for r in rows] == [
        datetime.datetime(1970, 1, 1, 0, 0, 1), datetime.datetime(2000, 2, 28, 16, 0, 10),
        datetime.datetime(2038, 1, 18, 15, 59, 59),
        datetime.datetime(1901, 12, 14, 12, 0, 0, 62547), None]


def test_numeric_to_decimal_38_10(spark):
    df = one(spark, [".01", "521.34", "1e-5", "-1.123e2"], "n string")
    out = normalize_table(df.selectExpr("CAST(n AS DECIMAL(5,2)) AS n"), "postgres", "arrow")
    assert out.schema["n"].dataType == T.DecimalType(38, 10)
    assert [r.n for r in out.collect()] == [decimal.Decimal(x) for x in
                                            ("0.01", "521.34", "0", "-112.3")]


def test_int_rules(spark):
    df = spark.createDataFrame([(-32768, 0, 1)], "a short, b int, c long")
    pg = normalize_table(df, "postgres", "arrow")
    assert [f.dataType for f in pg.schema.fields] == [T.ShortType(), T.IntegerType(), T.LongType()]
    my = normalize_table(df, "mysql", "arrow")
    assert all(f.dataType == T.LongType() for f in my.schema.fields)
    tiny = spark.createDataFrame([(0,), (3,), (None,)], "t byte")
    assert [r.t for r in normalize_table(tiny, "mysql", "arrow").collect()] == [False, True, None]
    assert [r.t for r in normalize_table(tiny, "mysql", "pandas").collect()] == [0, 3, None]


def test_json_compact_sorted(spark):
    df = one(spark, ['{"customer": "John Doe", "items": {"product": "Beer", "qty": 6}}', "{}"],
             "j string")
    got = [r.j for r in normalize_table(df, "postgres", "arrow", {"j": "jsonb"}).collect()]
    assert got == ['{"customer":"John Doe","items":{"product":"Beer","qty":6}}', "{}"]


def test_bpchar_padding_and_empty_string(spark):
    df = one(spark, ["bb   ", "", None], "c string")
    got = [r.c for r in normalize_table(df, "postgres", "arrow", {"c": "bpchar"}).collect()]
    assert got == ["bb   ", "", None]
    assert [r.c for r in empty_as_null(df).collect()] == ["bb   ", None, None]


def test_array_texts(spark):
    df = spark.createDataFrame([("{-1.1, 0.00}", "{true,false,NULL}", "{-1, 0, 1123, NULL}"),
                                ("{}", "{}", "{}"), ("", None, "{-2147483648, 2147483647}")],
                               "f string, b string, i string")
    out = normalize_table(df, "postgres", "arrow", {"f": "_float8", "b": "_bool", "i": "_int4"})
    rows = out.collect()
    assert rows[0].f == [-1.1, 0.0] and rows[0].b == [True, False, None]
    assert rows[0].i == [-1, 0, 1123, None]
    assert rows[1].f == [] and rows[1].b == [] and rows[1].i == []
    assert rows[2].f is None and rows[2].b is None and rows[2].i == [-2147483648, 2147483647]


def test_bool_text_rejects_other_values(spark):
    ok = one(spark, ["t", "f", ""], "b string")
    assert [r.b for r in normalize_table(ok, "postgres", "arrow", {"b": "bool"}).collect()] == [
        True, False, None]
    bad = one(spark, ["yes"], "b string")
    with pytest.raises(Exception):
        normalize_table(bad, "postgres", "arrow", {"b": "bool"}).collect()


def test_vectors(spark):
    df = spark.createDataFrame([("{1:1,3:2,5:3}/5", "1010101010", "[0.5,1,2]")],
                               "s string, b string, v string")
    r = normalize_table(df, "postgres", "arrow",
                        {"s": "sparsevec", "b": "bit(10)", "v": "vector"}).first()
    assert r.s == [1.0, 0.0, 2.0, 0.0, 3.0]
    assert list(r.b) == [170, 128]
    assert r.v == [0.5, 1.0, 2.0]


def test_infinity_saturation(spark):
    df = spark.createDataFrame([("infinity", "infinity"), ("-infinity", "-infinity"),
                                ("2020-01-02", "2020-01-02 03:04:05")], "d string, t string")
    rows = normalize_table(df, "postgres", "arrow", {"d": "date", "t": "timestamp"}).collect()
    assert rows[0].d == datetime.date(9999, 12, 31) and rows[1].d == datetime.date(1, 1, 1)
    assert rows[0].t == datetime.datetime(9999, 12, 31, 23, 59, 59, 999999)
    assert rows[2].t == datetime.datetime(2020, 1, 2, 3, 4, 5)


def test_bytea_and_time_text(spark):
    df = spark.createDataFrame([("\\x08", "08:12:40"), ("\\x", "00:00:59.062547")],
                               "b string, t string")
    rows = normalize_table(df, "postgres", "pandas", {"b": "bytea", "t": "time"}).collect()
    assert bytes(rows[0].b) == b"\x08" and bytes(rows[1].b) == b""
    assert [r.t for r in rows] == ["08:12:40", "00:00:59.062547"]


def test_text_temporal_formats(spark):
    df = spark.createDataFrame([("2020-03-12", "2020-03-12 19:39:49.25", "2020-03-12T19:39:49",
                                 "1583000000.123456")], "d string, ts string, dt string, e string")
    r = df.select(normalize_column(df, "d", "trino", "arrow", "date"),
                  normalize_column(df, "ts", "trino", "arrow", "timestamp"),
                  normalize_column(df, "dt", "bigquery", "arrow", "datetime"),
                  epoch_text_timestamp(df.e).cast("long").alias("e")).first()
    assert r.d == datetime.date(2020, 3, 12)
    assert r.ts == datetime.datetime(2020, 3, 12, 19, 39, 49, 250000)
    assert r.dt == datetime.datetime(2020, 3, 12, 19, 39, 49)
    assert r.e == 1583000000


def test_resolve_dynamic(spark):
    df = spark.createDataFrame([("1", None, "x", "1.5"), ("2", "7", "y", None)],
                               "k string, a string, b string, c string")
    out = resolve_dynamic(df, {"k": "INTEGER"}, order_by="k")
    assert [f.dataType.simpleString() for f in out.schema.fields] == [
        "bigint", "bigint", "string", "double"]
    with pytest.raises(ValueError):
        resolve_dynamic(df.selectExpr("CAST(NULL AS STRING) AS z"))
    empty = resolve_dynamic(df.where("false").select("a"))
    assert empty.schema["a"].dataType == T.StringType()


def test_unsigned_bigint_double_or_exact_decimal(spark):
    df = spark.createDataFrame([(decimal.Decimal("18446744073709551615"),)], "u decimal(20,0)")
    d = normalize_table(df, "mysql", "arrow", {"u": "bigint unsigned"}).first().u
    assert isinstance(d, float) and d == 1.8446744073709552e19
    e = normalize_table(df, "mysql", "arrow", {"u": "bigint unsigned"}, u64="decimal").first().u
    assert e == decimal.Decimal("18446744073709551615")
