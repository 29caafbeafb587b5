"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator.

Every query reads the shared parquet tables of ``sf_dir`` (or data Spark
derives from them), over whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import census as C
from .operators.setops import replicate
from .plans.census import EXPAND_TIMES, census_expand, census_expand_plan
from .plans.census_source import census_like
from .session import scratch_path

QUERIES: dict = {}


def query(fn):
    QUERIES[fn.__name__.removeprefix("q_")] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_for(spark: SparkSession, name: str) -> str:
    """A folder of its own for every call, so that no query reads what another or an earlier run wrote."""
    return scratch_path(spark, "queries", name, unique=True)


def census_raw(spark, sf_dir):
    return census_like(table(spark, sf_dir, "orders"))


def census_expanded(spark, sf_dir):
    return census_expand_plan(census_raw(spark, sf_dir))


# ---- 2.3 projections / filters / synthesis -------------------------------------------

@query
def q_census_project(spark, sf_dir):
    return C.census_project(census_raw(spark, sf_dir))


@query
def q_add_random_int(spark, sf_dir):
    df = C.census_project(census_raw(spark, sf_dir))
    df = C.add_random_int(df, "income", *C.INCOME_RANGE)
    return C.add_random_int(df, "weight", *C.WEIGHT_RANGE)


@query
def q_blank_by_code(spark, sf_dir):
    return C.add_census_measures(C.census_project(census_raw(spark, sf_dir)))


@query
def q_simple_filter(spark, sf_dir):
    return C.simple_filter(census_expanded(spark, sf_dir))


@query
def q_complex_filter(spark, sf_dir):
    return C.complex_filter(census_expanded(spark, sf_dir))


# ---- 2.8 set operations ----------------------------------------------------------------

@query
def q_replicate(spark, sf_dir):
    return replicate(table(spark, sf_dir, "orders"), EXPAND_TIMES)


@query
def q_union_parts(spark, sf_dir):
    from .operators.setops import union_parts
    return union_parts([
        table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name")),
        table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"),
        table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")])


# ---- 2.12 end-to-end ---------------------------------------------------------------------

@query
def q_census_expand(spark, sf_dir):
    base = scratch_for(spark, "census_expand")
    return census_expand(census_raw(spark, sf_dir), parquet_path=f"{base}/census.parquet",
                         csv_path=f"{base}/census.csv")


# ---- shared helpers for SQL-source queries -------------------------------------------------

def source(spark, sf_dir):
    from .sources.sql import parquet_dir_source
    return parquet_dir_source(spark, sf_dir)


# Query texts on the shared tables, one for each shape of statement that a source must take.
PARTS = 4
SHIPPED_SQL = "SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem WHERE l_quantity > 10"
SUPPLIERS_SQL = """
SELECT s_suppkey, s_name, n_name AS nation FROM db1.supplier JOIN db2.nation ON n_nationkey = s_nationkey"""
STATUS_SQL = """
SELECT ord.o_orderstatus, COUNT(*) AS n_lines, ROUND(AVG(li.l_extendedprice), 2) AS mean_price, SUM(li.l_quantity) AS quantity
FROM db2.orders ord JOIN db1.lineitem li ON li.l_orderkey = ord.o_orderkey WHERE li.l_discount IS NOT NULL
GROUP BY ord.o_orderstatus ORDER BY quantity"""
PUSHDOWN_VIEW_SQL = ("SELECT o_orderkey, o_orderdate, c_mktsegment FROM orders "
                     "JOIN customer ON o_custkey = c_custkey")
PUSHDOWN_SQL = ("SELECT c_mktsegment, ROUND(SUM(l_extendedprice), 2) AS revenue, "
                "COUNT(*) AS n_lines FROM db1.lineitem l, db2.order_customer oc "
                "WHERE l.l_orderkey = oc.o_orderkey GROUP BY c_mktsegment")
IN_LIST_SQL = ("SELECT CAST(o_custkey AS INTEGER) AS custkey, o_orderkey FROM orders "
               "WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') ORDER BY o_orderkey")
ORDER_BY_SQL = ("SELECT o_orderkey, o_totalprice, o_orderdate FROM orders "
                "ORDER BY o_totalprice DESC, o_orderkey")
COUNT_SQL = "SELECT * FROM lineitem WHERE l_shipdate > DATE '1995-03-15'"
READ_LIST_SQL = ["SELECT * FROM orders WHERE o_orderstatus = 'O'",
                 "SELECT * FROM orders WHERE o_orderstatus <> 'O'"]
UDF_SQL = "SELECT o_orderkey, increment(o_custkey) AS next_custkey FROM orders"
CTE_SQL = "WITH dear AS (SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 150000)"
CTE_MAIN_SQL = "SELECT l_orderkey, l_linenumber, o_totalprice FROM lineitem JOIN dear ON o_orderkey = l_orderkey"


# ---- 2.1 sources ----------------------------------------------------------------------------

@query
def q_read_sql(spark, sf_dir):
    from .sources.sql import read_sql
    return read_sql(spark, source(spark, sf_dir), "SELECT * FROM lineitem")


@query
def q_read_sql_list(spark, sf_dir):
    from .sources.sql import read_sql
    return read_sql(spark, source(spark, sf_dir), READ_LIST_SQL)


@query
def q_read_sql_partitioned(spark, sf_dir):
    from .sources.sql import read_sql
    return read_sql(spark, source(spark, sf_dir), SHIPPED_SQL, partition_on="l_orderkey",
                    partition_num=PARTS, part_col="part")


@query
def q_read_sql_prepared(spark, sf_dir):
    from .sources.sql import read_sql
    return read_sql(spark, source(spark, sf_dir), CTE_MAIN_SQL, prepare_query=CTE_SQL)


@query
def q_parquet_scan(spark, sf_dir):
    from .sources.files import parquet_scan
    return (parquet_scan(spark, f"{sf_dir}/orders.parquet")
            .where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice"))


@query
def q_filtered_table_scan(spark, sf_dir):
    from .sinks import load_if_incomplete
    target = census_target(spark, "filtered_table_scan")
    load_if_incomplete(_measured(spark, sf_dir), target, "census", table(spark, sf_dir, "orders").count())
    return C.readback_filter(target.table(spark, "census"))


def census_target(spark, name):
    """An empty table target: a catalog database of its own over a folder of its own."""
    from .sources.sql import CatalogSource
    folder = scratch_for(spark, name)
    return CatalogSource("th_target_" + folder.rsplit("/", 1)[-1], {"census": f"{folder}/census"}).attach(spark)


# ---- 2.3 predicates --------------------------------------------------------------------------

@query
def q_range_predicate(spark, sf_dir):
    """The predicates that a database would get, evaluated in one scan: each row under the one it meets."""
    from .operators.partition import partition_bounds, plan_ranges, range_predicates
    li = table(spark, sf_dir, "lineitem")
    b = partition_bounds(li, "l_orderkey").first()
    preds = range_predicates("l_orderkey", plan_ranges(b["min"], b["max"], PARTS))
    met = F.filter(F.array(*[F.when(F.expr(p), F.lit(i)) for i, p in enumerate(preds)]), lambda i: i.isNotNull())
    return li.withColumn("parts", met).where(F.size("parts") > 0).withColumn(
        "part", F.element_at("parts", 1)).withColumn("n_parts", F.size("parts")).drop("parts")


@query
def q_in_list_cast(spark, sf_dir):
    from .sources.sql import read_sql
    return read_sql(spark, source(spark, sf_dir), IN_LIST_SQL)


# ---- 2.4 partition planning ------------------------------------------------------------------

@query
def q_partition_bounds(spark, sf_dir):
    from .operators.partition import partition_bounds
    return partition_bounds(table(spark, sf_dir, "lineitem"), "l_orderkey")


@query
def q_partition_assign(spark, sf_dir):
    from .operators.partition import partition_assign
    return partition_assign(_fractional(spark, sf_dir), "x", PARTS)


def _fractional(spark, sf_dir):
    """lineitem keys with a fractional column that has negative values, NULLs and NaNs."""
    x = (F.when(F.col("l_linenumber") == 6, F.lit(None)).when(F.col("l_linenumber") == 5, F.lit(float("nan")))
         .otherwise(F.col("l_extendedprice") - F.lit(20000.25)))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", x.alias("x"))


@query
def q_partition_counts(spark, sf_dir):
    from .operators.partition import partition_counts
    return partition_counts(table(spark, sf_dir, "lineitem"), "l_orderkey", PARTS)


# ---- 2.5 joins ---------------------------------------------------------------------------------

@query
def q_cross_source_equi_join(spark, sf_dir):
    from .operators.join import equi_join
    from .plans.federate import register_source
    register_source(spark, "db1", sf_dir)
    register_source(spark, "db2", sf_dir)
    n, r = spark.table("db1.nation"), spark.table("db2.region")
    return equi_join(n, r, n.n_regionkey == r.r_regionkey)


@query
def q_spja_three_way(spark, sf_dir):
    from .plans.spja import spja_three_way
    out = spja_three_way(table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders"),
                         table(spark, sf_dir, "lineitem"), priority_col="o_orderpriority")
    return out.withColumn("revenue", F.round("revenue", 2))


# ---- 2.6 aggregations --------------------------------------------------------------------------

@query
def q_count_rows(spark, sf_dir):
    from .operators.aggregate import count_rows
    from .sources.sql import read_sql
    return count_rows(read_sql(spark, source(spark, sf_dir), COUNT_SQL))


@query
def q_min_max(spark, sf_dir):
    from .operators.aggregate import min_max
    return min_max(table(spark, sf_dir, "lineitem"), "l_extendedprice")


@query
def q_group_sum(spark, sf_dir):
    from .operators.aggregate import group_sum
    li = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_returnflag") == "R", True).when(F.col("l_returnflag") == "A", False)
        .alias("flag"), "l_quantity")
    return group_sum(li, "flag", "l_quantity", "sum_qty").withColumn(
        "sum_qty", F.round("sum_qty", 2))


@query
def q_fed_group_agg(spark, sf_dir):
    from .plans.federate import federated_sql
    return federated_sql(spark, {"db1": sf_dir, "db2": sf_dir}, STATUS_SQL)


@query
def q_spja_revenue(spark, sf_dir):
    from .plans.spja import spja_three_way
    out = spja_three_way(table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"),
                         priority_col="o_orderpriority", segment="MACHINERY", cutoff="1994-07-01")
    return out.withColumn("revenue", F.round("revenue", 2))


# ---- 2.7 sorts / limits ----------------------------------------------------------------------

@query
def q_head(spark, sf_dir):
    from .operators.rows import head
    return head(census_expanded(spark, sf_dir), 5, order_by="id")


@query
def q_page(spark, sf_dir):
    from .operators.rows import PAGE_ROWS, page
    return page(census_expanded(spark, sf_dir), "id", offset=PAGE_ROWS, n=PAGE_ROWS)


@query
def q_limit_then_partition(spark, sf_dir):
    from .operators.rows import limit_then_partition
    return limit_then_partition(_fractional(spark, sf_dir), 1000, ["l_orderkey", "l_linenumber"], "x", 3)


@query
def q_order_by(spark, sf_dir):
    from .sources.sql import read_sql
    return read_sql(spark, source(spark, sf_dir), ORDER_BY_SQL)


# ---- 2.10 SQL functions ---------------------------------------------------------------------------

@query
def q_sql_scalar_udf(spark, sf_dir):
    from .functions.sqlfuncs import register_increment
    from .sources.sql import read_sql
    register_increment(spark)
    return read_sql(spark, source(spark, sf_dir), UDF_SQL)


# ---- 2.11 multi-source SQL -------------------------------------------------------------------------

@query
def q_federated_sql(spark, sf_dir):
    from .plans.federate import federated_sql
    return federated_sql(spark, {"db1": sf_dir, "db2": sf_dir}, SUPPLIERS_SQL)


@query
def q_federated_pushdown(spark, sf_dir):
    from .plans.federate import federated_sql
    return federated_sql(spark, {
        "db1": sf_dir,
        "db2": {"path": sf_dir, "tables": ["orders", "customer"],
                "views": {"order_customer": PUSHDOWN_VIEW_SQL}},
    }, PUSHDOWN_SQL)


# ---- 2.1 file sources / 2.2 sinks (write to the shared scratch folder, read back) ------------

def _census_csv(spark, sf_dir):
    """The census-shaped raw table written once as CSV (the file the job lands)."""
    path = scratch_for(spark, "census_raw.csv")
    census_raw(spark, sf_dir).write.csv(path, header=True)
    return path


def _customer_csv_files(spark, sf_dir):
    """``customer`` as two folders of CSV files of at most 500 records, the second with its columns in
    another order."""
    base, customer = scratch_for(spark, "customer_csv"), table(spark, sf_dir, "customer")
    halves = {"odd": customer.where("c_custkey % 2 = 1"),
              "even": customer.where("c_custkey % 2 = 0").select(*reversed(customer.columns))}
    for name, half in halves.items():
        half.write.option("maxRecordsPerFile", 500).csv(f"{base}/{name}", header=True)
    return [f"{base}/{name}" for name in halves]


@query
def q_csv_scan(spark, sf_dir):
    from .sources.files import csv_scan
    return csv_scan(spark, _census_csv(spark, sf_dir))


@query
def q_csv_multi_scan(spark, sf_dir):
    from .sources.files import csv_multi_scan
    return csv_multi_scan(spark, _customer_csv_files(spark, sf_dir))


@query
def q_csv_infer(spark, sf_dir):
    """The inferred type of each column, with what all files hold under it."""
    from .sources.files import csv_infer, csv_multi_scan
    files = _customer_csv_files(spark, sf_dir)
    schema = csv_infer(spark, files)
    rows = csv_multi_scan(spark, files, schema)
    facts = rows.agg(*[F.struct(F.lit(f.name).alias("column_name"), F.max(F.typeof(f.name)).alias("data_type"),
                                F.lit(f.nullable).alias("nullable"), F.count(f.name).alias("n_values"),
                                F.countDistinct(f.name).alias("n_distinct")).alias(f.name) for f in schema.fields])
    return facts.select(F.inline(F.array(*[F.col(f.name) for f in schema.fields])))


@query
def q_land_raw(spark, sf_dir):
    from .sources.files import land_raw
    return land_raw(spark, _census_csv(spark, sf_dir), scratch_for(spark, "raw"), preview=0)


def _measured(spark, sf_dir):
    return C.add_census_measures(C.census_project(census_raw(spark, sf_dir)))


@query
def q_parquet_sink(spark, sf_dir):
    from .sinks import parquet_sink
    path = scratch_for(spark, "measured.parquet")
    parquet_sink(_measured(spark, sf_dir), path)
    return spark.read.parquet(path)


@query
def q_csv_sink(spark, sf_dir):
    from .sinks import csv_sink
    orders = table(spark, sf_dir, "orders")
    path = scratch_for(spark, "orders.csv")
    csv_sink(orders, path)
    return spark.read.schema(orders.schema).csv(path, header=True)


@query
def q_publish_if_absent(spark, sf_dir):
    from .sinks import publish_if_absent
    path = scratch_for(spark, "published.parquet")
    publish_if_absent(_measured(spark, sf_dir), path)
    publish_if_absent(_measured(spark, sf_dir).limit(0), path)  # already there: writes nothing
    return spark.read.parquet(path)


@query
def q_bulk_table_sink(spark, sf_dir):
    from .sinks import bulk_sink
    target = census_target(spark, "bulk_table_sink")
    orders = table(spark, sf_dir, "orders")
    bulk_sink(orders.where("o_orderkey % 2 = 0"), target, "census", mode="overwrite")
    bulk_sink(orders.where("o_orderkey % 2 = 1"), target, "census")  # a second load is appended
    return target.table(spark, "census")


@query
def q_load_if_incomplete(spark, sf_dir):
    from .sinks import bulk_sink, load_if_incomplete
    target, measured = census_target(spark, "load_if_incomplete"), _measured(spark, sf_dir)
    bulk_sink(measured.where("id % 3 = 0"), target, "census", mode="overwrite")  # an earlier load that broke off
    load_if_incomplete(measured, target, "census", table(spark, sf_dir, "orders").count())
    return target.table(spark, "census")


@query
def q_arrow_batches(spark, sf_dir):
    """lineitem as encoded batches, as a consumer gets them, and decoded again."""
    from .streaming import arrow_batches, decode_batches
    li = table(spark, sf_dir, "lineitem")
    return decode_batches(arrow_batches(li), li.schema)


# ---- 2.12 the census job --------------------------------------------------------------------

def _run_census(spark, sf_dir, **kw):
    """The whole job: land the census CSV, expand, load the table target if
    incomplete, publish if absent, read back, filter."""
    from .plans.census import CensusConfig, run_census
    from .sources.sql import CatalogSource
    base = scratch_for(spark, "census_job")
    target = CatalogSource("th_target_" + base.rsplit("/", 1)[-1], {})  # its table shares the expanded files
    cfg = CensusConfig(raw_dir=f"{base}/raw", expanded_dir=f"{base}/large",
                       source_path=_census_csv(spark, sf_dir),
                       target=target, table="census",
                       publish_path=f"{base}/bucket/large/census.parquet", **kw)
    return run_census(spark, cfg)


@query
def q_census_pipeline(spark, sf_dir):
    return _run_census(spark, sf_dir).simple


@query
def q_census_etl_only(spark, sf_dir):
    return _run_census(spark, sf_dir, etl_only=True).expanded


@query
def q_census_filter_readback(spark, sf_dir):
    """The filter on the read-back subset, which no row meets: one age group is read, another asked for."""
    return _run_census(spark, sf_dir, filter_on="readback").simple


@query
def q_census_readback(spark, sf_dir):
    """The subset that the job reads back from its table."""
    return _run_census(spark, sf_dir).readback


# ---- 2.9 type normalisation (source-typed columns derived from the shared tables) -----------

def _normalized(spark, sf_dir, name, keep, derive, specs):
    """``derive`` builds source-typed columns; ``specs`` = (column, source, target, type)."""
    from .functions.normalize import normalize_column
    d = table(spark, sf_dir, name).selectExpr(*keep, *derive)
    return d.select(*keep, *[normalize_column(d, c, s, tg, ty) for c, s, tg, ty in specs])


UUID_HEX = "md5(CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING))"


def uuid_canonical_sql(h: str = UUID_HEX) -> str:
    return (f"substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-' || substr({h}, 13, 4) || '-' "
            f"|| substr({h}, 17, 4) || '-' || substr({h}, 21, 12)")


def uuid_spelled_sql(h: str = UUID_HEX) -> str:
    fours = " || '-' || ".join(f"substr({h}, {1 + 4 * i}, 4)" for i in range(8))
    return (f"CASE l_linenumber % 4 WHEN 0 THEN {uuid_canonical_sql(h)} "
            f"WHEN 1 THEN upper({h}) WHEN 2 THEN '{{' || {uuid_canonical_sql(h)} || '}}' "
            f"ELSE upper({fours}) END")


ARRAY_TEXT_SQL = ("CASE WHEN l_linenumber = 1 THEN '{}' WHEN l_linenumber = 7 THEN '' "
                  "ELSE '{' || CAST(l_partkey AS STRING) || ',' || CASE WHEN l_linenumber % 3 = 0 "
                  "THEN 'NULL' ELSE CAST(l_suppkey AS STRING) END || ',' || "
                  "CAST(l_linenumber AS STRING) || '}' END")
SHIFT_HOURS = "CAST(o_orderkey % 24 AS INT)"


@query
def q_norm_int_widen(spark, sf_dir):
    return _normalized(spark, sf_dir, "lineitem", ["l_orderkey"],
                       ["CAST(l_linenumber AS SMALLINT) AS c_small", "l_linenumber AS c_int",
                        "CAST(l_linenumber AS SMALLINT) AS pg_small", "CAST(l_linenumber AS STRING) AS bq_int"],
                       [("bq_int", "bigquery", "arrow", "INT64"),
                        ("c_small", "mysql", "arrow", "smallint"),
                        ("c_int", "mysql", "arrow", "int"),
                        ("pg_small", "postgres", "arrow", "int2")])


@query
def q_norm_u64_double(spark, sf_dir):
    return _normalized(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber"],
                       ["l_orderkey * 1000003 AS u64", "l_linenumber AS u32"],
                       [("u64", "mysql", "arrow", "bigint unsigned"),
                        ("u32", "mysql", "arrow", "int unsigned")])


@query
def q_norm_float_widen(spark, sf_dir):
    return _normalized(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber"],
                       ["CAST(l_discount AS FLOAT) AS f32", "CAST(l_discount AS FLOAT) AS pg_f32",
                        "CAST(CAST(l_discount AS FLOAT) AS STRING) AS ora_f32",
                        "CAST(l_extendedprice AS STRING) AS ora_f64"],
                       [("f32", "mysql", "arrow", "float"), ("pg_f32", "postgres", "arrow", "float4"),
                        ("ora_f32", "oracle", "arrow", "BINARY_FLOAT"), ("ora_f64", "oracle", "arrow", "BINARY_DOUBLE")])


@query
def q_norm_decimal(spark, sf_dir):
    return _normalized(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber"],
                       ["CAST(l_extendedprice AS DECIMAL(15,2)) AS pg_dec",
                        "CAST(l_extendedprice AS DECIMAL(15,2)) AS my_dec",
                        "CAST(l_quantity AS DECIMAL(10,0)) AS num0", "CAST(l_quantity AS DECIMAL(10,0)) AS num10",
                        "CAST(l_extendedprice AS STRING) AS bq_big"],
                       [("pg_dec", "postgres", "arrow", "numeric(15,2)"),
                        ("my_dec", "mysql", "arrow", "decimal(15,2)"),
                        ("num0", "oracle", "arrow", "number(10,0)"), ("num10", "oracle", "arrow", "number(10)"),
                        ("bq_big", "bigquery", "arrow", "BIGNUMERIC")])


@query
def q_norm_tinyint_bool(spark, sf_dir):
    return _normalized(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber"],
                       ["CAST(l_linenumber % 2 AS TINYINT) AS flag",
                        "CAST(l_linenumber % 2 AS TINYINT) AS flag_pd"],
                       [("flag", "mysql", "arrow", "tinyint"),
                        ("flag_pd", "mysql", "pandas", "tinyint")])


@query
def q_norm_uuid(spark, sf_dir):
    return _normalized(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber"],
                       [f"{uuid_spelled_sql()} AS u", f"upper({uuid_canonical_sql()}) AS ms_u"],
                       [("u", "postgres", "arrow", "uuid"), ("ms_u", "mssql", "arrow", "uniqueidentifier")])


@query
def q_norm_json(spark, sf_dir):
    return _normalized(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber"],
                       ["'{\"qty\": ' || CAST(CAST(l_quantity AS BIGINT) AS STRING) || "
                        "', \"flag\": \"' || l_returnflag || '\", \"line\": ' || "
                        "CAST(l_linenumber AS STRING) || '}' AS doc",
                        "' {\"a\": 1, \"a\": ' || CAST(l_linenumber AS STRING) || '}' AS twice"],
                       [("doc", "postgres", "arrow", "jsonb"), ("twice", "postgres", "arrow", "json")])


@query
def q_norm_hstore(spark, sf_dir):
    return _normalized(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber"],
                       ["map('flag', l_returnflag, 'status', CASE WHEN l_linestatus = 'O' "
                        "THEN NULL ELSE l_linestatus END) AS kv"],
                       [("kv", "postgres", "pandas", "hstore")])


@query
def q_norm_inet(spark, sf_dir):
    return _normalized(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber"],
                       ["'10.' || CAST(l_orderkey % 256 AS STRING) || '.' || "
                        "CAST(l_linenumber AS STRING) || '.0/24' AS net"],
                       [("net", "postgres", "arrow", "cidr")])


@query
def q_norm_textlike(spark, sf_dir):
    return _normalized(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber"],
                       ["rpad(l_returnflag, 5, ' ') AS code", "l_linestatus AS status"],
                       [("code", "postgres", "arrow", "bpchar"),
                        ("status", "postgres", "arrow", "enum")])


@query
def q_norm_time(spark, sf_dir):
    spark.conf.set("spark.sql.timeType.enabled", "true")  # without it Spark refuses the cast to TIME below
    s = "((l_orderkey * 37 + l_linenumber * 1013) % 86400)"
    txt = (f"lpad(CAST({s} DIV 3600 AS STRING), 2, '0') || ':' || "
           f"lpad(CAST(({s} DIV 60) % 60 AS STRING), 2, '0') || ':' || "
           f"lpad(CAST({s} % 60 AS STRING), 2, '0') || "
           f"CASE WHEN l_linenumber % 3 = 0 THEN '.062547' ELSE '' END")
    return _normalized(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber"],
                       [f"{txt} AS t", f"CAST({txt} AS TIME) AS typed"],
                       [("t", "postgres", "pandas", "time"), ("typed", "postgres", "pandas", "time")])


@query
def q_norm_timestamp(spark, sf_dir):
    tz = ("date_format(o_orderdate + make_interval(0, 0, 0, 0, " + SHIFT_HOURS + ", 0, 0), "
          "'yyyy-MM-dd HH:mm:ss') || CASE WHEN o_orderkey % 3 = 0 THEN '+08' "
          "WHEN o_orderkey % 3 = 1 THEN '-04' ELSE '-00' END")
    return _normalized(spark, sf_dir, "orders", ["o_orderkey"],
                       [f"{tz} AS tstz", "o_orderdate AS ts", "CAST(o_orderdate AS DATE) AS d"],
                       [("tstz", "postgres", "pandas", "timestamptz"),
                        ("ts", "postgres", "pandas", "timestamp"),
                        ("d", "postgres", "pandas", "date")])


@query
def q_norm_text_temporal(spark, sf_dir):
    ts = ("date_format(o_orderdate + make_interval(0, 0, 0, 0, " + SHIFT_HOURS + ", 0, 0), "
          "'yyyy-MM-dd HH:mm:ss') || CASE WHEN o_orderkey % 2 = 0 THEN '.5' ELSE '' END")
    return _normalized(spark, sf_dir, "orders", ["o_orderkey"],
                       ["CAST(CAST(o_orderdate AS DATE) AS STRING) AS d_txt", f"{ts} AS ts_txt",
                        "date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss\") AS dt_txt",
                        f"{ts} AS ts3_txt", f"{ts} AS dt6_txt",
                        "date_format(o_orderdate + make_interval(0, 0, 0, 0, 3, 4, 5), 'yyyy-MM-dd HH:mm:ss') AS ora_txt",
                        "o_orderdate + make_interval(0, 0, 0, 0, 3, 4, 5) AS ora_date"],
                       [("d_txt", "trino", "arrow", "date"),
                        ("ts_txt", "trino", "arrow", "timestamp"),
                        ("dt_txt", "bigquery", "arrow", "datetime"), ("ts3_txt", "trino", "arrow", "timestamp(3)"),
                        ("dt6_txt", "mysql", "arrow", "datetime(6)"), ("ora_txt", "oracle", "arrow", "DATE"),
                        ("ora_date", "oracle", "arrow", "date")])


@query
def q_norm_text_blob(spark, sf_dir):
    return _normalized(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber"],
                       ["CAST(l_returnflag || l_linestatus AS BINARY) AS txt_blob",
                        "CAST(l_returnflag AS BINARY) AS raw_blob"],
                       [("txt_blob", "mysql", "arrow", "blob_utf8"),
                        ("raw_blob", "mysql", "arrow", "blob")])


@query
def q_norm_infinity(spark, sf_dir):
    return _normalized(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber"],
                       ["CASE WHEN l_linenumber = 1 THEN 'infinity' WHEN l_linenumber = 2 THEN "
                        "'-infinity' ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END AS d_txt",
                        "CASE WHEN l_linenumber = 1 THEN 'infinity' WHEN l_linenumber = 2 THEN "
                        "'-infinity' ELSE date_format(l_shipdate, 'yyyy-MM-dd HH:mm:ss') END AS ts_txt"],
                       [("d_txt", "postgres", "arrow", "date"),
                        ("ts_txt", "postgres", "arrow", "timestamp")])


@query
def q_norm_array_text(spark, sf_dir):
    return _normalized(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber"],
                       [f"{ARRAY_TEXT_SQL} AS arr",
                        "'{\"' || l_returnflag || ',x\",plain,NULL,\"NULL\"}' AS words",
                        "'{' || CAST(CAST(l_shipdate AS DATE) AS STRING) || '}' AS days"],
                       [("arr", "postgres", "arrow", "_int8"), ("words", "postgres", "arrow", "_bpchar"),
                        ("days", "postgres", "arrow", "_date")])


@query
def q_norm_array_no_null(spark, sf_dir):
    out = _normalized(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber"],
                      [f"{ARRAY_TEXT_SQL} AS arr"], [("arr", "postgres", "pandas", "_int8")])
    return out.withColumn("has_null", F.exists("arr", lambda x: x.isNull()))


@query
def q_norm_bool_text(spark, sf_dir):
    return _normalized(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber"],
                       ["CASE l_returnflag WHEN 'R' THEN 't' WHEN 'A' THEN 'f' ELSE '' END AS b",
                        "CASE l_returnflag WHEN 'R' THEN 'true' WHEN 'A' THEN 'false' END AS tr",
                        "CASE l_returnflag WHEN 'R' THEN 'TRUE' WHEN 'A' THEN 'FALSE' END AS bq",
                        "CASE l_returnflag WHEN 'R' THEN '1' WHEN 'A' THEN '0' END AS ms",
                        "l_returnflag = 'R' AS ms_typed"],
                       [("b", "postgres", "arrow", "bool"), ("tr", "trino", "arrow", "boolean"),
                        ("bq", "bigquery", "arrow", "BOOL"), ("ms", "mssql", "arrow", "bit"),
                        ("ms_typed", "mssql", "arrow", "bit")])


@query
def q_norm_empty_null(spark, sf_dir):
    from .functions.normalize import empty_as_null
    d = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber",
        "CASE WHEN l_linestatus = 'O' THEN '' ELSE l_returnflag END AS v")
    return empty_as_null(d, ["v"])


@query
def q_norm_bytes(spark, sf_dir):
    return _normalized(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber"],
                       ["chr(92) || 'x' || substr(md5(CAST(l_orderkey AS STRING)), 1, 8) AS by"],
                       [("by", "postgres", "arrow", "bytea")])


@query
def q_norm_vector(spark, sf_dir):
    return _normalized(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber"],
                       ["'{' || CAST(l_linenumber AS STRING) || ':' || "
                        "CAST(CAST(l_quantity AS BIGINT) AS STRING) || '}/7' AS sv",
                        "lpad(bin(l_partkey % 1024), 10, '0') AS bits"],
                       [("sv", "postgres", "arrow", "sparsevec"),
                        ("bits", "postgres", "arrow", "bit(10)")])


@query
def q_normalize_table(spark, sf_dir):
    from .functions.normalize import normalize_table
    return normalize_table(table(spark, sf_dir, "embeddings"), "postgres", "pandas",
                           {"embedding": "vector"})


@query
def q_resolve_dynamic(spark, sf_dir):
    from .functions.normalize import resolve_dynamic
    d = table(spark, sf_dir, "orders").selectExpr(
        "CAST(o_orderkey AS STRING) AS a", "CAST(o_totalprice AS STRING) AS b",
        "o_orderpriority AS c", "CAST(o_custkey AS STRING) AS d",
        "CASE WHEN o_orderstatus = 'F' THEN '1' ELSE '0' END AS e", "CAST(CAST(o_orderdate AS DATE) AS STRING) AS f",
        "date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') AS g")
    return resolve_dynamic(d, {"a": "INTEGER", "e": "BOOL", "f": "DATE", "g": "DATETIME"}, order_by="a")


# ---- 2.7 pages at any depth, 2.2 loads that happen once ----------------------------------

PAGE_SIZE = 1000


@query
def q_page_index(spark, sf_dir):
    """The first, a middle and the last page of lineitem by price, from a written index."""
    from .operators.pages import PageIndex
    keys = ["l_extendedprice", "l_orderkey", "l_linenumber"]
    index = PageIndex.build(table(spark, sf_dir, "lineitem"), keys, scratch_for(spark, "page_index"), range_rows=5 * PAGE_SIZE)
    last = (index.count() - 1) // PAGE_SIZE
    pages = [index.page(p * PAGE_SIZE, PAGE_SIZE, number="row_no") for p in sorted({0, last // 2, last})]
    out = pages[0]
    for p in pages[1:]:
        out = out.unionAll(p)
    return out.select("row_no", *keys, "l_shipdate")


@query
def q_ledger_load(spark, sf_dir):
    """orders, loaded by order status: one load is tried twice, one breaks off, one replaces an earlier table."""
    from .sinks import LedgerTable
    orders = table(spark, sf_dir, "orders")
    target = LedgerTable(spark, scratch_for(spark, "ledger"))
    target.load(orders.limit(0), "empty")
    target.load(orders.where("o_orderstatus = 'O'"), "open", replace=True)
    target.stage(orders, "broken")  # written, never entered
    for _ in range(2):
        target.load(orders.where("o_orderstatus = 'F'"), "filled")
    target.load(orders.where("o_orderstatus NOT IN ('O', 'F') OR o_orderstatus IS NULL"), "others")
    return target.read()


# ---- joins on time: as-of, points in intervals, overlapping intervals -------------------

@query
def q_asof_join(spark, sf_dir):
    """Each purchase with the last view of the same user in the day before it."""
    from datetime import timedelta

    from .operators.asof import asof_join
    events = table(spark, sf_dir, "events")
    bought = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts", "value")
    seen = events.where("event_type = 'view'").select("event_id", "user_id", "ts", "value")
    return asof_join(bought, seen, "user_id", "ts", tolerance=timedelta(days=1), bucket=timedelta(days=2), suffix="_seen")


@query
def q_asof_join_forward(spark, sf_dir):
    """Each error with the next event of its type after it, whoever's it is: one key has all rows."""
    from .operators.asof import asof_join
    events = table(spark, sf_dir, "events").withColumn("shop", F.lit(1))
    errors = events.where("event_type = 'error'").select("shop", "event_id", "ts")
    return asof_join(errors, events.select("shop", "event_id", "ts", "event_type"), "shop", "ts", direction="forward", exact=False,
                     suffix="_next", bucket_rows=2000).drop("shop")


def _spells(spark, sf_dir, kind: str, unit: str):
    """Events of a kind as intervals: as many units long as their value says."""
    events = table(spark, sf_dir, "events").where(F.col("event_type") == kind)
    return events.select("event_id", "user_id", F.col("ts").alias("begins"),
                         F.expr(f"ts + make_interval(0, 0, 0, 0, 0, {unit})").alias("ends"))


@query
def q_range_join(spark, sf_dir):
    """Clicks of a user while one of that user's purchases is open (its value in minutes, ten times over)."""
    from .operators.intervals import range_join
    clicks = table(spark, sf_dir, "events").where("event_type = 'click'").select("event_id", "user_id", "ts")
    return range_join(clicks, _spells(spark, sf_dir, "purchase", "10 * CAST(value AS INT), 0"), "ts", "begins", "ends", on="user_id",
                      suffix="_purchase")


@query
def q_interval_join(spark, sf_dir):
    """Errors and sign-ups of any users that overlap (each as many seconds long as its value)."""
    from .operators.intervals import interval_join
    return interval_join(_spells(spark, sf_dir, "error", "0, CAST(value AS INT)"), _spells(spark, sf_dir, "signup", "0, CAST(value AS INT)"),
                         ("begins", "ends"), suffix="_signup")


# ---- event-time streaming ------------------------------------------------------------------

SLICES = 3


def _streamed(spark, sf_dir, name, plan):
    """``plan`` over events as a stream of files: a third of the time arrives, the stream works through it and stops,
    the next third arrives, and it goes on from its checkpoint."""
    from .streaming import file_stream, run_once, written
    base, events = scratch_for(spark, name), table(spark, sf_dir, "events")
    lo, hi = events.agg(F.min("event_id"), F.max("event_id")).first()
    size = (hi - lo) // SLICES + 1 if hi is not None else 1
    out = None
    for i in range(SLICES):
        events.where(F.floor((F.col("event_id") - F.lit(lo)) / F.lit(size)) == i).write.parquet(f"{base}/in/slice-{i}")
        out = plan(file_stream(spark, f"{base}/in", events.schema))
        run_once(out, f"{base}/out", f"{base}/checkpoint")
    return written(spark, f"{base}/out", out.schema)


def _event_counts():
    return {"n_events": F.count(F.lit(1)), "n_values": F.count("value"), "most": F.max("value")}


@query
def q_event_windows(spark, sf_dir):
    """Events by type in windows of six hours, as a stream: the windows that the watermark has passed."""
    from .streaming import event_windows
    return _streamed(spark, sf_dir, "event_windows", lambda events: event_windows(
        events, "ts", "6 hours", _event_counts(), keys=["event_type"], delay="30 minutes"))


@query
def q_event_windows_sliding(spark, sf_dir):
    """Events in windows of a day, every eight hours, as a stream."""
    from .streaming import event_windows
    return _streamed(spark, sf_dir, "event_windows_sliding", lambda events: event_windows(
        events, "ts", "24 hours", _event_counts(), slide="8 hours", delay="30 minutes"))


@query
def q_event_windows_batch(spark, sf_dir):
    """The same plan over the table: all windows."""
    from .streaming import event_windows
    return event_windows(table(spark, sf_dir, "events"), "ts", "6 hours", _event_counts(), keys=["event_type"])


@query
def q_event_sessions(spark, sf_dir):
    """The sessions of each user: no two days without an event."""
    from datetime import timedelta

    from .streaming import sessions
    return sessions(table(spark, sf_dir, "events"), "ts", ["user_id"], timedelta(days=2), "value").withColumn("total", F.round("total", 2))


@query
def q_event_sessions_stream(spark, sf_dir):
    """The same sessions as a stream: those that the watermark has passed."""
    from datetime import timedelta

    from .streaming import session_stream
    return _streamed(spark, sf_dir, "event_sessions", lambda events: session_stream(
        events, "ts", ["user_id"], timedelta(days=2), "30 minutes", "value")).withColumn("total", F.round("total", 2))


# ---- ranks, levels, bags and sketches on keys of any size --------------------------------

@query
def q_running_frames(spark, sf_dir):
    """Ranks and running measures of lineitem within its three return flags."""
    from .operators.frames import running
    from .operators.pieces import cuts
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_shipdate", "l_orderkey", "l_linenumber", "l_quantity")
    found = cuts(li, "l_shipdate", piece_rows=5000)  # of the same rows by the same column: they serve both
    days = running(li, "l_returnflag", "l_shipdate", {"day_rank": "rank", "day_no": "dense_rank"}, piece_rows=5000, found=found)
    return running(days, "l_returnflag", ["l_shipdate", "l_orderkey", "l_linenumber"], {
        "row_no": "row_number", "sum_qty": ("sum", "l_quantity"), "most_qty": ("max", "l_quantity"), "least_qty": ("min", "l_quantity"),
        "n_qty": ("count", "l_quantity")}, piece_rows=5000, found=found)


@query
def q_running_desc(spark, sf_dir):
    """Orders of each status from the dearest down: place, and the mean price so far in cents."""
    from .operators.frames import running
    orders = table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderkey", F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    return running(orders, "o_orderstatus", [("cents", "desc"), "o_orderkey"], {"place": "row_number", "mean": ("avg", "cents")}, piece_rows=1000)


@query
def q_cube_levels(spark, sf_dir):
    """Orders by status, priority and year, at all eight levels, with two distinct counts."""
    from .operators.levels import levels
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    orders = orders.withColumn("status", F.nullif("o_orderstatus", F.lit("P")))  # a NULL of the data beside those of the levels
    return levels(orders, ["status", "o_orderpriority", "year"], {
        "n": ("count", "*"), "least": ("min", "o_totalprice"), "most": ("max", "o_totalprice"), "last_day": ("max", "o_orderdate")},
        {"customers": "o_custkey", "days": "o_orderdate"})


@query
def q_rollup_levels(spark, sf_dir):
    """lineitem by ship year and month and return flag, rolled up, with mean quantity and distinct parts."""
    from .operators.levels import levels
    li = table(spark, sf_dir, "lineitem").withColumns({"year": F.year("l_shipdate"), "month": F.month("l_shipdate")})
    out = levels(li, ["year", "month", "l_returnflag"], {"n": ("count", "l_quantity"), "mean_qty": ("avg", "l_quantity")},
                 {"parts": "l_partkey"}, sets="rollup")
    return out.withColumn("mean_qty", F.round("mean_qty", 4))


def _shares(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return (li.where("l_quantity > 20").select("l_returnflag", F.nullif("l_linenumber", F.lit(7)).alias("line")),
            li.where("l_discount > 0.02").select("l_linestatus", F.nullif("l_linenumber", F.lit(7)).alias("line")))


@query
def q_intersect_all(spark, sf_dir):
    from .operators.bags import intersect_all
    return intersect_all(*_shares(spark, sf_dir))


@query
def q_except_all(spark, sf_dir):
    from .operators.bags import except_all
    return except_all(*_shares(spark, sf_dir))


@query
def q_not_in(spark, sf_dir):
    """Customers that are not among the buyers of large orders."""
    from .operators.bags import not_in
    large = table(spark, sf_dir, "orders").where("o_totalprice > 300000")
    return not_in(table(spark, sf_dir, "customer"), large, "c_custkey", "o_custkey").select("c_custkey", "c_name")


@query
def q_is_in(spark, sf_dir):
    from .operators.bags import is_in
    large = table(spark, sf_dir, "orders").where("o_totalprice > 300000")
    return is_in(table(spark, sf_dir, "customer"), large, "c_custkey", "o_custkey").select("c_custkey", "c_name")


@query
def q_sketch_rollup(spark, sf_dir):
    """Sketches of events by type and day, stored, then merged by type: exact numbers, and whether the estimates are near them
    (4 % of the count; 3 % of the rows about the median)."""
    from .operators.sketches import estimates, merge_parts, sketch_parts
    events = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    path = scratch_for(spark, "sketches")
    sketch_parts(events, ["event_type", "day"], distinct=["user_id", "props"], quantiles=["value"]).write.parquet(path)
    merged = estimates(merge_parts(spark.read.parquet(path), ["event_type"]), at=[0.5])
    near = events.join(merged.select("event_type", F.col("q_value")[0].alias("_q")), "event_type")
    exact = near.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("users"), F.countDistinct("props").alias("props"),
        (F.count_if(F.col("value") < F.col("_q")) / F.count("value")).alias("_below"),
        (F.count_if(F.col("value") <= F.col("_q")) / F.count("value")).alias("_upto"))
    both = exact.join(merged, "event_type")
    return both.select(
        "event_type", "n", "users", "props", (F.col("n") == F.col("n_rows")).alias("rows_equal"),
        (F.abs(F.col("n_distinct_user_id") - F.col("users")) <= 0.04 * F.col("users")).alias("users_near"),
        (F.abs(F.col("n_distinct_props") - F.col("props")) <= 0.04 * F.col("props")).alias("props_near"),
        ((F.col("_below") <= 0.53) & (F.col("_upto") >= 0.47)).alias("median_near"))
