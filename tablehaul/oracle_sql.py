"""Independent SQL statements (DuckDB dialect) that recompute each registered query.

They read the same parquet tables as plain views and are used only to check
results; nothing in the library executes them. Columns, codes, ranges, seeds and
texts are spelled out here, not imported from the code they check.
"""

from __future__ import annotations

TIMES = 100
PARTS = 4

# The census job's columns: short name, raw name, and how the stand-in for the census file derives it.
CENSUS = """
id             | resident_id_m                | o_orderkey
social         | approx_social_grade          | 1 + o_orderkey % 4
birth          | country_of_birth_3a          | 1 + o_custkey % 3
econ           | economic_activity_status_10m | CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN -8 ELSE 1 + o_orderkey % 9 END
ethnic         | ethnic_group_tb_6a           | 1 + o_custkey % 6
health         | health_in_general            | 1 + o_orderkey % 5
fam_type       | hh_families_type_6a          | 1 + (o_custkey + o_orderkey) % 6
hours_worked   | hours_per_week_worked        | 1 + o_orderkey % 4
education      | in_full_time_education       | 1 + o_orderkey % 2
industry       | industry_10a                 | 1 + o_custkey % 10
london         | iol22cd                      | 'E0900000' || CAST(1 + o_custkey % 9 AS VARCHAR)
mar_stat       | legal_partnership_status_6a  | 1 + o_orderkey % 6
occupation     | occupation_10a               | 1 + (o_custkey * 7 + o_orderkey) % 10
region         | region                       | 'E1200000' || CAST(1 + o_custkey % 9 AS VARCHAR)
religion       | religion_tb                  | 1 + o_custkey % 9
residence_type | residence_type               | CASE WHEN o_orderkey % 17 = 0 THEN 'C' ELSE 'H' END
age_group      | resident_age_7d              | 1 + o_orderkey % 7
sex            | sex                          | 1 + o_custkey % 2
keep_type      | usual_short_student          | 1 + o_orderkey % 2
"""
_COLUMNS = [[x.strip() for x in line.split("|", 2)] for line in CENSUS.strip().splitlines()]
SHORTS = ", ".join(short for short, _, _ in _COLUMNS)


def census_raw_sql() -> str:
    return "SELECT " + ", ".join(f"{sql} AS {raw}" for _, raw, sql in _COLUMNS) + " FROM orders"


def census_projected_sql() -> str:
    return "SELECT " + ", ".join(f"{sql} AS {short}" for short, _, sql in _COLUMNS) + " FROM orders"


def census_measured_sql(blank: bool = True) -> str:
    def draw(name: str, lo: int, width: int) -> str:
        digits = f"substr(md5(CAST(id AS VARCHAR) || '|1949|{name}'), 1, 15)"
        return f"({lo} + ('0x' || {digits})::BIGINT % {width})"

    income = draw("income", 10000, 90001)
    if blank:
        income = f"CASE WHEN econ IN (-8, 5, 6, 7, 8, 9) THEN NULL ELSE {income} END"
    return f"SELECT {SHORTS}, {income} AS income, {draw('weight', 75, 51)} AS weight FROM ({census_projected_sql()}) p"


def census_expanded_sql() -> str:
    return f"SELECT m.* FROM ({census_measured_sql()}) m, range({TIMES}) copies"


SIMPLE_WHERE = "keep_type = 1 AND region = 'E12000007' AND age_group = 5 AND income IS NOT NULL"
COMPLEX_WHERE = ("(region = 'E12000001' AND age_group >= 6) OR "
                 "(region = 'E12000002' AND age_group <= 6)")
READBACK_WHERE = "region = 'E12000007' AND age_group = 1"


ORACLES: dict[str, str] = {}


def _census_oracles():
    ORACLES["census_project"] = census_projected_sql()
    ORACLES["add_random_int"] = census_measured_sql(blank=False)
    ORACLES["blank_by_code"] = census_measured_sql(blank=True)
    ORACLES["simple_filter"] = f"SELECT * FROM ({census_expanded_sql()}) e WHERE {SIMPLE_WHERE}"
    ORACLES["complex_filter"] = f"SELECT * FROM ({census_expanded_sql()}) e WHERE {COMPLEX_WHERE}"
    ORACLES["replicate"] = f"SELECT o.* FROM orders o, range({TIMES}) copies"
    ORACLES["census_expand"] = f"SELECT {SHORTS}, income, weight FROM ({census_expanded_sql()}) e"


_census_oracles()


def _range_parts_sql(base: str, column: str, n: int) -> str:
    """Rows of ``base`` inside the range rule's bounds with their part index."""
    return (f"WITH base AS ({base}), "
            f"b AS (SELECT COALESCE(CAST(FLOOR(MIN({column})) AS BIGINT), 0) AS lo, "
            f"COALESCE(CAST(FLOOR(MAX({column})) AS BIGINT), 0) AS hi FROM base), "
            f"s AS (SELECT lo, hi, (hi - lo + 1) // {n} AS size FROM b) "
            f"SELECT base.*, CAST(CASE WHEN size = 0 THEN {n - 1} "
            f"ELSE LEAST(FLOOR(({column} - lo) / size), {n - 1}) END AS INTEGER) AS part "
            f"FROM base, s WHERE {column} >= lo AND {column} < hi + 1")


# NULL and NaN rows belong to no part, so the check leaves them out from the start.
FRACTIONAL = ("SELECT l_orderkey, l_linenumber, l_extendedprice - 20000.25 AS x FROM lineitem "
              "WHERE l_linenumber NOT IN (5, 6)")
REVENUE = """
SELECT l_orderkey, o_orderdate, o_orderpriority, ROUND(SUM(l_extendedprice * (1 - l_discount)), 2) AS revenue
FROM lineitem, orders, customer
WHERE l_orderkey = o_orderkey AND o_custkey = c_custkey AND c_mktsegment = 'BUILDING'
  AND o_orderdate < TIMESTAMP '1995-03-15' AND l_shipdate > TIMESTAMP '1995-03-15' GROUP BY 1, 2, 3"""


def _query_oracles():
    ORACLES["read_sql"] = "SELECT * FROM lineitem"
    ORACLES["read_sql_list"] = "SELECT * FROM orders WHERE o_orderstatus IS NOT NULL"
    ORACLES["read_sql_partitioned"] = _range_parts_sql(
        "SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem WHERE l_quantity > 10", "l_orderkey", PARTS)
    ORACLES["read_sql_prepared"] = ("SELECT l_orderkey, l_linenumber, o_totalprice FROM lineitem, orders "
                                    "WHERE o_orderkey = l_orderkey AND o_totalprice > 150000")
    ORACLES["parquet_scan"] = "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'"
    ORACLES["filtered_table_scan"] = f"SELECT * FROM ({census_measured_sql()}) m WHERE {READBACK_WHERE}"
    ORACLES["range_predicate"] = (
        f"SELECT *, 1 AS n_parts FROM ({_range_parts_sql('SELECT * FROM lineitem', 'l_orderkey', PARTS)}) q")
    ORACLES["partition_assign"] = _range_parts_sql(FRACTIONAL, "x", PARTS)
    ORACLES["in_list_cast"] = ("SELECT o_custkey::INTEGER AS custkey, o_orderkey FROM orders "
                               "WHERE o_orderpriority = '1-URGENT' OR o_orderpriority = '2-HIGH'")
    ORACLES["partition_bounds"] = "SELECT min(l_orderkey) AS min, max(l_orderkey) AS max FROM lineitem"
    ORACLES["partition_counts"] = (
        f"SELECT CAST(p.range AS INTEGER) AS part, COALESCE(c.n, 0) AS n FROM range({PARTS}) p "
        f"LEFT JOIN (SELECT part, COUNT(*) AS n FROM "
        f"({_range_parts_sql('SELECT l_orderkey FROM lineitem', 'l_orderkey', PARTS)}) x "
        f"GROUP BY part) c ON p.range = c.part")
    ORACLES["cross_source_equi_join"] = "SELECT * FROM nation n, region r WHERE n.n_regionkey = r.r_regionkey"
    ORACLES["federated_sql"] = ("SELECT s_suppkey, s_name, (SELECT n_name FROM nation WHERE n_nationkey = s_nationkey) "
                                "AS nation FROM supplier")
    ORACLES["spja_three_way"] = REVENUE
    ORACLES["spja_revenue"] = REVENUE.replace("BUILDING", "MACHINERY").replace("1995-03-15", "1994-07-01")
    ORACLES["count_rows"] = "SELECT COUNT(*) AS n FROM lineitem WHERE l_shipdate > TIMESTAMP '1995-03-15'"
    ORACLES["min_max"] = (
        "SELECT COALESCE(CAST(FLOOR(MIN(l_extendedprice)) AS BIGINT), 0) AS min, "
        "COALESCE(CAST(FLOOR(MAX(l_extendedprice)) AS BIGINT), 0) AS max FROM lineitem")
    ORACLES["group_sum"] = (
        "SELECT CASE WHEN l_returnflag = 'R' THEN TRUE WHEN l_returnflag = 'A' THEN FALSE END "
        "AS flag, ROUND(SUM(l_quantity), 2) AS sum_qty FROM lineitem GROUP BY 1")
    ORACLES["fed_group_agg"] = (
        "SELECT o_orderstatus, COUNT(l_discount) AS n_lines, ROUND(AVG(l_extendedprice), 2) AS mean_price, "
        "SUM(l_quantity) AS quantity FROM lineitem, orders WHERE l_orderkey = o_orderkey GROUP BY o_orderstatus")
    ORACLES["head"] = f"SELECT * FROM ({census_expanded_sql()}) e ORDER BY id LIMIT 5"
    ORACLES["page"] = (f"SELECT * FROM ({census_expanded_sql()}) e ORDER BY id "
                       f"LIMIT 100000 OFFSET 100000")
    ORACLES["limit_then_partition"] = _range_parts_sql(
        "SELECT l_orderkey, l_linenumber, l_extendedprice - 20000.25 AS x FROM "
        "(SELECT * FROM lineitem ORDER BY l_orderkey, l_linenumber LIMIT 1000) l "
        "WHERE l_linenumber NOT IN (5, 6)", "x", 3)
    ORACLES["order_by"] = "SELECT o_orderkey, o_totalprice, o_orderdate FROM orders"
    ORACLES["sql_scalar_udf"] = "SELECT o_orderkey, o_custkey + 1 AS next_custkey FROM orders"
    ORACLES["federated_pushdown"] = (
        "SELECT c_mktsegment, ROUND(SUM(l_extendedprice), 2) AS revenue, COUNT(*) AS n_lines "
        "FROM lineitem, orders, customer WHERE l_orderkey = o_orderkey AND o_custkey = c_custkey "
        "GROUP BY c_mktsegment")
    ORACLES["union_parts"] = ("SELECT c_custkey AS key, c_name AS name FROM customer UNION ALL "
                              "SELECT s_suppkey, s_name FROM supplier, range(2)")


_query_oracles()


def _sink_oracles():
    ORACLES["csv_scan"] = census_raw_sql()
    ORACLES["land_raw"] = census_raw_sql()
    ORACLES["csv_multi_scan"] = ("SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS "
                                 "c_nationkey, c_acctbal, c_mktsegment FROM customer")
    ORACLES["csv_infer"] = " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, '{kind}' AS data_type, false AS nullable, COUNT(*) AS n_values, "
        f"COUNT(DISTINCT {name}) AS n_distinct FROM customer"
        for name, kind in (("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "bigint"),
                           ("c_acctbal", "double"), ("c_mktsegment", "string")))
    measured = census_measured_sql()
    ORACLES["parquet_sink"] = measured
    ORACLES["publish_if_absent"] = measured
    ORACLES["load_if_incomplete"] = measured
    ORACLES["csv_sink"] = "SELECT * FROM orders"
    ORACLES["bulk_table_sink"] = (
        "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
        "CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority FROM orders")
    ORACLES["arrow_batches"] = "SELECT * FROM lineitem"
    expanded = census_expanded_sql()
    ORACLES["census_pipeline"] = f"SELECT * FROM ({expanded}) e WHERE {SIMPLE_WHERE}"
    ORACLES["census_etl_only"] = ORACLES["census_expand"]
    ORACLES["census_filter_readback"] = (
        f"SELECT * FROM ({expanded}) e WHERE ({READBACK_WHERE}) AND ({SIMPLE_WHERE})")
    ORACLES["census_readback"] = f"SELECT * FROM ({expanded}) e WHERE {READBACK_WHERE}"


_sink_oracles()


def _norm_oracles():
    k2 = "l_orderkey, l_linenumber"
    ORACLES["norm_int_widen"] = ("SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS c_small, "
                                 "CAST(l_linenumber AS BIGINT) AS c_int, "
                                 "CAST(l_linenumber AS SMALLINT) AS pg_small, "
                                 "CAST(l_linenumber AS BIGINT) AS bq_int FROM lineitem")
    ORACLES["norm_u64_double"] = (f"SELECT {k2}, CAST(l_orderkey * 1000003 AS DOUBLE) AS u64, "
                                  f"CAST(l_linenumber AS BIGINT) AS u32 FROM lineitem")
    ORACLES["norm_float_widen"] = (f"SELECT {k2}, CAST(CAST(l_discount AS FLOAT) AS DOUBLE) AS f32, "
                                   f"CAST(l_discount AS FLOAT) AS pg_f32, CAST(CAST(CAST(l_discount AS FLOAT) AS VARCHAR) AS DOUBLE) "
                                   f"AS ora_f32, l_extendedprice AS ora_f64 FROM lineitem")
    ORACLES["norm_decimal"] = (
        f"SELECT {k2}, CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS DECIMAL(38,10)) AS pg_dec, "
        f"CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS DOUBLE) AS my_dec, "
        f"CAST(CAST(l_quantity AS DECIMAL(10,0)) AS BIGINT) AS num0, "
        f"CAST(CAST(l_quantity AS DECIMAL(10,0)) AS BIGINT) AS num10, l_extendedprice AS bq_big FROM lineitem")
    ORACLES["norm_tinyint_bool"] = (f"SELECT {k2}, (l_linenumber % 2) <> 0 AS flag, "
                                    f"CAST(l_linenumber % 2 AS BIGINT) AS flag_pd FROM lineitem")
    spelled = "regexp_replace(md5(l_orderkey::VARCHAR || '-' || l_linenumber::VARCHAR), '^(.{8})(.{4})(.{4})(.{4})', '\\1-\\2-\\3-\\4-')"
    ORACLES["norm_uuid"] = f"SELECT {k2}, {spelled} AS u, {spelled} AS ms_u FROM lineitem"
    ORACLES["norm_json"] = (
        f"SELECT {k2}, '{{\"flag\":\"' || l_returnflag || '\",\"line\":' || "
        f"CAST(l_linenumber AS VARCHAR) || ',\"qty\":' || "
        f"CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '}}' AS doc, "
        f"'{{\"a\": 1, \"a\": ' || l_linenumber::VARCHAR || '}}' AS twice FROM lineitem")
    ORACLES["norm_hstore"] = (
        f"SELECT {k2}, '{{\"flag\":\"' || l_returnflag || '\",\"status\":' || CASE WHEN "
        f"l_linestatus = 'O' THEN 'null' ELSE '\"' || l_linestatus || '\"' END || '}}' AS kv "
        f"FROM lineitem")
    ORACLES["norm_inet"] = (f"SELECT {k2}, '10.' || CAST(l_orderkey % 256 AS VARCHAR) || '.' || "
                            f"CAST(l_linenumber AS VARCHAR) || '.0/24' AS net FROM lineitem")
    ORACLES["norm_textlike"] = (f"SELECT {k2}, rpad(l_returnflag, 5, ' ') AS code, "
                                f"l_linestatus AS status FROM lineitem")
    s = "((l_orderkey * 37 + l_linenumber * 1013) % 86400)"
    spoken = (f"lpad(CAST({s} // 3600 AS VARCHAR), 2, '0') || ':' || "
              f"lpad(CAST(({s} // 60) % 60 AS VARCHAR), 2, '0') || ':' || "
              f"lpad(CAST({s} % 60 AS VARCHAR), 2, '0') || "
              f"CASE WHEN l_linenumber % 3 = 0 THEN '.062547' ELSE '' END")
    ORACLES["norm_time"] = f"SELECT {k2}, {spoken} AS t, {spoken} AS typed FROM lineitem"
    ORACLES["norm_timestamp"] = (
        "SELECT o_orderkey, o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) - "
        "to_hours(CASE WHEN o_orderkey % 3 = 0 THEN 8 WHEN o_orderkey % 3 = 1 THEN -4 ELSE 0 END) "
        "AS tstz, o_orderdate AS ts, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS d FROM orders")
    shifted = ("o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) + CASE WHEN o_orderkey % 2 = 0 THEN "
               "INTERVAL 500 MILLISECOND ELSE INTERVAL 0 SECOND END")
    later = "o_orderdate + INTERVAL 3 HOUR + INTERVAL 4 MINUTE + INTERVAL 5 SECOND"
    ORACLES["norm_text_temporal"] = (
        f"SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d_txt, {shifted} AS ts_txt, o_orderdate AS dt_txt, "
        f"{shifted} AS ts3_txt, {shifted} AS dt6_txt, {later} AS ora_txt, {later} AS ora_date FROM orders")
    ORACLES["norm_text_blob"] = (f"SELECT {k2}, l_returnflag || l_linestatus AS txt_blob, "
                                 f"CAST(l_returnflag AS BLOB) AS raw_blob FROM lineitem")
    ORACLES["norm_infinity"] = (
        f"SELECT {k2}, CASE WHEN l_linenumber = 1 THEN DATE '9999-12-31' WHEN l_linenumber = 2 "
        f"THEN DATE '0001-01-01' ELSE CAST(l_shipdate AS DATE) END AS d_txt, "
        f"CASE WHEN l_linenumber = 1 THEN TIMESTAMP '9999-12-31 23:59:59.999999' "
        f"WHEN l_linenumber = 2 THEN TIMESTAMP '0001-01-01 00:00:00' ELSE l_shipdate END AS ts_txt "
        f"FROM lineitem")
    arr = ("CASE WHEN l_linenumber = 1 THEN []::BIGINT[] WHEN l_linenumber = 7 THEN NULL "
           "ELSE [l_partkey, CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_suppkey END, "
           "CAST(l_linenumber AS BIGINT)]::BIGINT[] END")
    ORACLES["norm_array_text"] = (f"SELECT {k2}, {arr} AS arr, [l_returnflag || ',x', 'plain', NULL, 'NULL'] AS words, "
                                  f"[CAST(l_shipdate AS DATE)] AS days FROM lineitem")
    ORACLES["norm_array_no_null"] = (
        f"SELECT {k2}, {arr} AS arr, CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linenumber = 1 "
        f"THEN false ELSE l_linenumber % 3 = 0 END AS has_null FROM lineitem")
    flag = "CASE l_returnflag WHEN 'R' THEN true WHEN 'A' THEN false END"
    ORACLES["norm_bool_text"] = (f"SELECT {k2}, {flag} AS b, {flag} AS tr, {flag} AS bq, {flag} AS ms, "
                                 f"l_returnflag = 'R' AS ms_typed FROM lineitem")
    ORACLES["norm_empty_null"] = (f"SELECT {k2}, CASE WHEN l_linestatus = 'O' THEN NULL ELSE "
                                  f"l_returnflag END AS v FROM lineitem")
    ORACLES["norm_bytes"] = (f"SELECT {k2}, unhex(substr(md5(CAST(l_orderkey AS VARCHAR)), 1, 8)) "
                             f"AS by FROM lineitem")
    dense = ", ".join(f"CASE WHEN l_linenumber = {i} THEN CAST(l_quantity AS FLOAT) "
                      f"ELSE CAST(0 AS FLOAT) END" for i in range(1, 8))
    ORACLES["norm_vector"] = (
        f"SELECT {k2}, [{dense}] AS sv, unhex(printf('%02x%02x', (l_partkey % 1024) >> 2, "
        f"((l_partkey % 1024) & 3) << 6)) AS bits FROM lineitem")
    ORACLES["normalize_table"] = ("SELECT vec_id, CAST(embedding AS DOUBLE[]) AS embedding, "
                                  "CAST(label AS BIGINT) AS label FROM embeddings")
    ORACLES["resolve_dynamic"] = ("SELECT o_orderkey AS a, o_totalprice AS b, o_orderpriority AS c, "
                                  "o_custkey AS d, o_orderstatus = 'F' AS e, CAST(o_orderdate AS DATE) AS f, o_orderdate AS g FROM orders")


_norm_oracles()


def _time_oracles():
    ORACLES["page_index"] = """
WITH numbered AS (SELECT row_number() OVER (ORDER BY l_extendedprice, l_orderkey, l_linenumber) - 1 AS row_no, l_extendedprice,
  l_orderkey, l_linenumber, l_shipdate FROM lineitem),
size AS (SELECT (count(*) - 1) // 1000 AS last FROM lineitem)
SELECT numbered.* FROM numbered, size WHERE row_no // 1000 IN (0, last // 2, last)"""
    ORACLES["ledger_load"] = "SELECT * FROM orders"
    ORACLES["asof_join"] = """
SELECT p.event_id, p.user_id, p.ts, p.value, CASE WHEN near THEN v.event_id END AS event_id_seen, CASE WHEN near THEN v.ts END AS ts_seen,
  CASE WHEN near THEN v.value END AS value_seen
FROM (SELECT p.*, v.event_id AS seen, p.ts - v.ts <= INTERVAL 1 DAY AS near
  FROM (SELECT * FROM events WHERE event_type = 'purchase') p
  ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v ON p.user_id = v.user_id AND p.ts >= v.ts) p
LEFT JOIN events v ON v.event_id = p.seen"""
    ORACLES["asof_join_forward"] = """
SELECT event_id, ts, event_id_next, ts_next, event_type FROM (
  SELECT event_id, ts, event_type AS kind, lead(event_id) OVER w AS event_id_next, lead(ts) OVER w AS ts_next,
    lead(event_type) OVER w AS event_type
  FROM events WINDOW w AS (ORDER BY ts, event_id)) WHERE kind = 'error'"""
    ORACLES["range_join"] = """
SELECT c.event_id, c.user_id, c.ts, p.event_id AS event_id_purchase, p.ts AS begins, p.ts + to_minutes(10 * trunc(p.value)::INT) AS ends
FROM events c, events p WHERE c.event_type = 'click' AND p.event_type = 'purchase' AND c.user_id = p.user_id
  AND p.ts <= c.ts AND c.ts < p.ts + to_minutes(10 * trunc(p.value)::INT)"""
    ORACLES["interval_join"] = """
WITH spells AS (SELECT *, ts + to_seconds(trunc(value)::INT) AS ends FROM events)
SELECT a.event_id, a.user_id, a.ts AS begins, a.ends, b.event_id AS event_id_signup, b.user_id AS user_id_signup,
  b.ts AS begins_signup, b.ends AS ends_signup
FROM spells a JOIN spells b ON a.ts < b.ends AND b.ts < a.ends
WHERE a.event_type = 'error' AND b.event_type = 'signup' AND a.ts < a.ends AND b.ts < b.ends"""
    tumbling = """
SELECT time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') AS window_start,
  time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') + INTERVAL 6 HOUR AS window_end, event_type, count(*) AS n_events,
  count(value) AS n_values, max(value) AS most FROM events WHERE ts IS NOT NULL GROUP BY ALL"""
    passed = "(SELECT date_trunc('millisecond', max(ts)) - INTERVAL 30 MINUTE FROM events)"
    ORACLES["event_windows_batch"] = tumbling
    ORACLES["event_windows"] = f"SELECT * FROM ({tumbling}) WHERE window_end <= {passed}"
    ORACLES["event_windows_sliding"] = f"""
SELECT window_start, window_start + INTERVAL 24 HOUR AS window_end, count(*) AS n_events, count(value) AS n_values, max(value) AS most
FROM (SELECT value, time_bucket(INTERVAL 8 HOUR, ts, TIMESTAMP '1970-01-01') - INTERVAL 8 HOUR * i AS window_start
  FROM events, range(3) r(i) WHERE ts IS NOT NULL)
GROUP BY ALL HAVING window_end <= {passed}"""
    sessions = """
SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n_events, round(sum(value), 2) AS total
FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS no
  FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 2 DAY THEN 0 ELSE 1 END AS fresh
    FROM events WHERE ts IS NOT NULL))
GROUP BY user_id, no"""
    ORACLES["event_sessions"] = sessions
    ORACLES["event_sessions_stream"] = f"SELECT * FROM ({sessions}) WHERE session_end + INTERVAL 2 DAY < {passed}"


_time_oracles()


def _frame_oracles():
    ORACLES["running_frames"] = """
SELECT l_returnflag, l_shipdate, l_orderkey, l_linenumber, l_quantity, rank() OVER d AS day_rank, dense_rank() OVER d AS day_no,
  row_number() OVER w AS row_no, sum(l_quantity) OVER w AS sum_qty, max(l_quantity) OVER w AS most_qty,
  min(l_quantity) OVER w AS least_qty, count(l_quantity) OVER w AS n_qty
FROM lineitem WINDOW d AS (PARTITION BY l_returnflag ORDER BY l_shipdate NULLS FIRST),
  w AS (PARTITION BY l_returnflag ORDER BY l_shipdate NULLS FIRST, l_orderkey NULLS FIRST, l_linenumber NULLS FIRST ROWS UNBOUNDED PRECEDING)"""
    ORACLES["running_desc"] = """
SELECT o_orderstatus, o_orderkey, cents, row_number() OVER w AS place, avg(cents) OVER w AS mean
FROM (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders)
WINDOW w AS (PARTITION BY o_orderstatus ORDER BY cents DESC NULLS LAST, o_orderkey NULLS FIRST ROWS UNBOUNDED PRECEDING)"""
    ORACLES["cube_levels"] = """
SELECT status, o_orderpriority, CAST(year AS INTEGER) AS year, grouping_id(status, o_orderpriority, year) AS grouping_id, count(*) AS n,
  min(o_totalprice) AS least, max(o_totalprice) AS most, max(o_orderdate) AS last_day, count(DISTINCT o_custkey) AS customers,
  count(DISTINCT o_orderdate) AS days
FROM (SELECT *, nullif(o_orderstatus, 'P') AS status, year(o_orderdate) AS year FROM orders)
GROUP BY CUBE (status, o_orderpriority, year)"""
    ORACLES["rollup_levels"] = """
SELECT CAST(year AS INTEGER) AS year, CAST(month AS INTEGER) AS month, l_returnflag, grouping_id(year, month, l_returnflag) AS grouping_id,
  count(l_quantity) AS n, round(avg(l_quantity), 4) AS mean_qty, count(DISTINCT l_partkey) AS parts
FROM (SELECT *, year(l_shipdate) AS year, month(l_shipdate) AS month FROM lineitem) GROUP BY ROLLUP (year, month, l_returnflag)"""
    shares = ("SELECT l_returnflag, nullif(l_linenumber, 7) AS line FROM lineitem WHERE l_quantity > 20",
              "SELECT l_linestatus, nullif(l_linenumber, 7) AS line FROM lineitem WHERE l_discount > 0.02")
    ORACLES["intersect_all"] = " INTERSECT ALL ".join(shares)
    ORACLES["except_all"] = " EXCEPT ALL ".join(shares)
    large = "(SELECT o_custkey FROM orders WHERE o_totalprice > 300000)"
    ORACLES["not_in"] = f"SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN {large}"
    ORACLES["is_in"] = f"SELECT c_custkey, c_name FROM customer WHERE c_custkey IN {large}"
    ORACLES["sketch_rollup"] = """
SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users, count(DISTINCT props) AS props, true AS rows_equal, true AS users_near,
  true AS props_near, true AS median_near FROM events GROUP BY event_type"""


_frame_oracles()
