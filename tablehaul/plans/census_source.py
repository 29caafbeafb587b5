"""A census-shaped table derived from ``orders`` by integer arithmetic.

The real census file is not available offline, so jobs and checks run on this
derivation of the shared ``orders`` table. Each raw census column is one SQL
expression that Spark and other SQL engines evaluate identically, which lets an
independent engine recompute every result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# raw census column -> SQL expression over orders (o_orderkey unique, o_custkey)
CENSUS_FROM_ORDERS = [
    ("resident_id_m", "o_orderkey"),
    ("approx_social_grade", "1 + o_orderkey % 4"),
    ("country_of_birth_3a", "1 + o_custkey % 3"),
    ("economic_activity_status_10m",
     "CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN -8 "
     "ELSE 1 + o_orderkey % 9 END"),
    ("ethnic_group_tb_6a", "1 + o_custkey % 6"),
    ("health_in_general", "1 + o_orderkey % 5"),
    ("hh_families_type_6a", "1 + (o_custkey + o_orderkey) % 6"),
    ("hours_per_week_worked", "1 + o_orderkey % 4"),
    ("in_full_time_education", "1 + o_orderkey % 2"),
    ("industry_10a", "1 + o_custkey % 10"),
    ("iol22cd", "'E0900000' || CAST(1 + o_custkey % 9 AS STRING)"),
    ("legal_partnership_status_6a", "1 + o_orderkey % 6"),
    ("occupation_10a", "1 + (o_custkey * 7 + o_orderkey) % 10"),
    ("region", "'E1200000' || CAST(1 + o_custkey % 9 AS STRING)"),
    ("religion_tb", "1 + o_custkey % 9"),
    ("residence_type", "CASE WHEN o_orderkey % 17 = 0 THEN 'C' ELSE 'H' END"),
    ("resident_age_7d", "1 + o_orderkey % 7"),
    ("sex", "1 + o_custkey % 2"),
    ("usual_short_student", "1 + o_orderkey % 2"),
]


def census_like_sql(table: str = "orders") -> str:
    """The derivation as one SELECT (used by oracles in other engines)."""
    cols = ",\n       ".join(f"{expr} AS {name}" for name, expr in CENSUS_FROM_ORDERS)
    return f"SELECT {cols}\nFROM {table}"


def census_like(orders: DataFrame) -> DataFrame:
    """Raw census-shaped columns computed from an ``orders`` DataFrame."""
    return orders.selectExpr(*[f"{expr} AS {name}" for name, expr in CENSUS_FROM_ORDERS])
