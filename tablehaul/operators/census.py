"""Census-table projection, filters and synthetic measures (all Catalyst expressions)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the reference job: the 19 raw census columns it
# keeps and the short names it gives them, in the reference's order.
CENSUS_COLUMNS = [
    ("resident_id_m", "id"),
    ("approx_social_grade", "social"),
    ("country_of_birth_3a", "birth"),
    ("economic_activity_status_10m", "econ"),
    ("ethnic_group_tb_6a", "ethnic"),
    ("health_in_general", "health"),
    ("hh_families_type_6a", "fam_type"),
    ("hours_per_week_worked", "hours_worked"),
    ("in_full_time_education", "education"),
    ("industry_10a", "industry"),
    ("iol22cd", "london"),
    ("legal_partnership_status_6a", "mar_stat"),
    ("occupation_10a", "occupation"),
    ("region", "region"),
    ("religion_tb", "religion"),
    ("residence_type", "residence_type"),
    ("resident_age_7d", "age_group"),
    ("sex", "sex"),
    ("usual_short_student", "keep_type"),
]

# Economic-activity codes whose people get no income.
NO_INCOME_CODES = [-8, 5, 6, 7, 8, 9]

# Fixed values of the reference's synthetic measures: seed, inclusive ranges.
RANDOM_SEED = 1949
INCOME_RANGE = (10_000, 100_000)
WEIGHT_RANGE = (75, 125)

# Fixed filter values (region codes, age groups, usual-resident code).
LONDON = "E12000007"
NORTH_EAST = "E12000001"
NORTH_WEST = "E12000002"


def census_project(df: DataFrame) -> DataFrame:
    """Keep exactly the 19 census columns under their short names."""
    return df.select(*[F.col(raw).alias(short) for raw, short in CENSUS_COLUMNS])


def simple_filter(df: DataFrame) -> DataFrame:
    """Usual residents of London in age group 5 who have an income."""
    return df.where(
        (F.col("keep_type") == 1)
        & (F.col("region") == LONDON)
        & (F.col("age_group") == 5)
        & F.col("income").isNotNull()
    )


def complex_filter(df: DataFrame) -> DataFrame:
    """North East aged group >= 6, or North West age group <= 6 (both include 6)."""
    return df.where(
        ((F.col("region") == NORTH_EAST) & (F.col("age_group") >= 6))
        | ((F.col("region") == NORTH_WEST) & (F.col("age_group") <= 6))
    )


def blank_by_code(df: DataFrame, column: str = "income", code_col: str = "econ",
                  codes: Iterable[int] = NO_INCOME_CODES) -> DataFrame:
    """Set ``column`` to NULL where ``code_col`` is one of ``codes``.

    A NULL code keeps the value: ``NULL IN (...)`` is NULL, which falls to the
    ``otherwise`` branch.
    """
    return df.withColumn(
        column,
        F.when(F.col(code_col).isin(list(codes)), F.lit(None)).otherwise(F.col(column)),
    )


def random_int(key: Column | str, lo: int, hi: int, seed: int, name: str,
               method: str = "md5") -> Column:
    """Deterministic uniform integer in the inclusive range [lo, hi] drawn from ``key``.

    The draw is a keyed hash, so it does not depend on partitioning, task
    retries or row order. ``md5`` hashes the text ``key|seed|name`` and keeps 60
    bits, which any SQL engine with ``md5`` can recompute; ``xxhash64`` is the
    faster Spark-only variant.
    """
    if hi < lo:
        raise ValueError(f"empty range [{lo}, {hi}]")
    key = F.col(key) if isinstance(key, str) else key
    width = hi - lo + 1
    if method == "md5":
        text = F.concat_ws("|", key.cast("string"), F.lit(str(seed)), F.lit(name))
        bits = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
        draw = bits % F.lit(width)
    elif method == "xxhash64":
        draw = F.pmod(F.xxhash64(key, F.lit(seed), F.lit(name)), F.lit(width))
    else:
        raise ValueError(f"unknown method {method!r}")
    return (F.lit(lo) + draw).cast("bigint")


def add_random_int(df: DataFrame, name: str, lo: int, hi: int, key: str = "id",
                   seed: int = RANDOM_SEED, method: str = "md5") -> DataFrame:
    """Add column ``name`` with one reproducible draw in [lo, hi] per row key.

    Rows that share a key share the draw; pass a unique key for one draw per row.
    """
    return df.withColumn(name, random_int(key, lo, hi, seed, name, method))


def add_census_measures(df: DataFrame, key: str = "id", seed: int = RANDOM_SEED,
                        method: str = "md5") -> DataFrame:
    """``income`` and ``weight`` draws, then income blanked for non-earners."""
    df = add_random_int(df, "income", *INCOME_RANGE, key=key, seed=seed, method=method)
    df = add_random_int(df, "weight", *WEIGHT_RANGE, key=key, seed=seed, method=method)
    return blank_by_code(df)


# Fixed values of the database read-back: London residents aged 15 and under.
READBACK_REGION = LONDON
READBACK_AGE_GROUP = 1


def readback_filter(df: DataFrame) -> DataFrame:
    """``region = 'E12000007' AND age_group = 1`` — pushed into the scan (parquet
    ``PushedFilters``) or into the database's WHERE clause (JDBC)."""
    return df.where((F.col("region") == READBACK_REGION)
                    & (F.col("age_group") == READBACK_AGE_GROUP))
