"""Select-project-join-aggregate queries of the loader's documentation and tests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the three-way revenue query: segment and cut-off date.
SEGMENT = "BUILDING"
CUTOFF = "1995-03-15"


def spja_three_way(customer: DataFrame, orders: DataFrame, lineitem: DataFrame,
                   priority_col: str = "o_shippriority", segment: str = SEGMENT, cutoff: str = CUTOFF) -> DataFrame:
    """Revenue per order of one segment, ordered before and shipped after the cut-off.

    Filters are applied before the joins and reach the parquet scans;
    projections keep only the join keys and measures. The customer side is
    the small one after its segment filter; the planner broadcasts it when its
    statistics allow, else AQE does once the filtered size is known.
    """
    cutoff = F.lit(cutoff).cast("date")
    c = customer.where(F.col("c_mktsegment") == segment).select("c_custkey")
    o = orders.where(F.col("o_orderdate") < cutoff).select(
        "o_orderkey", "o_custkey", "o_orderdate", priority_col)
    l = lineitem.where(F.col("l_shipdate") > cutoff).select(
        "l_orderkey", "l_extendedprice", "l_discount")
    joined = (l.join(o, l.l_orderkey == o.o_orderkey)
               .join(c, o.o_custkey == c.c_custkey))
    return (joined.groupBy("l_orderkey", "o_orderdate", priority_col)
            .agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue")))
