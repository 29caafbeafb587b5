"""Headline benchmarks; prints ONE JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_REPS (default 3).
Each query: one warm-up, then the median of BENCH_REPS timed runs. Results are
materialised with the ``noop`` sink (full evaluation, nothing collected) or
written as parquet where writing is the operation.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tablehaul.session import get_session, scratch_path  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    spark = get_session(f"local[{cpus}]", app_name="tablehaul-bench",
                        shuffle_partitions=cpus, extra={"spark.driver.memory": "16g"})
    # written tables go under the session's spark.checkpoint.dir, a fresh folder per run
    scratch = scratch_path(spark, "bench", unique=True)

    from tablehaul.operators.census import complex_filter, simple_filter
    from tablehaul.plans.census import census_expand_plan
    from tablehaul.plans.census_source import census_like
    from tablehaul.plans.spja import spja_three_way
    from tablehaul.sources.sql import parquet_dir_source, read_sql

    def t(name):
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    src = parquet_dir_source(spark, sf_dir)
    expanded_path = f"{scratch}/large/census.parquet"

    def load(n):
        return lambda: noop(read_sql(spark, src, "SELECT * FROM lineitem",
                                     partition_on="l_orderkey", partition_num=n))

    def expand():
        # one file with one row group is one split: deal its rows out before they are multiplied
        census_expand_plan(census_like(t("orders")), partitions=cpus).write.mode("overwrite").parquet(expanded_path)

    def filters_parquet():
        exp = spark.read.parquet(expanded_path)
        noop(simple_filter(exp))
        noop(complex_filter(exp))

    def aggregate():
        noop(spja_three_way(t("customer"), t("orders"), t("lineitem"),
                            priority_col="o_orderpriority"))

    benches = {f"load_n{n}": load(n) for n in (1, 2, 4, 8)}
    benches["expand"] = expand
    benches["filter"] = filters_parquet
    benches["aggregate"] = aggregate
    from tablehaul.functions.normalize import normalize_table
    def normalise():
        # a wide table whose columns arrive with source types that all need a rule
        wide = t("lineitem").repartition(cpus).selectExpr(
            "l_orderkey", "CAST(l_linenumber AS SMALLINT) AS small_c",
            "CAST(l_discount AS FLOAT) AS real_c",
            "CAST(l_extendedprice AS DECIMAL(15,2)) AS num_c",
            "md5(CAST(l_orderkey AS STRING) || CAST(l_linenumber AS STRING)) AS uuid_c",
            "'{\"q\": ' || CAST(CAST(l_quantity AS BIGINT) AS STRING) || '}' AS json_c",
            "CASE l_returnflag WHEN 'R' THEN 't' WHEN 'A' THEN 'f' ELSE '' END AS bool_c",
            "'{' || CAST(l_partkey AS STRING) || ',NULL,' || CAST(l_suppkey AS STRING) || '}' AS arr_c",
            "date_format(l_shipdate, 'yyyy-MM-dd HH:mm:ss') || '+02' AS tstz_c")
        noop(normalize_table(wide, "postgres", "arrow", {
            "uuid_c": "uuid", "json_c": "jsonb", "bool_c": "bool", "arr_c": "_int8",
            "tstz_c": "timestamptz"}))

    benches["normalise"] = normalise

    from tablehaul.plans.census import CensusConfig, run_census
    from tablehaul.sources.sql import CatalogSource
    raw_csv = f"{scratch}/source/census.csv"
    census_like(t("orders")).write.mode("overwrite").csv(raw_csv, header=True)
    runs = iter(range(10**6))

    def pipeline():
        # the whole census job in a fresh folder each time (a re-run would skip every write)
        base = f"{scratch}/job{next(runs)}"
        target = CatalogSource(f"bench_target_{abs(hash(base)) % 10**8}", {})  # its table shares the expanded files
        res = run_census(spark, CensusConfig(
            raw_dir=f"{base}/raw", expanded_dir=f"{base}/large", source_path=raw_csv,
            target=target, table="census", publish_path=f"{base}/bucket/large/census.parquet",
            partitions=cpus))
        noop(res.simple)
        noop(res.complex)

    benches["pipeline"] = pipeline

    # The end-to-end job writes the expanded table three times; it is timed once,
    # after the other benches have warmed the JVM (BENCH_PIPELINE_REPS to change).
    rep_counts = {"pipeline": int(os.environ.get("BENCH_PIPELINE_REPS", "1"))}

    expand()  # the filter bench reads the expanded table
    results = {}
    for name, fn in benches.items():
        n_reps = rep_counts.get(name, reps)
        if name not in rep_counts:
            fn()  # warm-up
        times = []
        for _ in range(n_reps):
            t0 = time.perf_counter()
            fn()
            times.append(time.perf_counter() - t0)
        results[name] = round(statistics.median(times), 3)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({"metric": "total_median_sec", "value": round(sum(results.values()), 3),
                      "unit": "sec", "queries": results, "sf": sf, "cpus": cpus,
                      "reps": reps, "reps_override": rep_counts}))
    spark.stop()


if __name__ == "__main__":
    main()
