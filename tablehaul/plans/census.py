"""The census job: land, expand, load, publish, read back, filter."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..operators.census import (RANDOM_SEED, add_census_measures, census_project,
                                complex_filter, readback_filter, simple_filter)
from ..operators.setops import replicate
from ..session import scratch_path
from ..sinks import attach_if_incomplete, csv_sink, load_if_incomplete, loads_unchanged, parquet_sink, publish_if_absent
from ..sources.files import land_raw
from ..sources.fs import committed, delete_path, read_note, write_note
from ..sources.sql import CatalogSource, JdbcSource, check_identifier

# Fixed value: copies of the census table in the expanded dataset.
EXPAND_TIMES = 100
# The copies are written by tasks of about so many rows, and packed CSV files hold no more than CSV_FILE_ROWS.
TASK_ROWS = 2_000_000
CSV_FILE_ROWS = 10_000_000
# 100 equal lines in a row take as much room as 100 different ones in plain CSV, hardly more than one when packed.
CSV_CODEC = "gzip"


def census_expand_plan(raw: DataFrame, times: int = EXPAND_TIMES, seed: int = RANDOM_SEED,
                       method: str = "md5", partitions: int | None = None) -> DataFrame:
    """Project -> income/weight draws -> blank income of non-earners -> ``times`` copies.

    The draws are taken before replication, so the copies are exact duplicates. The plan is one narrow
    stage: scan, project, hash, generate. A raw input in too few splits is dealt over ``partitions`` first
    (only raw rows cross that exchange).
    """
    if partitions:
        raw = raw.repartition(partitions)
    return replicate(add_census_measures(census_project(raw), seed=seed, method=method), times)


def census_expand(raw: DataFrame, times: int = EXPAND_TIMES, seed: int = RANDOM_SEED,
                  parquet_path: str | None = None, csv_path: str | None = None,
                  method: str = "md5", max_records_per_file: int | None = None,
                  partitions: int | None = None) -> DataFrame:
    """Expanded census table; written to ``parquet_path`` (and CSV) unless already there.

    A copy counts as there when its write finished and the note beside it names the same ``times``,
    ``seed`` and ``method``; otherwise it is written anew. Each path is judged by itself. The CSV copy is
    packed (``CSV_CODEC``); Spark's CSV reader unpacks it. Where both are written, the measured rows are written once to a
    scratch folder, from which both are made, so that they agree whatever ``raw`` is; a CSV that is missing beside a finished
    parquet is made from that. Paths belong to one input: use
    another folder for another table. Unless ``partitions`` is given, the raw rows are counted and dealt over tasks of about
    ``TASK_ROWS`` copies: the raw table may be one small file, which is one task.
    """
    spark = raw.sparkSession
    if parquet_path is None:
        return census_expand_plan(raw, times, seed, method, partitions)
    made = {"times": times, "seed": seed, "method": method}

    def there(path: str) -> bool:
        return committed(spark, path) and read_note(spark, path) == made

    if there(parquet_path):
        if csv_path and not there(csv_path):
            csv_sink(spark.read.parquet(parquet_path), csv_path, compression=CSV_CODEC, max_records_per_file=CSV_FILE_ROWS)
            write_note(spark, csv_path, made)
        return spark.read.parquet(parquet_path)
    measured = add_census_measures(census_project(raw), seed=seed, method=method)
    once = scratch_path(spark, "census_expand", unique=True) if csv_path else None
    try:
        if once:
            measured = spark.read.parquet(parquet_sink(measured, once))
        if partitions is None:
            partitions = max(spark.sparkContext.defaultParallelism, -(-measured.count() * times // TASK_ROWS))
        measured = measured.repartition(partitions)
        parquet_sink(replicate(measured, times), parquet_path, max_records_per_file=max_records_per_file)
        write_note(spark, parquet_path, made)
        if csv_path:
            csv_sink(measured, csv_path, compression=CSV_CODEC, max_records_per_file=CSV_FILE_ROWS, times=times)
            write_note(spark, csv_path, made)
    finally:
        if once:
            delete_path(spark, once)
    return spark.read.parquet(parquet_path)


@dataclass
class CensusConfig:
    """Parameters of the census job (every path is a Hadoop path)."""

    raw_dir: str
    expanded_dir: str
    source_path: str | None = None        # CSV to land; or pass ``raw`` to run_census
    target: JdbcSource | CatalogSource | None = None
    table: str = "census"
    expected_rows: int | None = None      # default: times * raw rows
    drop_table: bool = False
    publish_path: str | None = None
    replace_published: bool = False
    load_from: tuple[str, ...] = ("target", "published")
    times: int = EXPAND_TIMES
    seed: int = RANDOM_SEED
    method: str = "md5"
    etl_only: bool = False
    write_csv: bool = True
    filter_on: str = "published"          # or "readback": filter the target's read-back subset
    partitions: int | None = None         # deal a raw input in few splits over so many first (None: by its rows)
    share_files: bool = True              # a catalog target without a path for the table gets the expanded files themselves


@dataclass
class CensusResult:
    raw: DataFrame
    expanded: DataFrame
    loaded: bool = False
    published: bool = False
    readback: DataFrame | None = None
    simple: DataFrame | None = None
    complex: DataFrame | None = None
    frames: dict = field(default_factory=dict)


def run_census(spark: SparkSession, cfg: CensusConfig, raw: DataFrame | None = None) -> CensusResult:
    """Land -> expand -> load table if incomplete -> publish if absent -> read back -> filter.

    Order: persist before load-back before filters. The read-back from the
    table target keeps the London / age-group-1 subset (pushed into the
    target); the filters run on the full published table when it is read, else
    on the expanded table.
    """
    if raw is None:
        if not cfg.source_path:
            raise ValueError("give raw or cfg.source_path")
        raw = land_raw(spark, cfg.source_path, cfg.raw_dir, preview=0)
    exp_dir = cfg.expanded_dir.rstrip("/")
    expanded = census_expand(raw, cfg.times, cfg.seed, f"{exp_dir}/census.parquet",
                             f"{exp_dir}/census.csv" if cfg.write_csv else None, cfg.method,
                             partitions=cfg.partitions)
    result = CensusResult(raw=raw, expanded=expanded)
    if cfg.target is not None:
        check_identifier(cfg.table)
        expected = cfg.expected_rows
        if expected is None:
            expected = cfg.times * raw.count()
        shared = cfg.share_files and isinstance(cfg.target, CatalogSource) and cfg.table not in cfg.target.tables
        if shared and loads_unchanged(expanded):
            result.loaded = attach_if_incomplete(spark, f"{exp_dir}/census.parquet", cfg.target, cfg.table, expected, cfg.drop_table)
        else:
            result.loaded = load_if_incomplete(expanded, cfg.target, cfg.table, expected, drop=cfg.drop_table)
    if cfg.publish_path:
        result.published = publish_if_absent(expanded, cfg.publish_path, cfg.replace_published, files=f"{exp_dir}/census.parquet")
    if cfg.etl_only:
        return result
    frame = expanded
    if cfg.target is not None and "target" in cfg.load_from:
        result.readback = readback_filter(cfg.target.table(spark, cfg.table))
        result.frames["target"] = result.readback
    if cfg.publish_path and "published" in cfg.load_from:
        frame = spark.read.parquet(cfg.publish_path)
        result.frames["published"] = frame
    if cfg.filter_on == "readback":
        if result.readback is None:
            raise ValueError("filter_on='readback' needs a table target read back")
        frame = result.readback
    result.simple = simple_filter(frame)
    result.complex = complex_filter(frame)
    return result
