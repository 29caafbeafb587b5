"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

# A key is hot when it holds more than one row in HOT_SHARE; fewer than HOT_SHARE such keys can exist,
# which bounds the side that ``lookup`` broadcasts.
HOT_SHARE = 1000
# Hot rows are dealt over this many fillers, which match nothing.
HOT_SPREAD = 65536
# Rows of which a worker makes Python objects at once.
ROWS_AT_ONCE = 512

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", tag, unique=True)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)  # an empty table may have no file to take it from


def trim() -> None:
    """Give freed memory back to the system: glibc and Arrow keep it to themselves otherwise, while a worker waits for its next task."""
    pa.default_memory_pool().release_unused()
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if give_back:
        give_back(0)


def per_worker(key: Any, make: Callable[[], Any]) -> Any:
    """An object that a Python worker process keeps from task to task (functions travel by value, so a
    module's own globals would start anew with every task). It keeps one at a time: a stage with another
    key takes its place, and every stage in Python asks for one (``None`` will do), so the stages of a pipeline don't
    add up in memory."""
    kept = sys.modules.setdefault("_tablehaul_worker", types.ModuleType("_tablehaul_worker")).__dict__
    if kept.get("key") != key:
        kept["value"] = None  # the old one goes before the new one comes
        trim()
        kept["key"], kept["value"] = key, make()
    return kept["value"]


def small(batches: Iterator[pa.RecordBatch], rows: int = ROWS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """The rows of the batches, fewer at a time, so that a worker has few texts as Python objects at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only, whatever the locale."""
    return F.translate(c, UPPER, LOWER)


def text_of(df: DataFrame, column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def lookup(left: DataFrame, right: DataFrame, key: str, values: list[str], weight: str, total: int,
           spread: list[str]) -> DataFrame:
    """Left join that gives every row of ``left`` the ``values`` of its ``key`` in ``right``.

    ``right`` has one row per key and ``weight``, the rows of ``left`` with that key (``total`` in all).
    Hot keys (fewer than HOT_SHARE, by their weight) are broadcast; their rows, and rows without a key, go
    through the shuffled join with a filler beside the key that nothing matches, dealt by ``spread``, so no
    task gets a hot key's rows.
    """
    packed = right.select(F.col(key).alias("_rk"), F.struct(*values).alias("_rv"), F.col(weight).alias("_rw"))
    is_hot = F.col("_rw") * HOT_SHARE > F.lit(total)
    hot = packed.where(is_hot).select(F.col("_rk").alias("_hk"), F.col("_rv").alias("_hv"))
    rest = packed.where(~is_hot).select("_rk", "_rv", F.lit(0).cast("long").alias("_rf"))
    filler = F.pmod(F.xxhash64(*spread), F.lit(HOT_SPREAD)) + 1
    settled = F.col("_hk").isNotNull() | F.col(key).isNull()
    probe = (left.join(F.broadcast(hot), F.col(key) == F.col("_hk"), "left")
             .withColumn("_jf", F.when(settled, filler).otherwise(F.lit(0).cast("long"))))
    joined = probe.join(rest, (F.col(key) == F.col("_rk")) & (F.col("_jf") == F.col("_rf")), "left")
    found = F.coalesce(F.col("_hv"), F.col("_rv"))
    return joined.select(*[left[c] for c in left.columns if c not in values],
                         *[found[v].alias(v) for v in values])
