"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

Rows fall into source blocks by a hash. The matrix says how many rows of each block go to each shard: it
is drawn row by row from the multivariate hypergeometric law over the room left in the shards, so every
shard gets its exact size and every assignment of rows to shards is equally likely. Each block permutes
its rows (seeded hash order) and deals them out by the matrix; then they are exchanged, and each shard
permutes what it got. As blocks go by hash, not by where rows lie, a text crosses the network twice, once to its block and once to its
shard; in return the result doesn't depend on the partitioning.

Scale: the driver holds block and bin counts (at most MAX_BLOCKS rows) and the matrix, never rows. A shard
of any size is permuted in bins of about BLOCK_ROWS rows, numbered through by their counts, so no task
holds a shard.

Defined cases: the order depends on the seed, the id and the text alone, so retries and other
partitionings give the same result; identical rows are interchangeable. Null ids and null or empty texts
are rows like any other; an empty table gives an empty result; columns named like an added one are
replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 2000
MAX_BLOCKS = 65536


def draw_hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """Good ones among ``n`` drawn from ``good`` and ``bad``, by inversion around the mode (any size)."""
    low, high = max(0, n - bad), min(n, good)
    if low == high:
        return low
    total = good + bad
    mode = min(high, max(low, (n + 1) * (good + 1) // (total + 2)))
    sd = (n * (good / total) * (bad / total) * (total - n) / max(1, total - 1)) ** 0.5
    width = int(12 * sd) + 12  # beyond it lies less than 1e-30 of the mass
    low, high = max(low, mode - width), min(high, mode + width)
    up = np.arange(mode, high, dtype=np.float64)
    down = np.arange(mode, low, -1, dtype=np.float64)
    up = np.cumprod((good - up) * (n - up) / ((up + 1) * (bad - n + up + 1)))
    down = np.cumprod(down * (bad - n + down) / ((good - down + 1) * (n - down + 1)))
    mass = np.cumsum(np.concatenate([down[::-1], [1.0], up]))
    return low + int(np.searchsorted(mass, rng.random() * mass[-1], side="right").clip(0, high - low))


def communication_matrix(block_rows: list[int], shard_rows: list[int], seed: int) -> np.ndarray:
    """Rows of each block that go to each shard; the sums are exact."""
    rng = np.random.default_rng(seed)
    room = [int(x) for x in shard_rows]
    matrix = np.zeros((len(block_rows), len(room)), dtype=np.int64)
    for i, rows in enumerate(block_rows):
        left, elsewhere = int(rows), sum(room)
        for j, free in enumerate(room):
            elsewhere -= free
            got = draw_hypergeometric(rng, free, elsewhere, left)
            matrix[i, j] = got
            room[j] -= got
            left -= got
    return matrix


def shard_sizes(total: int, shards: int) -> list[int]:
    """Row counts at most one apart."""
    return [total // shards + (j < total % shards) for j in range(shards)]


def shuffle_into_shards(docs: DataFrame, shards: int, seed: int = 7) -> DataFrame:
    """``docs`` with shard (0 to shards - 1) and slot (gapless from 0 in its shard)."""
    spark = docs.sparkSession
    base = docs.drop("shard", "slot")
    draws = {f"_h{i}": F.xxhash64(F.lit(seed + i), F.col("doc_id"), F.col("text")) for i in range(3)}
    narrow = base.select("doc_id", "text").withColumns(draws).drop("text")
    total = base.select(F.lit(1)).count()
    blocks = min(MAX_BLOCKS, max(1, -(-total // BLOCK_ROWS)))
    bins = min(MAX_BLOCKS // shards or 1, max(1, -(-total // (shards * BLOCK_ROWS))))
    counted = dict(narrow.groupBy(F.pmod("_h0", F.lit(blocks)).cast("int").alias("b")).count().collect())  # <= MAX_BLOCKS
    sizes = [counted.get(b, 0) for b in range(blocks)]
    cuts = np.cumsum(communication_matrix(sizes, shard_sizes(total, shards), seed), axis=1)
    table = spark.createDataFrame([(b, [int(x) for x in row]) for b, row in enumerate(cuts)],
                                  "_block int, _cuts array<long>")

    def dealt(rows: DataFrame) -> DataFrame:
        """Permute each block and deal its rows out by the matrix."""
        order = Window.partitionBy("_block").orderBy("_h1", "_h2", "doc_id")
        at = F.row_number().over(order) - 1
        return (rows.withColumn("_block", F.pmod("_h0", F.lit(blocks)).cast("int"))
                .withColumn("_at", at)
                .join(F.broadcast(table), "_block")
                .withColumn("shard", F.size(F.filter("_cuts", lambda c: c <= F.col("_at"))))
                .withColumn("_bin", F.pmod("_h2", F.lit(bins)).cast("int"))
                .drop("_cuts", "_at", "_block"))

    in_bin = dealt(narrow).groupBy("shard", "_bin").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = in_bin.select("shard", "_bin", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = Window.partitionBy("shard", "_bin").orderBy("_h2", "_h1", "doc_id")
    return (dealt(base.withColumns(draws))
            .withColumn("_place", F.row_number().over(place) - 1)
            .join(F.broadcast(starts), ["shard", "_bin"])  # at most MAX_BLOCKS rows
            .withColumn("slot", F.col("_start") + F.col("_place"))
            .drop("_bin", "_start", "_place", "_h0", "_h1", "_h2"))
