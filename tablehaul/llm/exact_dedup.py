"""Exact dedup over an extendible-hash index on shared files. DataFrame functions only.

1. A first pass counts the rows under each 64-bit hash of the normalised text (narrow rows).
2. ``directory`` doubles the directory from the number of hashes under each prefix: a bucket over its capacity splits by one more
   hash bit, until it fits or the directory has MAX_DEPTH bits.
3. ``build_index`` routes the texts through the directory to their buckets; owner tasks take ranges of buckets and hashes, compare
   the bytes of texts with one hash, add up copies, and chain the different texts of a hash. Copies of a hot hash (more than a
   thousandth of the rows; fewer than 1,000 can exist) are added up where they are read before they are routed, so no owner gets
   them all. Each owner writes its range as Parquet to the shared folder; texts cross the network once.
4. Every row goes through the directory to its bucket and finds the chain of its hash there. A chain of one is its text, since
   the index holds every text; in a longer chain the bytes decide. Hot chains are broadcast, the rest is a shuffled join on narrow rows.

Equality is by bytes throughout; hashes only say where to look.

Defined cases: null text counts as empty, and empty texts are equal to each other. The row with the
largest doc_id of a group stays, null ids come last; rows that share the doc_id that stays share its
fate. An empty table gives an empty result. Other columns pass through; a column named like an added one
is replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import HOT_SHARE, ascii_lower, lookup, saved, text_of

BUCKET_CAPACITY = 65536
# Bits of the largest directory (a million buckets, 69 billion texts). What is over capacity then stays one bucket,
# which owner tasks still share by ranges of hashes.
MAX_DEPTH = 20
ADDED = ["keep_id", "group_size", "kept", "text_sha256"]


def hash_prefix(h: Column, depth: int) -> Column:
    """The leading ``depth`` bits of a 64-bit hash."""
    return F.shiftrightunsigned(h, 64 - depth).cast("int") if depth else F.lit(0)


def directory(counts: np.ndarray, capacity: int) -> list[tuple[int, int]]:
    """Directory doubling from the number of hashes under each prefix (a power of two of them): the buckets as
    (first prefix, local depth), in key order."""
    depth = int(counts.size).bit_length() - 1
    totals = np.concatenate([[0], np.cumsum(counts)])
    buckets, open_buckets = [], [(0, 0)]
    while open_buckets:
        split = []
        for start, local in open_buckets:
            width = 1 << (depth - local)
            if totals[start + width] - totals[start] <= capacity or local == depth:
                buckets.append((start, local))
            else:
                split += [(start, local + 1), (start + width // 2, local + 1)]
        open_buckets = split
    return sorted(buckets)


def text_hash(norm: Column, digest_chars: int) -> Column:
    """64 bits of the text; of the first ``digest_chars`` of its digest where tests ask for collisions."""
    return F.xxhash64(norm) if digest_chars == 64 else F.xxhash64(F.substring(F.sha2(norm, 256), 1, digest_chars))


def build_directory(hashes: DataFrame, capacity: int) -> DataFrame:
    """The directory as a table (_cell, _bucket) with its depth in ``_depth``: a row for each prefix of that many bits."""
    spark = hashes.sparkSession
    most = max(1, hashes.count() // max(1, capacity)).bit_length() + 4  # room for uneven prefixes
    bits = min(MAX_DEPTH, most)
    counts = np.zeros(1 << bits, dtype=np.int64)
    for r in hashes.groupBy(hash_prefix(F.col("_h"), bits).alias("p")).count().collect():  # at most 2**MAX_DEPTH rows
        counts[r["p"]] = r["count"]
    buckets = directory(counts, capacity)
    depth = max(local for _, local in buckets)  # global depth
    cells = []
    for number, (start, local) in enumerate(buckets):
        first = start >> (bits - depth)
        cells += [(cell, number, depth) for cell in range(first, first + (1 << (depth - local)))]
    return spark.createDataFrame(cells, "_cell int, _bucket int, _depth int")


def routed(rows: DataFrame, table: DataFrame) -> DataFrame:
    """``rows`` with the _bucket of their _h."""
    depth = table.agg(F.max("_depth")).first()[0]
    table = F.broadcast(table.drop("_depth"))  # at most 2**MAX_DEPTH narrow rows
    return rows.withColumn("_cell", hash_prefix(F.col("_h"), depth)).join(table, "_cell").drop("_cell")


def build_index(rows: DataFrame, hot: DataFrame, table: DataFrame) -> DataFrame:
    """The written index of rows (doc_id, _h, _norm): _bucket, _h, _chain (place in the chain of the hash), _length of the chain,
    keep_id, group_size, n_rows (of the chain), and _norm where the chain has several texts."""
    hot = F.broadcast(hot.select("_h"))  # fewer than HOT_SHARE hashes
    copies = rows.join(hot, "_h", "left_semi").groupBy("_h", "_norm").agg(F.max("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("_rows"))
    each = rows.join(hot, "_h", "left_anti").withColumn("_rows", F.lit(1).cast("long"))
    owned = routed(each.unionByName(copies), table).repartitionByRange("_bucket", "_h")
    texts = owned.groupBy("_bucket", "_h", "_norm").agg(F.max("doc_id").alias("keep_id"), F.sum("_rows").alias("group_size"))
    chain = Window.partitionBy("_bucket", "_h")
    texts = (texts.withColumn("_chain", F.row_number().over(chain.orderBy("_norm"))).withColumn("_length", F.count(F.lit(1)).over(chain))
             .withColumn("n_rows", F.sum("group_size").over(chain)))
    return saved(texts.withColumn("_norm", F.when(F.col("_length") > 1, F.col("_norm"))), "dedup-index")


def exact_groups(docs: DataFrame, capacity: int = BUCKET_CAPACITY, digest_chars: int = 64, carry: bool = False) -> DataFrame:
    """``docs`` with keep_id, group_size, kept and text_sha256 (of the normalised text).

    ``digest_chars`` shortens the digest that the hash is taken of (tests use it to force collisions).
    Without ``carry`` the text itself is left out, so that only narrow rows are shuffled.
    """
    base = docs.drop(*ADDED)
    keyed = base.withColumn("_norm", ascii_lower(text_of(docs)))
    keyed = keyed.withColumn("_h", text_hash(F.col("_norm"), digest_chars))
    hashes = saved(keyed.groupBy("_h").agg(F.count(F.lit(1)).alias("n")), "dedup-hashes")
    total = hashes.agg(F.sum("n")).first()[0] or 0
    table = build_directory(hashes, capacity)
    index = build_index(keyed.select("doc_id", "_h", "_norm"), hashes.where(F.col("n") * HOT_SHARE > total), table)

    rows = routed(keyed.withColumn("_sha", F.sha2("_norm", 256)), table).withColumn("_at", F.struct("_bucket", "_h"))
    rows = rows.drop("_bucket", "_h", *(() if carry else ("text",)))
    found = ["keep_id", "group_size"]
    placed = index.withColumn("_at", F.struct("_bucket", "_h"))
    chains = placed.where("_chain = 1").select("_at", *found, "_length", "n_rows")
    out = lookup(rows.drop("_norm"), chains, "_at", [*found, "_length"], "n_rows", total, ["doc_id"])
    several = placed.where("_length > 1")
    if not several.isEmpty():  # chains of several texts: the bytes decide
        torn = several.where("_chain = 1").select("_at")
        unclear = rows.join(torn, "_at", "left_semi").join(several.select("_at", "_norm", *found, "_length"), ["_at", "_norm"])
        out = out.where("_length = 1").unionByName(unclear.drop("_norm"))
    return (out.withColumnRenamed("_sha", "text_sha256").drop("_at", "_length")
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id"))))


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns."""
    return exact_groups(docs, carry=True).where("kept").select(*docs.columns)
