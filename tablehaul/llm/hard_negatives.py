"""Hard-negative mining by inner product, with LEMP-style coordinate pruning.

``build_index`` writes the rows as blocks to the shared folder. Rows are ordered by label and length (range
partitions; a number of the row breaks ties, so equal rows are dealt out), and each block is a length bucket: up to
BLOCK rows, its greatest length, and a sorted list per coordinate of the unit vectors (``places``: the rows of the
block by that coordinate).

The anchors are the stated query set. They are dealt by hash into blocks of about ANCHORS, and every block is one
pass over the index for its positives and one for its negatives. What the driver and a broadcast hold is one block
of anchors (a fixed size), never all of them. A pass with an anchor's threshold t on a score, in a bucket of greatest
length l:

1. t / (|anchor| * l) over 1: the bucket is left out (length pruning). At 0 or below: every row is a candidate.
2. Otherwise, for the anchor's FOCUS largest unit coordinates, the feasible range of a row's unit coordinate follows
   from that cosine bound; a binary search turns it into a piece of the sorted list, and the pieces are intersected.
3. The candidates that are left get their exact integer score. An anchor whose smallest piece still has more than
   DENSE of the bucket gets the scores of the whole bucket instead (more rows are verified, none fewer).

Thresholds are those of the task's own best rows so far, for negatives at least ``low`` of the positive's score. A task
hands on at most ``positives`` rows an anchor, or ``negatives`` a positive; a window over those ends the search.

Defined cases: rows with a null label or vector, or with a null, NaN or infinite component, take no part. A row with a
null id takes part and comes last among ties. Every row is a row of its own, also when repeated: a copy of an anchor can
be its positive, each copy of an anchor is an anchor. Vectors of different lengths: missing components are 0. An anchor
or a positive with too few partners has fewer rows; a positive with a score below 0 has no feasible negative. Labels are whole
numbers. Scores must fit a long; where doubles can't hold them exactly, they are computed in integers. An empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

BLOCK = 2048
# Rows in a range partition of the index: so many at most, fewer where that leaves cores without work.
SLICE_ROWS = 65536
ANCHORS = 8192
FOCUS = 4
DENSE = 0.5
# Anchors whose scores are held at once, times BLOCK.
AT_ONCE = 512
EXACT = 2.0 ** 53
SLACK = 1e-9
NO_ID = np.iinfo(np.int64).max

BLOCK_TYPE = ("block long, n int, dim int, longest double, keys binary, ids binary, no_id binary, labels binary, anchors binary, "
              "vectors binary, places binary")


def usable(vector: Column) -> Column:
    """A vector without null, NaN or infinite components."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))


def _unit(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
    return vectors / np.where(lengths > 0, lengths, 1)[:, None], lengths


def _matrix(column: pa.ListArray, scale: float) -> np.ndarray:
    """floor(scale * x) of ragged vectors, filled up with zeros."""
    counts = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(counts), int(counts.max(initial=0))), np.int64)
    at = np.arange(out.shape[1])[None, :] < counts[:, None]
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out[at] = np.clip(np.floor(scale * values), -2.0 ** 62, 2.0 ** 62).astype(np.int64)
    return out


def _stack(parts: list[np.ndarray]) -> np.ndarray:
    dim = max(p.shape[1] for p in parts)
    return np.concatenate([np.pad(p, ((0, 0), (0, dim - p.shape[1]))) for p in parts])


def build_index(rows: DataFrame, vector: str, label: str, id: str, anchor: Column, scale: float) -> DataFrame:
    """The written index over ``rows``; ``anchor`` marks the query rows."""
    spark = rows.sparkSession
    taken = rows.where(F.col(label).isNotNull() & usable(F.col(vector)))
    taken = taken.select(F.col(id).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
                         F.col(vector).cast("array<double>").alias("vector"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    taken = taken.withColumn("length", F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
    total = taken.count()
    wide = 2 * spark.sparkContext.defaultParallelism
    slices = max(1, -(-total // SLICE_ROWS), min(wide, -(-total // BLOCK)))
    # the salt deals out equal rows
    dealt = taken.withColumn("salt", F.monotonically_increasing_id()).repartitionByRange(slices, "label", F.desc("length"), "salt")
    dealt = dealt.sortWithinPartitions("label", F.desc("length")).select("id", "label", "anchor", "vector")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 33
        number = 0
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                vectors = _matrix(part.column("vector"), scale)
                n, dim = vectors.shape
                unit, lengths = _unit(vectors)
                ids = part.column("id")
                row = {
                    "block": first + number, "n": n, "dim": dim, "longest": float(lengths.max(initial=0)),
                    "keys": (first + number * BLOCK + np.arange(n)).astype(np.int64).tobytes(),
                    "ids": ids.fill_null(int(NO_ID)).to_numpy().astype(np.int64).tobytes(),
                    "no_id": ids.is_null().to_numpy(zero_copy_only=False).tobytes(),
                    "labels": part.column("label").to_numpy().astype(np.int64).tobytes(),
                    "anchors": part.column("anchor").to_numpy(zero_copy_only=False).tobytes(),
                    "vectors": vectors.tobytes(), "places": np.argsort(unit, axis=0, kind="stable").T.astype(np.int16).tobytes()}
                number += 1
                yield pa.RecordBatch.from_pylist([row], schema=BLOCK_SCHEMA)

    path = scratch_path(spark, "llm", "lemp-index", unique=True)
    dealt.mapInArrow(blocks, BLOCK_TYPE).write.parquet(path)
    return spark.read.schema(BLOCK_TYPE).parquet(path)


BLOCK_SCHEMA = pa.schema([("block", pa.int64()), ("n", pa.int32()), ("dim", pa.int32()), ("longest", pa.float64()),
                          *[(c, pa.binary()) for c in ("keys", "ids", "no_id", "labels", "anchors", "vectors", "places")]])


class Bucket:
    """One block of the index in a task."""

    def __init__(self, row: dict):
        n, dim = row["n"], row["dim"]
        self.n, self.dim, self.longest = n, dim, row["longest"]
        self.keys, self.ids, self.labels = (np.frombuffer(row[c], np.int64) for c in ("keys", "ids", "labels"))
        self.no_id, self.anchors = (np.frombuffer(row[c], bool) for c in ("no_id", "anchors"))
        self.vectors = np.frombuffer(row["vectors"], np.int64).reshape(n, dim)
        self.places = np.frombuffer(row["places"], np.int16).reshape(dim, n)
        self.unit, _ = _unit(self.vectors)
        self.ranks = np.empty((dim, n), np.int16)
        np.put_along_axis(self.ranks, self.places.astype(np.int64), np.arange(n, dtype=np.int16)[None, :], axis=1)
        self.most = float(np.abs(self.vectors).max(initial=0))


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[Bucket]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield Bucket(batch.slice(i, 1).to_pylist()[0])


class Anchors:
    """A block of anchors: keys, ids, labels, vectors, and how to search a bucket for them."""

    def __init__(self, keys, ids, no_id, labels, vectors):
        self.keys, self.ids, self.no_id, self.labels, self.vectors = keys, ids, no_id, labels, vectors
        self.unit, self.lengths = _unit(vectors)
        # the most telling coordinates first
        self.focus = np.argsort(-np.abs(self.unit), axis=1, kind="stable")[:, :FOCUS]
        self.most = float(np.abs(vectors).max(initial=0))

    def scores(self, some: np.ndarray, bucket: Bucket, rows: np.ndarray | None = None) -> np.ndarray:
        """Exact integer scores of anchors x rows."""
        dim = min(self.vectors.shape[1], bucket.dim)
        a = self.vectors[some, :dim]
        b = bucket.vectors[:, :dim] if rows is None else bucket.vectors[rows, :dim]
        if dim * self.most * bucket.most < EXACT:
            return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
        return a @ b.T

    def search(self, some: np.ndarray, least: np.ndarray, bucket: Bucket) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
        """For anchors ``some`` with scores of at least ``least`` wanted: those to be verified against the whole
        bucket, and (anchor, candidate rows) for the others that have candidates."""
        size = self.lengths[some] * bucket.longest
        with np.errstate(divide="ignore", invalid="ignore"):
            t = np.where(least > 0, least / size, -1.0)  # a bound on the cosine; none at 0 or below
        t = np.where((least > 0) & (size == 0), 2.0, t) - SLACK
        some, t = some[t <= 1], t[t <= 1]
        free = t <= 0
        whole, picked = [some[free]], []
        some, t = some[~free], t[~free]
        dim = min(self.focus.shape[1], bucket.dim)
        if not len(some) or not dim:
            return np.concatenate([*whole, some]), picked
        focus = self.focus[some]
        q = np.take_along_axis(self.unit[some], focus, axis=1)
        spread = np.sqrt(np.maximum(0, (1 - t[:, None] ** 2) * (1 - q ** 2)))
        low, high = q * t[:, None] - spread - SLACK, q * t[:, None] + spread + SLACK
        # a row with p on a coordinate reaches at most q p + sqrt((1 - q^2)(1 - p^2)), the cosine of the angle between
        # those of q and p; where the angle of t goes beyond 0 or pi, that side is open
        low = np.where(q <= -t[:, None], -2.0, low)
        high = np.where(q >= t[:, None], 2.0, high)
        first, last = np.zeros(focus.shape, np.int64), np.full(focus.shape, bucket.n, np.int64)
        for f in np.unique(focus):
            if f >= bucket.dim:
                continue  # the bucket's vectors end before it
            values = bucket.unit[bucket.places[f].astype(np.int64), f]
            at = focus == f
            first[at] = np.searchsorted(values, low[at], "left")
            last[at] = np.searchsorted(values, high[at], "right")
        width = np.maximum(0, last - first)
        best = width.argmin(axis=1)
        smallest = width[np.arange(len(some)), best]
        dense = smallest > DENSE * bucket.n
        whole.append(some[dense])
        for i in np.flatnonzero(~dense & (smallest > 0)):
            f = focus[i, best[i]]
            rows = bucket.places[f, first[i, best[i]]:last[i, best[i]]].astype(np.int64)
            for k, g in enumerate(focus[i]):
                if k != best[i] and g < bucket.dim and len(rows):
                    rank = bucket.ranks[g, rows]
                    rows = rows[(rank >= first[i, k]) & (rank < last[i, k])]
            if len(rows):
                picked.append((int(some[i]), rows))
        return np.concatenate(whole), picked


def _found(anchors: Anchors, some: np.ndarray, least: np.ndarray, bucket: Bucket) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Exact scores of all candidates, as pieces of (anchor, row, score)."""
    whole, picked = anchors.search(some, least, bucket)
    for start in range(0, len(whole), AT_ONCE):
        part = whole[start:start + AT_ONCE]
        score = anchors.scores(part, bucket)
        yield np.repeat(part, bucket.n), np.tile(np.arange(bucket.n), len(part)), score.ravel()
    held, size = [], 0
    for i, (a, rows) in enumerate(picked):
        score = anchors.scores(np.array([a]), bucket, rows)[0]
        held.append((np.full(len(rows), a), rows, score))
        size += len(rows)
        if size >= AT_ONCE * BLOCK or i + 1 == len(picked):
            yield tuple(np.concatenate(x) for x in zip(*held))
            held, size = [], 0


class Best:
    """The first ``k`` of each group by score (high first) and id, over several pieces."""

    def __init__(self, groups: int, k: int):
        self.k, self.groups = k, groups
        self.floor = np.full(groups, np.iinfo(np.int64).min)  # the k-th score, where there are k
        self.group = self.score = self.id = self.no_id = np.empty(0, np.int64)

    def add(self, group: np.ndarray, score: np.ndarray, id: np.ndarray, no_id: np.ndarray) -> None:
        keep = score >= self.floor[group]
        if not keep.any():
            return
        group, score, id, no_id = group[keep], score[keep], id[keep], no_id[keep].astype(np.int64)
        group, score, id, no_id = (np.concatenate(x) for x in zip(
            (self.group, self.score, self.id, self.no_id), (group, score, id, no_id)))
        by = np.lexsort((no_id, id, -score, group))
        group, score, id, no_id = group[by], score[by], id[by], no_id[by]
        new = np.ones(len(group), bool)
        new[1:] = group[1:] != group[:-1]
        starts = np.flatnonzero(new)
        place = np.arange(len(group)) - np.repeat(starts, np.diff(np.append(starts, len(group))))
        keep = place < self.k
        self.group, self.score, self.id, self.no_id = group[keep], score[keep], id[keep], no_id[keep]
        full = place == self.k - 1
        self.floor[group[full]] = score[full]


POSITIVE_TYPE = "anchor_key long, positive_id long, positive_score long"
NEGATIVE_TYPE = "anchor_key long, place int, negative_id long, negative_score long"


def _ids(best: Best) -> pa.Array:
    return pa.array(best.id, pa.int64(), mask=best.no_id.astype(bool))


def mine(rows: DataFrame, anchor: Column, vector: str = "embedding", label: str = "label", id: str = "vec_id", scale: float = 256.0,
         positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, anchors_at_once: int = ANCHORS) -> DataFrame:
    """Hard negatives of the rows that ``anchor`` marks: anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score. ``low`` and ``high`` bound a negative's score in hundredths of the positive's."""
    spark = rows.sparkSession
    index = build_index(rows, vector, label, id, anchor, scale)
    folder = scratch_path(spark, "llm", "lemp", unique=True)

    def query_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _buckets(batches):
            at = np.flatnonzero(b.anchors)
            yield pa.RecordBatch.from_arrays(
                [pa.array(b.keys[at]), pa.array(b.ids[at], mask=b.no_id[at]), pa.array(b.labels[at]),
                 pa.array([b.vectors[i].tobytes() for i in at], pa.binary())], names=["key", "id", "label", "vector"])

    queries_path = f"{folder}/anchors"
    queries_type = "key long, id long, label long, vector binary"
    index.mapInArrow(query_rows, queries_type).write.parquet(queries_path)
    queries = spark.read.schema(queries_type).parquet(queries_path)
    pieces = -(-queries.count() // anchors_at_once)
    found = []
    for piece in range(pieces):
        # about ANCHORS rows, dealt by a hash: a fixed size, however many anchors there are
        held = queries.where(F.pmod(F.xxhash64("key"), F.lit(pieces)) == piece).orderBy("key").toArrow()
        if not held.num_rows:
            continue
        ids = held.column("id").combine_chunks()
        vectors = _stack([np.frombuffer(v, np.int64)[None, :] for v in held.column("vector").to_pylist()])
        block = {"keys": held.column("key").to_numpy(), "ids": ids.fill_null(int(NO_ID)).to_numpy(),
                 "no_id": ids.is_null().to_numpy(zero_copy_only=False), "labels": held.column("label").to_numpy(), "vectors": vectors}
        out = f"{folder}/piece-{piece}"
        _mine_block(spark, index, block, positives, negatives, low, high, f"{folder}/positives-{piece}").write.parquet(out)
        found.append(out)
    result_type = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    return spark.read.schema(result_type).parquet(*found) if found else spark.createDataFrame([], result_type)


def _mine_block(spark, index: DataFrame, block: dict, positives: int, negatives: int, low: int, high: int, path: str) -> DataFrame:
    shared = spark.sparkContext.broadcast(block)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(**shared.value)
        best = Best(len(anchors.keys), positives)
        for b in _buckets(batches):
            some = np.flatnonzero(np.isin(anchors.labels, b.labels))
            for a, r, score in _found(anchors, some, best.floor[some].astype(np.float64), b):
                ok = (score >= best.floor[a]) & (anchors.labels[a] == b.labels[r]) & (anchors.keys[a] != b.keys[r])
                best.add(a[ok], score[ok], b.ids[r[ok]], b.no_id[r[ok]])
        yield pa.RecordBatch.from_arrays([pa.array(anchors.keys[best.group]), _ids(best), pa.array(best.score)],
                                         names=["anchor_key", "positive_id", "positive_score"])

    first = Window.partitionBy("anchor_key").orderBy(F.desc("positive_score"), F.asc_nulls_last("positive_id"))
    chosen = index.mapInArrow(nearest, POSITIVE_TYPE).withColumn("place", F.row_number().over(first)).where(F.col("place") <= positives)
    chosen.write.parquet(path)
    chosen = spark.read.schema(f"{POSITIVE_TYPE}, place int").parquet(path)
    # ``positives`` rows for each anchor of the block
    wanted = chosen.select("anchor_key", "place", "positive_score").toArrow()
    bounds = spark.sparkContext.broadcast({c: wanted.column(c).to_numpy() for c in wanted.column_names})

    def hard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(**shared.value)
        n = len(anchors.keys)
        by_key = np.argsort(anchors.keys)
        owner = by_key[np.searchsorted(anchors.keys[by_key], bounds.value["anchor_key"])]
        place = bounds.value["place"].astype(np.int64) - 1
        goal = np.full((positives, n), -1, np.int64)  # the positives' scores; below 0 nothing is feasible
        goal[place, owner] = bounds.value["positive_score"]
        # low * goal <= 100 * score <= high * goal in whole numbers, without a product that overflows
        whole, rest = goal // 100, goal % 100
        floor = whole * low - (-rest * low // 100)
        roof = whole * high + rest * high // 100
        best = [Best(n, negatives) for _ in range(positives)]
        live = (goal >= 0) & (floor <= roof)
        never = np.iinfo(np.int64).max
        for b in _buckets(batches):
            # per positive what a new row must reach; an anchor's search needs the least of these
            need = np.stack([np.where(live[k], np.maximum(floor[k], best[k].floor), never) for k in range(positives)])
            least = need.min(axis=0)
            some = np.flatnonzero(least < never)
            if (b.labels == b.labels[0]).all():
                some = some[anchors.labels[some] != b.labels[0]]
            for a, r, score in _found(anchors, some, least[some].astype(np.float64), b):
                ok = (score >= least[a]) & (anchors.labels[a] != b.labels[r])
                a, r, score = a[ok], r[ok], score[ok]
                for k in range(positives):
                    fits = (score >= need[k, a]) & (score <= roof[k, a])
                    best[k].add(a[fits], score[fits], b.ids[r[fits]], b.no_id[r[fits]])
        for k in range(positives):
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchors.keys[best[k].group]), pa.array(np.full(len(best[k].group), k + 1, np.int32)), _ids(best[k]),
                 pa.array(best[k].score)], names=["anchor_key", "place", "negative_id", "negative_score"])

    order = Window.partitionBy("anchor_key", "place").orderBy(F.desc("negative_score"), F.asc_nulls_last("negative_id"))
    out = (index.mapInArrow(hard, NEGATIVE_TYPE).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives))
    names = spark.createDataFrame(pa.table({"anchor_key": block["keys"], "anchor_id": pa.array(block["ids"], mask=block["no_id"])}))
    return (out.join(chosen, ["anchor_key", "place"]).join(F.broadcast(names), "anchor_key")  # a block of anchors: a fixed size
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
