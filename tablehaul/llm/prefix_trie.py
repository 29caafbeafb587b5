"""Prefix trie of conversations by vertical bitmaps.

1. Turns travel as digests (``turn_digest``) and sizes; texts stay where they are read. Conversations are dealt out by ranges
   of their ids, and each task works through its range in shards of up to SHARD_CONVS conversations or SHARD_TURNS turns.
2. A shard has an index from (position, turn) to a bitset of its conversations. Depth first, a node's bitset is intersected
   with the postings of the turns that its members have next; every intersection gives a child, its popcount the members, and
   the members that have no further turn are the node's end list.
3. A node is known by a digest chained over its turns. Nodes that only one shard has (then their subtrees lie in that shard
   as well) are final. Nodes of several shards are merged: members added up, the smallest id, end lists strung together in
   order of the ids (pieces of up to END_PIECE ids, streamed through the hash).
4. Sums over the subtrees of merged nodes: each has its own value and those of its final children, and pointer doubling
   adds up the rest in rounds (the logarithm of the greatest depth of a merged node), each written to the shared folder.

Result, one row per node: node and parent (hex digests), conv_id (smallest member), depth, parent_conv_id, n_convs,
n_children, n_leaves (childless nodes in its subtree), saved_tokens (over its subtree: (n_convs - 1) times the size of the last
turn), ends_sha256 (SHA-256 of the ids of the members that end there, ascending, with commas). ``with_turns`` gives each node
the columns of its last turn.

At scale: what a shard holds is bounded by its turns, but a conversation is never split, so a task holds the digests and sizes
of the longest one (some 100 bytes a turn, without its texts). The end list of a node is one sequential hash, so its ids
pass through one task as a stream; nothing holds them all.

Defined cases: rows without a conversation id take no part. A row without a position adds no turn, only the
conversation; one without turns ends at the root. Null values in the turn's columns count as empty. Positions need
not be gapless; turns with equal positions come in order of their digests, and equal rows are turns of their own. An empty
table gives an empty result (no root). Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lookup, saved

SHARD_CONVS = 4096
SHARD_TURNS = 262_144
# Turns in a range of conversations: so many at most on average, fewer where that leaves cores without work.
RANGE_TURNS = 1 << 20
LEAST_TURNS = 4096
END_PIECE = 256
NODE_BYTES = 16
ROOT = hashlib.blake2b(b"root", digest_size=NODE_BYTES).digest()

LOCAL_TYPE = ("node binary, parent binary, depth int, size long, conv long, parent_conv long, n long, children long, leaves long, "
              "saved long, ends array<string>, ends_sha256 string")
LOCAL_SCHEMA = pa.schema([("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int32()), ("size", pa.int64()),
                          ("conv", pa.int64()), ("parent_conv", pa.int64()), ("n", pa.int64()), ("children", pa.int64()),
                          ("leaves", pa.int64()), ("saved", pa.int64()), ("ends", pa.list_(pa.string())), ("ends_sha256", pa.string())])
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_digest(columns: list[str]) -> Column:
    """SHA-256 of the values with their lengths, so that no two turns with different values look alike."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return F.unhex(F.sha2(F.concat(*[F.concat(F.length(t).cast("string"), F.lit(":"), t) for t in texts]), 256))


def local_nodes(convs: list[int], turns: list[list[bytes]], sizes: list[list[int]], end_piece: int = END_PIECE) -> Iterator[tuple]:
    """The nodes of a shard (``convs`` ascending) in the order of LOCAL_SCHEMA, parents before their children."""
    numbers: dict[bytes, int] = {}
    own = [[numbers.setdefault(t, len(numbers)) for t in ts] for ts in turns]
    digests = list(numbers)
    deepest = max(map(len, own), default=0)
    posting: list[dict[int, int]] = [{} for _ in range(deepest)]
    alive = [0] * (deepest + 1)  # conversations with more than d turns
    for i, ts in enumerate(own):
        bit = 1 << i
        for d, t in enumerate(ts):
            alive[d] |= bit
            posting[d][t] = posting[d].get(t, 0) | bit
    nodes = []  # [node, parent's place, depth, size, smallest, n, children, leaves, saved, end bits]
    stack = [((1 << len(convs)) - 1, 0, ROOT, -1, 0)]
    while stack:
        members, depth, node, above, size = stack.pop()
        smallest = (members & -members).bit_length() - 1
        going = members & alive[depth]
        n = members.bit_count()
        place = len(nodes)
        entry = [node, above, depth, size, smallest, n, 0, 0, (n - 1) * size, members ^ going]
        nodes.append(entry)
        if above >= 0:
            nodes[above][6] += 1
        while going:
            i = (going & -going).bit_length() - 1
            turn = own[i][depth]
            child = members & posting[depth][turn]
            going ^= child
            chained = hashlib.blake2b(node + digests[turn], digest_size=NODE_BYTES).digest()
            stack.append((child, depth + 1, chained, place, sizes[i][depth]))
    for entry in reversed(nodes):  # children come after their parents
        if not entry[6]:
            entry[7] = 1
        if entry[1] >= 0:
            nodes[entry[1]][7] += entry[7]
            nodes[entry[1]][8] += entry[8]
    for node, above, depth, size, smallest, n, children, leaves, saved_here, end in nodes:
        ids = []
        while end:
            low = end & -end
            ids.append(str(convs[low.bit_length() - 1]))
            end ^= low
        pieces = [",".join(ids[k:k + end_piece]) for k in range(0, len(ids), end_piece)]
        yield (node, nodes[above][0] if above >= 0 else None, depth, size, convs[smallest],
               convs[nodes[above][4]] if above >= 0 else None, n, children, leaves, saved_here, pieces,
               hashlib.sha256(",".join(pieces).encode()).hexdigest() if pieces else NO_ENDS)


def _shards(batches: Iterator[pa.RecordBatch], shard_convs: int, shard_turns: int, end_piece: int) -> Iterator[pa.RecordBatch]:
    """Rows (conv, digest, size) in order of conversations and positions -> local nodes, shard by shard."""
    convs: list[int] = []
    turns: list[list[bytes]] = []
    sizes: list[list[int]] = []
    held = 0

    def done() -> Iterator[pa.RecordBatch]:
        out = []
        for row in local_nodes(convs, turns, sizes, end_piece):
            out.append(row)
            if len(out) == 8192:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)

    for batch in batches:
        for conv, digest, size in zip(*(batch.column(c).to_pylist() for c in ("conv", "digest", "size"))):
            if not convs or convs[-1] != conv:
                if len(convs) >= shard_convs or held >= shard_turns:
                    yield from done()
                    convs, turns, sizes, held = [], [], [], 0
                convs.append(conv)
                turns.append([])
                sizes.append([])
            if digest is not None:
                turns[-1].append(digest)
                sizes[-1].append(size)
                held += 1
    if convs:
        yield from done()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), LOCAL_SCHEMA)], schema=LOCAL_SCHEMA)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces (node, piece) in order -> (node, ends_sha256), one node after the other as a stream."""
    node, state = None, None
    for batch in batches:
        found = []
        for key, piece in zip(batch.column("node").to_pylist(), batch.column("piece").to_pylist()):
            if key != node:
                if node is not None:
                    found.append((node, state.hexdigest()))
                node, state = key, hashlib.sha256()
            else:
                state.update(b",")
            state.update(piece.encode())
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], names=["node", "ends_sha256"])
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()])], names=["node", "ends_sha256"])


def _subtree_sums(merged: DataFrame) -> DataFrame:
    """Rows (node, parent, leaves, saved) with the sums over each node's subtree, by pointer doubling."""
    state = saved(merged.select("node", F.col("parent").alias("up"), "leaves", "saved"), "trie-sums")
    while True:
        pointing = state.where("up IS NOT NULL").count()
        if not pointing:
            return state.drop("up")
        # what the nodes that point at a node bring to it, added up where they are read
        brought = state.where("up IS NOT NULL").groupBy(F.col("up").alias("node")).agg(
            F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"), F.count(F.lit(1)).alias("pointers"))
        grown = saved(state.join(brought, "node", "left"), "trie-sums")
        target = grown.where("pointers IS NOT NULL").select(F.col("node").alias("up"), F.col("up").alias("next_up"), "pointers")
        moved = lookup(grown, target, "up", ["next_up"], "pointers", pointing, ["node"])
        state = saved(moved.select("node", F.col("next_up").alias("up"),
                                   (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
                                   (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved")), "trie-sums")


def trie(turns: DataFrame, digest: str = "digest", size: str = "size", conv: str = "conv_id", position: str = "position",
         shard_convs: int = SHARD_CONVS, shard_turns: int = SHARD_TURNS, end_piece: int = END_PIECE) -> DataFrame:
    """The trie's nodes from rows of (conversation, position, digest of the turn, size of the turn)."""
    rows = turns.select(F.col(conv).cast("long").alias("conv"), F.col(position).alias("position"), F.col(digest).alias("digest"),
                        F.col(size).cast("long").alias("size")).where("conv IS NOT NULL")
    rows = rows.withColumn("digest", F.when(F.col("position").isNotNull(), F.col("digest")))
    spark = turns.sparkSession
    total = rows.count()
    wide = 2 * spark.sparkContext.defaultParallelism
    ranges = max(1, -(-total // RANGE_TURNS), min(wide, -(-total // LEAST_TURNS)))
    dealt = rows.repartitionByRange(ranges, "conv").sortWithinPartitions("conv", "position", "digest")
    local = saved(dealt.select("conv", "digest", "size").mapInArrow(
        partial(_shards, shard_convs=shard_convs, shard_turns=shard_turns, end_piece=end_piece), LOCAL_TYPE), "trie-local")

    # nodes of several shards
    counted = local.groupBy("node").agg(F.count(F.lit(1)).alias("shards"), F.sum("n").alias("n_convs"), F.min("conv").alias("conv_id"),
                                        F.sum("children").alias("links"))
    shared = saved(counted.where("shards > 1"), "trie-shared")
    n_local = local.count()
    marked = lookup(local, shared.select("node", "shards"), "node", ["shards"], "shards", n_local, ["conv"])
    merged_rows = marked.where("shards IS NOT NULL")
    parents = shared.select(F.col("node").alias("parent"), F.col("conv_id").alias("shared_conv"), "links")
    final = lookup(marked.where("shards IS NULL"), parents, "parent", ["shared_conv"], "links", n_local, ["node"])
    final = saved(final.drop("shards", "ends"), "trie-final")

    about = merged_rows.groupBy("node").agg(F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.first("size").alias("size"))
    pieces = merged_rows.where(F.size("ends") > 0).select("node", F.explode("ends").alias("piece"))
    first_id = F.split_part("piece", F.lit(","), F.lit(1)).cast("long")
    pieces = pieces.withColumn("first_id", first_id).repartition("node").sortWithinPartitions("node", "first_id")
    hashed = pieces.select("node", "piece").mapInArrow(_hashed, "node binary, ends_sha256 string")
    merged = saved(shared.drop("links", "shards").join(about, "node").join(hashed, "node", "left"), "trie-merged")

    # children: final ones bring the sums of their subtrees, merged ones only count
    below = final.where("shared_conv IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(
        F.count(F.lit(1)).alias("few"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    links = merged.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("many"))
    none = F.lit(0).cast("long")
    merged = merged.join(below, "node", "left").join(links, "node", "left")
    merged = merged.withColumn("n_children", F.coalesce("few", none) + F.coalesce("many", none))
    merged = merged.withColumn("leaves", F.coalesce("leaves", none) + (F.col("n_children") == 0).cast("long"))
    merged = saved(merged.withColumn("saved", F.coalesce("saved", none) + (F.col("n_convs") - 1) * F.col("size")), "trie-merged")
    sums = _subtree_sums(merged)
    n_merged = merged.count()
    weight = links.withColumnRenamed("node", "parent").withColumnRenamed("many", "links")
    names = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id")).join(weight, "parent")
    merged = lookup(merged.drop("leaves", "saved").join(sums, "node"), names, "parent", ["parent_conv_id"], "links", n_merged, ["node"])

    def shown(df: DataFrame, conv_id, parent_conv, n_convs, n_children) -> DataFrame:
        return df.select(F.lower(F.hex("node")).alias("node"), F.lower(F.hex("parent")).alias("parent"), F.col(conv_id).alias("conv_id"),
                         F.col("depth").cast("long").alias("depth"), parent_conv.alias("parent_conv_id"), F.col(n_convs).alias("n_convs"),
                         F.col(n_children).alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                         F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))

    return shown(final, "conv", F.coalesce("shared_conv", "parent_conv"), "n", "children").unionByName(
        shown(merged, "conv_id", F.col("parent_conv_id"), "n_convs", "n_children"))


def with_turns(nodes: DataFrame, turns: DataFrame, columns: list[str], conv: str = "conv_id", position: str = "position") -> DataFrame:
    """``nodes`` with the ``columns`` of their last turn (null at the root). ``turns`` needs gapless positions from 0."""
    last = turns.select(F.col(conv).alias("conv_id"), (F.col(position) + 1).alias("depth"), *columns)
    return nodes.drop(*columns).join(last, ["conv_id", "depth"], "left")
