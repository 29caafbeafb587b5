"""MinHash near-dedup: DartMinHash signatures over weighted word shingles, banded joining, exact check.

A text is the multiset of its shingles (five words), weighted by their counts; two texts are near copies
when their weighted Jaccard similarity (sum of minima over sum of maxima) is at least 0.8.

1. Texts with the same words are one node. ``signatures`` throws darts: a region of an element (a dyadic
   range of its weight) receives a Poisson stream of darts by rank, all drawn from hashes of the element,
   the region and the dart's number. A text keeps the darts within its weights, and of those the earliest
   per coordinate. Two texts agree in a coordinate with a probability equal to their similarity. The time
   is that of the elements plus the darts, not their product.
2. Bands of ROWS coordinates make buckets. 16 bands of 4 find a pair of similarity 0.8 with a probability
   over 0.9997.
3. Each bucket names one centre, the member with the most bucket mates, and every member is compared with
   its centres: as many pairs as members, never all pairs of a bucket. Components of the confirmed links
   come from minimum labels passed along the links.
4. What is left are buckets with several components. A member outside its bucket's largest component can
   only have a link if enough of its shingles occur elsewhere in such buckets; that count, the lengths, and
   the shingles' numbers in BINS bins give upper bounds of a pair's similarity, which settle nearly all within
   the join. The rest is compared exactly, so no candidate pair between different components is dropped
   unless its similarity is surely below the threshold.

Scale: all joins are on buckets, nodes or ids, of narrow rows; shingles are shuffled only of nodes with a bucket
mate, and texts once: a broadcast bitmap of FILTER_BITS first drops most rows that the exact join would. The more
mates there are, the less it drops, and no more than all texts are shuffled. Copies are folded before. Signatures, buckets, shingles and links are written to
the shared folder, so a lost executor costs its tasks only. Nothing but counts reaches the driver.

Defined cases: texts without a word (null and empty among them) are nobody's copies; texts of one to four
words have one shingle. The smallest doc_id names the class, and its row stays (null ids come last; of rows sharing the id,
the first by its text's hash; rows equal in id and text share their fate). Other rows of the class go, whatever else has their id.
An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lookup, per_worker, saved, small

SHINGLE_WORDS = 5
THRESHOLD = 0.8
BANDS = 16
ROWS = 4
COORDINATES = BANDS * ROWS
BINS = 128
CHARS_AT_ONCE = 1_000_000
MEMO_WORDS = 250_000
FILTER_BITS = 1 << 25  # 4 MB

WORD = re.compile(r"\w+")


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _uniform(h: np.ndarray) -> np.ndarray:
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53


class Shingler:
    """Hashed shingles of texts; keeps word hashes up to MEMO_WORDS."""

    def __init__(self):
        self.memo: dict[str, int] = {}

    def _word_hashes(self, docs: list[list[str]]) -> np.ndarray:
        words = set().union(*docs)
        new = [w for w in words if w not in self.memo]
        if len(self.memo) + len(new) > MEMO_WORDS:
            self.memo = {}
            new = words
        for w in new:
            self.memo[w] = int.from_bytes(hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        memo = self.memo
        return np.fromiter((memo[w] for ws in docs for w in ws), np.uint64, sum(map(len, docs)))

    def shingles(self, docs: list[list[str]]) -> list[np.ndarray]:
        """Per text (given as its words, at least one) the hashes of its shingles, in order."""
        h = self._word_hashes(docs)
        sizes = np.array([len(ws) for ws in docs])
        ends = np.cumsum(sizes)
        out = []
        acc = np.zeros(len(h), np.uint64)
        with np.errstate(over="ignore"):
            for k in range(SHINGLE_WORDS):
                acc[:len(h) - k] = acc[:len(h) - k] * np.uint64(0x100000001B3) + h[k:]
            mixed = _mix(acc)
            for a, b in zip(ends - sizes, ends):
                if b - a >= SHINGLE_WORDS:
                    out.append(mixed[a:b - SHINGLE_WORDS + 1])
                else:
                    one = np.zeros(1, np.uint64)
                    for x in h[a:b]:
                        one = one * np.uint64(0x100000001B3) + x
                    out.append(_mix(one + np.uint64(b - a)))
        return out


def signatures(elements: list[np.ndarray], weights: list[np.ndarray], coordinates: int = COORDINATES) -> np.ndarray:
    """DartMinHash signatures of weighted sets: one row of dart ids (one per coordinate) for each set."""
    out = np.zeros((len(elements), coordinates), np.uint64)
    todo = np.arange(len(elements))
    mass = np.array([w.sum() for w in weights], np.float64)
    reach = (np.log(coordinates) + 4) / mass  # to this rank nearly every coordinate has a dart
    while len(todo):
        cells, ids = _darts([elements[i] for i in todo], [weights[i] for i in todo], reach[todo], coordinates)
        filled = np.zeros(len(todo) * coordinates, bool)
        filled[cells] = True
        found = np.zeros(len(todo) * coordinates, np.uint64)
        found[cells] = ids
        done = filled.reshape(len(todo), coordinates).all(axis=1)
        out[todo[done]] = found.reshape(len(todo), coordinates)[done]
        todo = todo[~done]
        reach[todo] *= 2
    return out


def _darts(elements: list[np.ndarray], weights: list[np.ndarray], reach: np.ndarray, coordinates: int) -> tuple[np.ndarray, np.ndarray]:
    """The earliest dart of each (set, coordinate) cell that has one."""
    owner = np.repeat(np.arange(len(elements)), [len(e) for e in elements])
    element, weight = np.concatenate(elements), np.concatenate(weights).astype(np.float64)
    levels = np.ceil(np.log2(weight + 1)).astype(np.int64)  # regions [2^v - 1, 2^(v+1) - 1) below the weight
    at = np.repeat(np.arange(len(element)), levels)
    level = np.arange(len(at)) - np.repeat(np.cumsum(levels) - levels, levels)
    width = 2.0 ** level
    with np.errstate(over="ignore"):
        stream = _mix(element[at] + level.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        owner, weight = owner[at], weight[at]
        rank = np.zeros(len(at))
        cells, ranks, ids = [], [], []
        step = np.uint64(0)
        while len(stream):
            step += np.uint64(1)
            dart = _mix(stream + step * np.uint64(0xD1342543DE82EF95))
            rank = rank - np.log(_uniform(dart)) / (coordinates * width)
            near = rank <= reach[owner]
            stream, owner, weight, width, rank, dart = (x[near] for x in (stream, owner, weight, width, rank, dart))
            inside = width - 1 + width * _uniform(_mix(dart + np.uint64(1))) < weight
            hit = dart[inside]
            column = (_mix(hit + np.uint64(2)) % np.uint64(coordinates)).astype(np.int64)
            cells.append(owner[inside] * coordinates + column)
            ranks.append(rank[inside])
            ids.append(hit)
    cell, rank, dart = np.concatenate(cells), np.concatenate(ranks), np.concatenate(ids)
    order = np.lexsort((rank, cell))
    cell, dart = cell[order], dart[order]
    first = np.ones(len(cell), bool)
    first[1:] = cell[1:] != cell[:-1]
    return cell[first], dart[first]


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of each signature."""
    with np.errstate(over="ignore"):
        parts = signature.reshape(len(signature), BANDS, ROWS)
        key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), parts.shape[:2]) * np.uint64(0x9E3779B97F4A7C15)
        for r in range(ROWS):
            key = _mix(key + parts[:, :, r])
    return key.view(np.int64)


def _node(words: list[str]) -> str:
    """A name for a word sequence: 128 bits."""
    digest = hashlib.blake2b(" ".join(words).encode("utf-8", "surrogatepass"), digest_size=16).digest()
    return base64.b64encode(digest)[:22].decode()


def _parts(texts: list[str | None]) -> Iterator[slice]:
    """Runs of consecutive texts of together about CHARS_AT_ONCE code points."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= CHARS_AT_ONCE or i == len(texts) - 1:
            yield slice(start, i + 1)
            start, size = i + 1, 0


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, place, text) -> doc_id, place, node, bands; node and bands are null without a word."""
    shingler = per_worker("shingler", Shingler)
    for batch in small(batches):
        texts = batch.column("text").to_pylist()
        for part in _parts(texts):
            words = [WORD.findall(t.lower()) if t else [] for t in texts[part]]
            nodes = [_node(ws) if ws else None for ws in words]
            first = {n: i for i, n in reversed(list(enumerate(nodes))) if n}
            bands: dict[str, list[int]] = {}
            if first:
                pairs = [np.unique(s, return_counts=True) for s in shingler.shingles([words[i] for i in first.values()])]
                keys = band_keys(signatures([p[0] for p in pairs], [p[1] for p in pairs]))
                bands = dict(zip(first, keys.tolist()))
            rows = batch.slice(part.start, part.stop - part.start)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("place"), pa.array(nodes, pa.string()),
                 pa.array([bands.get(n) for n in nodes], pa.list_(pa.int64()))],
                names=["doc_id", "place", "node", "bands"])


def _shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, text) -> node, n, shingles: sorted 64-bit numbers, one for each occurrence of a shingle; bins:
    how many of them fall into each of BINS bins."""
    shingler = per_worker("shingler", Shingler)
    for batch in small(batches):
        names, texts = batch.column("node").to_pylist(), batch.column("text").to_pylist()
        for part in _parts(texts):
            words = [WORD.findall(t.lower()) for t in texts[part]]
            # another text may have the same hash
            own = [(node, ws) for node, ws in zip(names[part], words) if ws and _node(ws) == node]
            sets, bins = [], [np.zeros(0, np.int64)]
            for shingles in shingler.shingles([ws for _, ws in own]) if own else []:
                found, counts = np.unique(shingles, return_counts=True)
                with np.errstate(over="ignore"):
                    nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                    sets.append(np.sort(_mix(np.repeat(found, counts) + nth.astype(np.uint64))))
                bins.append(np.bincount((sets[-1] % np.uint64(BINS)).astype(np.int64), minlength=BINS))
            yield pa.RecordBatch.from_arrays(
                [pa.array([node for node, _ in own], pa.string()), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary()),
                 pa.ListArray.from_arrays(np.arange(len(sets) + 1) * BINS, pa.array(np.concatenate(bins), pa.int32()))],
                names=["node", "n", "shingles", "bins"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, sa, sb) -> a, b, similarity."""
    for batch in batches:
        out = []
        for x, y in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist()):
            both = np.sort(np.concatenate([np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")]))
            common = int((both[1:] == both[:-1]).sum())
            out.append(common / (len(both) - common))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(out, pa.float64())],
                                         names=["a", "b", "similarity"])


def _each_shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(name, shingles) -> a row per shingle: name, and 32 bits of the shingle."""
    for batch in batches:
        raw = batch.column("shingles").to_pylist()
        owner = np.repeat(np.arange(len(raw)), [len(x) // 8 for x in raw])
        numbers = np.frombuffer(b"".join(raw), "<i4")[::2]
        yield pa.RecordBatch.from_arrays([batch.column("name").take(pa.array(owner, pa.int64())), pa.array(numbers)],
                                         names=["name", "shingle"])


def among(df: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """The rows of ``df`` whose ``key`` occurs in ``wanted``, and some others, by a broadcast bitmap of the keys' hashes:
    what goes before a join whose shuffle would carry many rows that match nothing."""
    bit = F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))
    bitmaps = (wanted.select(F.bitmap_bucket_number(bit).alias("_block"), F.bitmap_bit_position(bit).alias("_at"))
               .repartition("_block").groupBy("_block").agg(F.bitmap_construct_agg("_at").alias("_bits")))
    at = F.bitmap_bit_position(bit)
    byte = F.conv(F.hex(F.substr("_bits", (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    held = F.getbit(byte, (at % 8).cast("int")) == 1
    return df.join(F.broadcast(bitmaps), (F.bitmap_bucket_number(bit) == F.col("_block")) & held, "left_semi")


def confirmed(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose similarity reaches the threshold."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb")
    out = both.mapInArrow(_compare, "a string, b string, similarity double")
    return out.where(F.col("similarity") >= threshold).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """node, label of all linked nodes: the smallest node of the component.

    A node starts with the smallest of its neighbours and itself. Labels pass along the links, then each takes
    its label's label, until none passes; the rounds grow with the logarithm of a component's width. Each round
    is written to the shared folder; ``links`` is read in each and should be, too.
    """
    both = (links.select(F.col("a").alias("node"), F.col("b").alias("other"))
            .unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("other"))))
    now = saved(both.groupBy("node").agg(F.min("other").alias("_heard"))
                .select("node", F.least("node", "_heard").alias("label")), "labels")
    total = now.count()
    while True:
        heard = both.join(now.select(F.col("node").alias("other"), "label"), "other").groupBy("node").agg(F.min("label").alias("_heard"))
        step = saved(now.join(heard, "node", "left").select(
            "node", F.col("label").alias("_was"), F.least("label", F.coalesce("_heard", "label")).alias("label")), "heard")
        if step.where(F.col("_was") != F.col("label")).isEmpty():  # neighbours have the same label, so components have
            return now
        now = saved(_relabelled(step.select("node", "label"), step.where(F.col("label") < F.col("node")).select("node", "label"), total), "labels")


def _relabelled(labels: DataFrame, heads: DataFrame, total: int) -> DataFrame:
    """``labels`` (``total`` rows of node, label) with the label that a row's label has in ``heads``, if any."""
    # a label of many nodes is a hot key
    carried = (labels.select("label", F.lit(1).cast("long").alias("_n"), F.lit(None).cast("string").alias("_next"))
               .unionByName(heads.select(F.col("node").alias("label"), F.lit(0).cast("long").alias("_n"), F.col("label").alias("_next")))
               .groupBy("label").agg(F.sum("_n").alias("_n"), F.min("_next").alias("_next")).where("_n > 0 AND _next IS NOT NULL"))
    handed = lookup(labels, carried, "label", ["_next"], "_n", total, ["node"])
    return handed.select("node", F.coalesce("_next", "label").alias("label"))


def _merged(labels: DataFrame, more: DataFrame) -> DataFrame:
    """``labels`` after more links, which join whole components: links between labels, and labels of labels."""
    a, b = (labels.select(F.col("node").alias(end), F.col("label").alias(f"_{end}")) for end in "ab")
    ends = more.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b"))
    heads = components(saved(ends.distinct(), "label-links"))
    single = heads.join(labels, "node", "left_anti")  # a label is one of its component's nodes
    return saved(_relabelled(labels, heads, labels.count()).unionByName(single), "labels")


def _left_over(mates: DataFrame, labels: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs of bucket mates in different components that the bounds can't rule out."""
    # shingles of one node only; two that share 32 bits count as shared, which keeps the bound one
    named_sets = sets.withColumn("name", F.xxhash64("node"))
    alone = (named_sets.select("name", "shingles").mapInArrow(_each_shingle, "name long, shingle int")
             .groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("name").alias("name")).where("n = 1")
             .groupBy("name").agg(F.count(F.lit(1)).alias("_alone")))
    sizes = named_sets.select("name", "node", "n").join(alone, "name", "left")
    sizes = sizes.select("node", "n", (F.col("n") - F.coalesce("_alone", F.lit(0))).alias("c"))
    # one row of a node, until its buckets are needed
    alive = F.coalesce(F.col("c") >= threshold * F.col("n"), F.lit(False)).alias("alive")
    members = saved(mates.join(labels, "node", "left").join(sizes, "node", "left").select(
        "node", "keys", F.coalesce("label", "node").alias("label"), "n", "c", alive), "members")
    named = members.select(F.explode("keys").alias("key"), "node", "label", "n", "c", "alive")
    torn = (named.groupBy("key", "label").agg(F.count(F.lit(1)).alias("rows"), F.min(F.when(F.col("alive"), F.col("n"))).alias("_shortest"))
            .groupBy("key").agg(F.count(F.lit(1)).alias("labels"), F.max(F.struct("rows", "label"))["label"].alias("_largest"),
                                F.min("_shortest").alias("_shortest")).where("labels > 1 AND _shortest IS NOT NULL"))
    minor = ((F.col("label") != F.col("_largest"))
             & (F.col("c") >= threshold * (F.col("n") + F.greatest("_shortest", F.col("c")) - F.col("c")))).alias("minor")
    columns = ("node", "label", "n", "c", "bins")
    alive = saved(named.where("alive").join(saved(torn.select("key", "_largest", "_shortest"), "torn-buckets"), "key")
                  .select("key", *columns[:-1], minor), "alive-mates")
    partners = saved(alive.join(alive.where("minor").select("key").distinct(), "key", "left_semi")
                     .join(sets.select("node", "bins"), "node").select("key", "minor", *columns), "partners")
    left = partners.where("minor").select("key", *[F.col(c).alias(f"{c}_a") for c in columns])
    right = partners.select("key", *[F.col(c).alias(f"{c}_b") for c in columns])
    total, shared = F.col("n_a") + F.col("n_b"), F.least("c_a", "c_b")
    # no more shingles in common than each bin allows; evaluated within the join, which emits no other pair
    in_bins = F.aggregate(F.zip_with("bins_a", "bins_b", lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)
    pairs = left.join(right, "key").where((F.col("label_a") != F.col("label_b"))
                                          & (shared >= threshold * (total - shared))
                                          & (in_bins >= threshold * (total - in_bins)))
    return pairs.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def _place(docs: DataFrame) -> Column:
    """A name for a row: its id, and a hash of its text."""
    return F.concat_ws(":", docs["doc_id"].cast("string"), F.xxhash64(docs["text"].cast("string")).cast("string"))


def _classes(docs: DataFrame, threshold: float) -> DataFrame:
    """``near_groups`` with ``place``, the row's name."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), _place(docs).alias("place"))
    # one row of each node stands for its text: the one with the smallest id, null ids by their hash
    signed = saved(rows.mapInArrow(_sign, f"doc_id {dict(docs.dtypes)['doc_id']}, place string, node string, bands array<long>"), "signed")
    nodes = saved(signed.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("first_id"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "place"))["place"].alias("place"),
        F.count(F.lit(1)).alias("rows"), F.first("bands").alias("bands")), "nodes")
    buckets = nodes.select("node", "place", F.explode("bands").alias("key"))
    shared = saved(buckets.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "shared-buckets")
    # one row of a node, with its shared buckets
    mates = saved(among(buckets, "key", shared).join(shared, "key").groupBy("node").agg(
        F.first("place").alias("place"), F.sum("size").alias("weight"), F.collect_list("key").alias("keys")), "mates")
    each = mates.select("node", "weight", F.explode("keys").alias("key"))
    centres = saved(each.groupBy("key").agg(F.max(F.struct("weight", "node"))["node"].alias("centre")), "centres")
    pairs = saved(each.join(centres, "key").where("node <> centre")
                  .select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct(), "pairs")
    needed = mates.select("node", "place")
    texts = (among(rows.where("text is not null").select("place", "text"), "place", needed).join(needed, "place")
             .dropDuplicates(["place", "node"]).select("node", "text"))
    sets = saved(texts.mapInArrow(_shingle_sets, "node string, n long, shingles binary, bins array<int>"), "shingle-sets")
    links = saved(confirmed(pairs, sets, threshold), "near-links")
    labels = components(links)
    open_pairs = saved(_left_over(mates, labels, sets, threshold), "open-pairs")
    more = saved(confirmed(open_pairs, sets, threshold), "more-links")
    if not more.isEmpty():
        labels = _merged(labels, more)
    # the row that stays: the one with the smallest id (null ids last), then by its text's hash
    stays = F.min(F.struct(F.col("first_id").isNull(), "first_id", "place"))["place"].alias("class_place")
    grouped = labels.join(nodes, "node").groupBy("label").agg(
        F.min("first_id").alias("class_id"), F.sum("rows").alias("class_size"), stays, F.count(F.lit(1)).alias("members"))
    values = ["class_id", "class_size", "class_place"]
    linked = lookup(labels, saved(grouped, "classes"), "label", values, "members", labels.count(), ["node"])
    of_node = nodes.join(linked.select("node", *values), "node", "left").select(
        "node", "rows", F.coalesce("class_id", "first_id").alias("class_id"), F.coalesce("class_size", "rows").alias("class_size"),
        F.coalesce("class_place", "place").alias("class_place"))
    found = lookup(signed.select("doc_id", "place", "node"), saved(of_node, "node-classes"), "node", values, "rows", signed.count(), ["doc_id"])
    has = F.col("node").isNotNull()
    return found.select("doc_id", F.when(has, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
                        F.when(has, F.col("class_size")).otherwise(F.lit(1)).cast("long").alias("class_size"),
                        F.when(has, F.col("place") == F.col("class_place")).otherwise(F.lit(True)).alias("kept"), "place")


def near_groups(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, class_size (rows), kept."""
    return _classes(docs, threshold).drop("place")


def drop_near_copies(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that stay: of each class the row with the smallest id (and rows equal to it in id and text)."""
    gone = saved(_classes(docs, threshold).where(~F.col("kept")).select("place").distinct(), "near-copies")
    placed = docs.withColumn("_place", _place(docs))
    return placed.join(gone.withColumnRenamed("place", "_place"), "_place", "left_anti").select(*docs.columns)
