"""Document fingerprints: a Merkle tree over paragraphs and sections. DataFrame functions only.

A paragraph is a line. Its lowest nodes are its parts, which end after words that a hash of the word picks (one in CUT_SHARE, a
quarter of that among one-letter words and Han characters) and after PART_CHARS characters at the latest: an edit changes the parts it
touches and leaves the others. A part's digest has LEAF_BITS bits of its hash; a paragraph's is the SHA-256 of that of its
text and its parts. Sections end where the content says so (after a blank line, or a paragraph whose digest starts with a
fixed hex digit, one in sixteen). A section's digest covers those of its paragraphs, the root those of the sections. Equal
roots mean equal texts; otherwise the differing sections, then the differing paragraphs in them, locate the edit.

The fingerprint is a string: ``root/section(paragraph:parts;paragraph:parts...)section(...)``, the root shortened to ROOT hex digits,
sections and paragraphs to SHORT, each part LEAF_HEX digits without a separator. The likeness of two trees is the share of parts in
common (Dice), each counted as often as it occurs in both; 1 for equal roots.

``with_next`` gives each row its successor in descending id order with one exchange of the texts: ranges of ids are cut at the
quantiles of a sample (at most MAX_RANGES values), each range is sorted in a task, and the first row of a range is also sent
to the end of the range before it. Each text's tree is made once, after the exchange, and passed on to the row before.

Defined cases: null text counts as empty, and has one empty paragraph without parts. Ids can be of any type that has an order; null ids
come last, in order of their texts' hashes, and are dealt over ranges by it. Rows sharing an id are neighbours, in order of their
text's hash; an id is taken to be a key, so they stay in one range. The row after the last is the first; a table of one row has
itself as the next. An empty table gives an empty result. Columns named like an added one are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROOT = 32
SHORT = 6
LEAF_HEX = 5
LEAF_BITS = 4 * LEAF_HEX
SECTION_END = "0"
RANGE_ROWS = 2000
MAX_RANGES = 16384
# Sampled ids for each range, from which its borders are taken.
SAMPLED = 20
CUT_SHARE = 12
PART_CHARS = 400
# Words with the white space after them; Han characters and kana one by one, other long words in pieces.
TOKEN = r"[぀-ヿ㐀-鿿]\s*|[^\s぀-ヿ㐀-鿿]{1,32}\s*|\s+"
SEPARATOR = "\x1f"
SEPARATOR_SHOWN = "␟"  # in its place in a text's parts; the paragraph's own digest tells them apart


def _leaves(line: Column) -> Column:
    """The parts of a paragraph, as numbers of LEAF_BITS bits."""
    def marked(t: Column) -> Column:
        h = F.xxhash64(t)
        picked = F.when(F.length(t) <= 2, F.pmod(h, F.lit(4 * CUT_SHARE))).otherwise(F.pmod(h, F.lit(CUT_SHARE))) == 0
        return F.when(picked, F.concat(t, F.lit(SEPARATOR))).otherwise(t)

    tokens = F.regexp_extract_all(F.translate(line, SEPARATOR, SEPARATOR_SHOWN), F.lit(TOKEN), F.lit(0))
    parts = F.split(F.array_join(F.transform(tokens, marked), ""), SEPARATOR)
    pieces = F.flatten(F.transform(parts, lambda s: F.when(F.length(s) <= PART_CHARS, F.array(s)).otherwise(
        F.regexp_extract_all(s, F.lit(f"(?s).{{1,{PART_CHARS}}}"), F.lit(0)))))
    mask = F.lit((1 << LEAF_BITS) - 1).cast("long")
    return F.transform(F.filter(pieces, lambda s: s != ""), lambda s: F.xxhash64(s).bitwiseAND(mask))


def with_tree(df: DataFrame, text: str, prefix: str = "") -> DataFrame:
    """Add {prefix}paragraphs and {prefix}sections (digests), {prefix}root, {prefix}fingerprint, {prefix}leaves (the parts)."""
    p = prefix
    names = [f"{p}{n}" for n in ("paragraphs", "sections", "root", "fingerprint", "leaves")]
    lines = F.transform(F.split(F.col(text), "\n"), lambda s: F.struct(F.sha2(s, 256).alias("own"), _leaves(s).alias("leaves")))
    df = df.drop(*names).withColumn("_lines", lines)
    df = df.withColumn(f"{p}leaves", F.flatten(F.transform("_lines", lambda x: x["leaves"])))
    df = df.withColumn("_shown", F.transform("_lines", lambda x: F.struct(x["own"].alias("own"), F.array_join(
        F.transform(x["leaves"], lambda y: F.lpad(F.hex(y), LEAF_HEX, "0")), "").alias("parts"))))
    df = df.withColumn("_nodes", F.transform("_shown", lambda x: F.struct(
        F.sha2(F.concat(x["own"], x["parts"]), 256).alias("digest"), x["parts"].alias("parts"),
        (x["own"] == F.sha2(F.lit(""), 256)).alias("blank"))))
    df = df.withColumn("_ends", F.filter(F.sequence(F.lit(1), F.size("_nodes")), lambda i: (
        F.startswith(F.element_at("_nodes", i)["digest"], F.lit(SECTION_END))
        | F.element_at("_nodes", i)["blank"] | (i == F.size("_nodes")))))

    def members(k: Column) -> Column:  # k: a section's number from 1
        first = F.when(k == 1, F.lit(1)).otherwise(F.try_element_at(F.col("_ends"), k - 1) + 1)
        return F.slice(F.col("_nodes"), first, F.element_at(F.col("_ends"), k) - first + 1)

    df = df.withColumn("_members", F.transform(F.sequence(F.lit(1), F.size("_ends")), members))
    df = df.withColumn(f"{p}paragraphs", F.transform("_nodes", lambda x: x["digest"]))
    df = df.withColumn(f"{p}sections", F.transform("_members", lambda m: F.sha2(F.array_join(F.transform(m, lambda x: x["digest"]), ""), 256)))
    df = df.withColumn(f"{p}root", F.sha2(F.array_join(f"{p}sections", ""), 256))
    short = F.zip_with(f"{p}sections", "_members", lambda s, m: F.concat(
        F.substring(s, 1, SHORT), F.lit("("), F.array_join(F.transform(m, lambda x: F.concat(
            F.substring(x["digest"], 1, SHORT), F.lit(":"), x["parts"])), ";"), F.lit(")")))
    df = df.withColumn(f"{p}fingerprint", F.concat(F.substring(f"{p}root", 1, ROOT), F.lit("/"), F.array_join(short, "")))
    return df.drop("_lines", "_shown", "_nodes", "_ends", "_members")


def likeness(root_a: Column, a: Column, root_b: Column, b: Column) -> Column:
    """Dice share of common parts, as a multiset; 1 for equal roots."""
    # the side is the lowest bit; sorted, equal parts are together: what one side has more often than the other differs
    both = F.array_sort(F.concat(F.transform(a, lambda x: x * 2), F.transform(b, lambda x: x * 2 + 1)))
    start = F.struct(F.lit(-1).cast("long").alias("part"), F.lit(0).alias("more"), F.lit(0).alias("differ"))

    def step(acc: Column, x: Column) -> Column:
        part, side = F.shiftright(x, 1), F.when(x % 2 == 0, 1).otherwise(-1)
        same = acc["part"] == part
        return F.struct(part.alias("part"), F.when(same, acc["more"] + side).otherwise(side).alias("more"),
                        F.when(same, acc["differ"]).otherwise(acc["differ"] + F.abs(acc["more"])).alias("differ"))

    differ = F.aggregate(both, start, step, lambda acc: acc["differ"] + F.abs(acc["more"]))
    total = F.size(a) + F.size(b)
    return F.when(root_a == root_b, F.lit(1.0)).when(total == 0, F.lit(0.0)).otherwise((total - differ).cast("double") / total)


def changed_from(mine: Column, other: Column) -> Column:
    """The first paragraph (from 0) that differs; null where none does."""
    places = F.filter(F.sequence(F.lit(1), F.greatest(F.size(mine), F.size(other))),
                      lambda i: ~F.try_element_at(mine, i).eqNullSafe(F.try_element_at(other, i)))
    return F.try_element_at(places, F.lit(1)) - 1


def _range_number(key: Column, cuts: list, kind: str) -> Column:
    """How many of the sorted cuts are at most the key, by a look at every stride-th and then at those between."""
    if not cuts:
        return F.lit(0)
    stride = max(1, int(len(cuts) ** 0.5))

    def among(values: Column) -> Column:
        return F.size(F.filter(values, lambda c: c <= key))

    coarse = among(F.lit(cuts[::stride]).cast(f"array<{kind}>"))
    inner = F.slice(F.lit(cuts).cast(f"array<{kind}>"), (coarse - 1) * stride + 1, stride)
    return F.when(coarse == 0, F.lit(0)).otherwise((coarse - 1) * stride + among(inner))


def in_ranges(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` with _range: descending ranges of the key, then those of null keys; about RANGE_ROWS rows in each."""
    total = rows.agg(F.count(key).alias("known"), F.count(F.lit(1)).alias("all")).first()
    known, unknown = total["known"], total["all"] - total["known"]
    ranges = min(MAX_RANGES, max(1, -(-known // RANGE_ROWS)))
    cuts = []
    if ranges > 1:  # a sample of about SAMPLED ids a range: a bounded number
        share = min(1.0, SAMPLED * ranges / known)
        drawn = F.pmod(F.xxhash64(key, "_tie"), F.lit(1 << 30)) < int(share * (1 << 30))
        some = sorted(r[0] for r in rows.where(F.col(key).isNotNull() & drawn).select(key).limit(2 * SAMPLED * ranges).collect())
        cuts = sorted({some[len(some) * i // ranges] for i in range(1, ranges)}) if some else []
    number = F.lit(len(cuts)) - _range_number(F.col(key), cuts, dict(rows.dtypes)[key])
    # null keys: by the leading bits of their texts' hashes, in the order of signed numbers
    bits = max(0, (min(MAX_RANGES, -(-unknown // RANGE_ROWS)) - 1).bit_length())
    half = F.shiftright("_tie", 64 - bits) + (1 << (bits - 1)) if bits else F.lit(0)
    return rows.withColumn("_range", F.when(F.col(key).isNull(), F.lit(len(cuts) + 1) + half).otherwise(number).cast("int"))


def with_next(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """``rows`` dealt by ranges and sorted in descending ``key`` order, with ``_tail`` rows: copies of the first row of the
    next range (after the last: of the first) at the end of each range, so that the row after any row is in its task.

    ``rows`` needs ``_tie``, an order among rows of one key that is a function of their content.
    """
    numbered = in_ranges(rows, key)
    # the first row of each range, by key and tie: at most 2 MAX_RANGES rows
    heads = numbered.groupBy("_range").agg(F.max(key).alias("_head"))
    ties = (numbered.select("_range", key, "_tie").join(F.broadcast(heads), "_range").where(F.col(key).eqNullSafe(F.col("_head")))
            .groupBy("_range", "_head").agg(F.min("_tie").alias("_head_tie")))
    every = Window.orderBy("_range")
    last = F.max("_range").over(Window.partitionBy())
    table = ties.withColumn("_before", F.coalesce(F.lag("_range").over(every), last))
    # identical rows: one of them stands for the head
    heads_of = numbered.join(F.broadcast(table), "_range").where(
        F.col(key).eqNullSafe(F.col("_head")) & F.col("_tie").eqNullSafe(F.col("_head_tie")))
    heads_of = heads_of.withColumn("_range", F.col("_before")).select(*numbered.columns).withColumn("_tail", F.lit(True))
    both = numbered.withColumn("_tail", F.lit(False)).unionByName(heads_of)
    return both.repartition("_range").sortWithinPartitions("_range", *_order(key))


def _order(key: str) -> list[Column]:
    return [F.col("_tail").asc(), F.col(key).desc_nulls_last(), F.col("_tie").asc()]


def edit(text: Column, other: Column) -> Column:
    """The last third of the code points replaced by as many of the other text's first (or all)."""
    size = F.length(text)
    cut = F.floor(size / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), size - cut), F.substring(other, F.lit(1), cut))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row: the id, the tree of its text and of its edited text, and the likeness to that and to the next row."""
    base = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    trees = with_tree(with_next(base.withColumn("_tie", F.xxhash64("text"))), "text")
    at = Window.partitionBy("_range").orderBy(*_order("doc_id"))
    linked = trees.withColumns({f"next_{c}": F.lead(c).over(at) for c in ("text", "root", "leaves")}).where(~F.col("_tail"))
    linked = linked.withColumn("edited_text", edit(F.col("text"), F.col("next_text"))).drop("next_text")
    edited = with_tree(linked, "edited_text", "edited_")
    return (edited.withColumn("n_chars", F.length("text").cast("long"))
            .withColumn("edited_sha256", F.sha2("edited_text", 256))
            .withColumn("near_edited", likeness(F.col("root"), F.col("leaves"), F.col("edited_root"), F.col("edited_leaves")))
            .withColumn("near_next", likeness(F.col("root"), F.col("leaves"), F.col("next_root"), F.col("next_leaves")))
            .withColumn("changed_from", changed_from(F.col("paragraphs"), F.col("edited_paragraphs")))
            .drop("_tie", "_range", "_tail", "next_root", "next_leaves"))
