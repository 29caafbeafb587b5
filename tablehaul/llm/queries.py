"""Registered queries of the training-data operators, one per operator, over whole tables.

``ORACLES`` has DuckDB SQL where SQL can express the result; the other queries are tested against
brute-force versions in ``tests/llm``.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from . import (
    exact_dedup,
    hard_negatives,
    html_text,
    langid,
    merkle,
    near_dedup,
    packing,
    prefix_trie,
    quality,
    sharding,
    spm,
    substring_dedup,
    url_filter,
)
from .common import read, saved

QUERIES: dict = {}
ORACLES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# ---- 1 URL filter -------------------------------------------------------------------

URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]
# Host labels whose URLs the block list names; stands in for a bought or curated list of URLs.
LISTED_LABELS = "(^|[.])(casino-win|cheap-pills|free-bets|ads-track)[.]"


def listed_urls(pages):
    """The canonical URLs of the block list."""
    url = url_filter.canonical(F.col("url"))
    return pages.where(F.rlike(url_filter.host_path(F.col("url"))[0], F.lit(LISTED_LABELS))).select(url.alias("url"))


@query
def op1_url_filter(spark, sf_dir):
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    out = url_filter.judge(pages, listed_urls(pages), URL_RULES)
    return out.select("page_id", "host", "path", "rule", "verdict")


ORACLES["op1_url_filter"] = """
WITH split AS (
  SELECT page_id, coalesce(url, '') AS url, strpos(coalesce(url, ''), '://') AS pos FROM pages),
rest AS (SELECT *, CASE WHEN pos > 0 THEN substr(url, pos + 3) ELSE '' END AS rest FROM split),
cut AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS raw_host FROM rest),
parts AS (SELECT *,
    translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') AS path,
    list_sort(list_filter(string_split(regexp_extract(url, '^[^?#]*[?]([^#]*)', 1), '&'),
      lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid)(=.*)?$'))) AS params
  FROM cut),
keyed AS (SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^www[.]', '')
    || regexp_replace(path, '/+$', '')
    || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END END AS canonical
  FROM parts),
listed AS (SELECT DISTINCT canonical AS url FROM keyed WHERE canonical IS NOT NULL
    AND regexp_matches(host, '(^|[.])(casino-win|cheap-pills|free-bets|ads-track)[.]')),
ruled AS (SELECT k.*, l.url IS NOT NULL AS is_listed, CASE
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM keyed k LEFT JOIN listed l ON k.canonical = l.url)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
  WHEN rule IS NOT NULL OR is_listed THEN 'block' ELSE 'allow' END AS verdict FROM ruled
"""


# ---- 2 sharding ---------------------------------------------------------------------

SHARDS = 40


@query
def op2_sharding(spark, sf_dir):
    out = sharding.shuffle_into_shards(read(spark, sf_dir, "documents"), SHARDS)
    text = F.col("text")
    return out.select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(16)).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), F.col("shard").cast("int"), F.col("slot").cast("long"),
        F.lit(None).cast("int").alias("grown_shard"))


# ---- 3 exact dedup ------------------------------------------------------------------

@query
def op3_exact_dedup(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = exact_dedup.exact_groups(docs)
    return out.select("doc_id", "keep_id", F.col("group_size").cast("long"), "kept", "text_sha256")


ORACLES["op3_exact_dedup"] = """
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256 FROM n
"""


# ---- 5 packing ----------------------------------------------------------------------

def tokenizer_path(name: str) -> str:
    """Vocabulary files come with an installed package, on every machine; never copied here."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op5_packing(spark, sf_dir):
    out = packing.pack(read(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


# ---- 10 document fingerprints -------------------------------------------------------

@query
def op10_document_fingerprints(spark, sf_dir):
    out = merkle.fingerprints(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
                      "near_next", "changed_from")


# ---- 9 language ID ------------------------------------------------------------------

@query
def op9_language_id(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = langid.predict(docs.select("doc_id", "text"), langid.fit(docs), keep=["doc_id"])
    return out.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


# ---- 7 MinHash near-dedup -----------------------------------------------------------

@query
def op7_near_dedup(spark, sf_dir):
    return near_dedup.near_groups(read(spark, sf_dir, "documents"))


# ---- 6 substring dedup --------------------------------------------------------------

@query
def op6_substring_dedup(spark, sf_dir):
    out = substring_dedup.cut_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "text", "removed", "n_removed")


# ---- 8 SentencePiece encoding and decoding ------------------------------------------

@query
def op8_sentencepiece(spark, sf_dir):
    """The public model is a BPE one, so this query's path has merges; unigram scores are run by the tests, on a model written by hand."""
    path = tokenizer_path("piece_bpe_32k.model")
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("text_sha256", F.sha2("text", 256))
    out = spm.encode(docs, path, keep=["doc_id", "text_sha256"], decoded=True)
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"),
                      "parity", F.length("decoded").cast("long").alias("decoded_chars"),
                      (F.sha2("decoded", 256) == F.col("text_sha256")).alias("round_trip"))


# ---- 4 HTML extraction --------------------------------------------------------------

@query
def op4_html_extraction(spark, sf_dir):
    out = html_text.extract(read(spark, sf_dir, "pages"), keep=["page_id", "url"])
    return out.withColumn("n_chars", F.length("text").cast("long"))


# ---- 13 hard-negative mining --------------------------------------------------------

@query
def op13_hard_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = read(spark, sf_dir, "embeddings").withColumn("label", label)
    return hard_negatives.mine(rows, F.col("vec_id") % 50 == 0)


ORACLES["op13_hard_negatives"] = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (SELECT a.vec_id AS anchor_id, v.vec_id AS other, v.label = a.label AS same,
    CAST(list_inner_product(a.q, v.q) AS BIGINT) AS score
  FROM v a JOIN v ON a.vec_id <> v.vec_id WHERE a.vec_id % 50 = 0),
positives AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER fit AS INTEGER) AS rank, other AS negative_id, positive_score,
  score AS negative_score
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW fit AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)
QUALIFY row_number() OVER fit <= 3
"""


# ---- 11 conversation prefix trie ----------------------------------------------------

FAMILY = 5
MOST_SHARED = 9


def rebuilt_conversations(conversations):
    """Rows (conv_id, position, digest, size): every conversation c with the first h turns of c - c % 5 in place of
    its own first h, h = crc32(c) % 9; and a row without a position for each. Equal turn numbers come in order of their digests."""
    turns = conversations.where("conv_id IS NOT NULL").select(
        "conv_id", "turn", prefix_trie.turn_digest(["role", "text"]).alias("digest"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "digest")
    numbered = saved(turns.withColumn("position", F.row_number().over(order) - 1).drop("turn"), "conversations")
    head = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(MOST_SHARED))
    own = numbered.where(F.col("position") >= head)
    every = numbered.where("position = 0").select("conv_id")
    near = F.sequence(F.col("base") - (FAMILY - 1), F.col("base") + (FAMILY - 1))
    lent = (numbered.where((F.col("conv_id") % FAMILY == 0) & (F.col("position") < MOST_SHARED)).withColumnRenamed("conv_id", "base")
            .withColumn("conv_id", F.explode(near)).where(F.col("conv_id") - F.col("conv_id") % FAMILY == F.col("base"))
            .where(F.col("position") < head).drop("base").join(every, "conv_id", "left_semi"))
    columns = ["conv_id", "position", "digest", "size"]
    alone = every.select("conv_id", F.lit(None).cast("int").alias("position"), F.lit(None).cast("binary").alias("digest"),
                         F.lit(0).cast("long").alias("size"))
    return own.select(*columns).unionByName(lent.select(*columns)).unionByName(alone)


@query
def op11_prefix_trie(spark, sf_dir):
    out = prefix_trie.trie(rebuilt_conversations(read(spark, sf_dir, "conversations")))
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


ORACLES["op11_prefix_trie"] = """
WITH RECURSIVE bits AS (
  SELECT i, 0 AS k, i AS v FROM (SELECT unnest(range(256)) AS i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8),
step AS (SELECT i, v FROM bits WHERE k = 8),
crc AS (
  SELECT conv_id AS c, CAST(conv_id AS VARCHAR) AS s, 0 AS k, CAST(4294967295 AS BIGINT) AS v
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)
  UNION ALL
  SELECT c, s, crc.k + 1, xor(crc.v >> 8, step.v)
  FROM crc JOIN step ON step.i = xor(crc.v & 255, ascii(substr(s, crc.k + 1, 1))) WHERE crc.k < length(s)),
heads AS (SELECT c, xor(v, 4294967295) % 9 AS h FROM crc WHERE k = length(s)),
turns AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
rebuilt AS (
  SELECT heads.c, pos, role, text FROM heads JOIN turns ON turns.c = heads.c - heads.c % 5 WHERE pos < h
  UNION ALL
  SELECT heads.c, pos, role, text FROM heads JOIN turns ON turns.c = heads.c WHERE pos >= h),
placed AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY pos) AS d, strlen(text) AS size,
    sha256(length(role) || ':' || role || length(text) || ':' || text) AS turn FROM rebuilt),
paths AS (SELECT c, d, size, sha256(string_agg(turn, '/') OVER (PARTITION BY c ORDER BY d)) AS node FROM placed
  UNION ALL SELECT c, 0, 0, 'root' FROM heads),
linked AS (SELECT *, lag(node) OVER (PARTITION BY c ORDER BY d) AS parent,
    d = max(d) OVER (PARTITION BY c) AS is_last FROM paths),
nodes AS (SELECT node, min(c) AS conv_id, max(d) AS depth, any_value(parent) AS parent, count(*) AS n_convs,
    any_value(size) AS size,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE is_last), '')) AS ends_sha256
  FROM linked GROUP BY node),
children AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
under AS (SELECT DISTINCT a.node AS top, b.node FROM paths a JOIN paths b ON a.c = b.c AND b.d >= a.d),
sums AS (SELECT top, count(*) FILTER (WHERE n_children IS NULL) AS n_leaves, CAST(sum((n_convs - 1) * size) AS BIGINT) AS saved_tokens
  FROM under JOIN nodes USING (node) LEFT JOIN children USING (node) GROUP BY top)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children,
  n_leaves, saved_tokens, n.ends_sha256
FROM nodes n JOIN sums ON sums.top = n.node LEFT JOIN children ch ON ch.node = n.node LEFT JOIN nodes p ON p.node = n.parent
"""


# ---- 12 quality classifier ----------------------------------------------------------

@query
def op12_quality(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").select("doc_id", "quality")
    out = quality.predict(docs, quality.fit(docs, labels), keep=["doc_id"])
    return out.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
