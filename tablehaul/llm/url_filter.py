"""URL filter: a blocked Bloom filter in front of an exact join with the listed URLs.

``build_filter`` folds the canonical listed URLs into blocks of 512 bits (eight words of 64 bits, one bit
set per word). ``listed`` probes every URL against its one block. URLs that the filter rules out are
settled there; possible hits go on to an exact hash join on the canonical URL, which removes the false
positives. ``judge`` puts host and path rules on top.

Scale: the filter has at most MAX_BLOCKS blocks (16 MB), whatever the list's size, so it is broadcast. A
list too long for that only lets more URLs through to the exact join, which takes any size; a hot URL is
split there by the skew join.

Defined cases: a null URL or one without ``://`` has empty host and path and is never listed; repeated
URLs are judged alike, row by row; an empty list lists nothing; other columns pass through, and a column
named like an added one is replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, saved

WORDS = 8
BLOCK_BITS = 64 * WORDS
BITS_PER_URL = 16
MAX_BLOCKS = 1 << 18

# Query parameters that don't change the page; fixed values.
TRACKING = "^(utm_[^=]*|ref|fbclid|gclid)(=.*)?$"


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    raw_host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw_host) + 1, F.length(rest)), "^[^?#]*", 0)
    return ascii_lower(raw_host), path


def canonical(url: Column) -> Column:
    """Host without a leading www., path without trailing slashes, and the query without tracking
    parameters, its rest sorted. Null without a host."""
    host, path = host_path(url)
    host = F.regexp_replace(host, r"^www\.", "")
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"),
                                 lambda p: (p != "") & ~F.rlike(p, F.lit(TRACKING))))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit(""))
    return F.when(host != "", F.concat(host, F.regexp_replace(path, "/+$", ""), tail))


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks))


def _masks(url: Column) -> list[Column]:
    """One bit in each of the block's words, from six hash bits a word."""
    h = F.xxhash64(F.lit("bit"), url)
    return [F.call_function("shiftleft", F.lit(1).cast("long"),
                            F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
            for i in range(WORDS)]


def build_filter(urls: DataFrame, blocks: int) -> DataFrame:
    """``urls(url)`` canonical -> one row per used block: block, w0..w7."""
    masks = _masks(F.col("url"))
    cells = urls.select(_block(F.col("url"), blocks).alias("block"), *[m.alias(f"w{i}") for i, m in enumerate(masks)])
    return cells.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def blocks_for(n_urls: int) -> int:
    return min(MAX_BLOCKS, max(1, -(-n_urls * BITS_PER_URL // BLOCK_BITS)))


def may_be_listed(rows: DataFrame, bloom: DataFrame, blocks: int, url: str = "_canonical") -> DataFrame:
    """``rows`` with ``_maybe``: false only where the canonical URL is surely not in the filter."""
    probe = rows.withColumn("_block", _block(F.col(url), blocks))
    words = bloom.select(F.col("block").alias("_block"), *[F.col(f"w{i}").alias(f"_w{i}") for i in range(WORDS)])
    hit = F.lit(True)
    for i, m in enumerate(_masks(F.col(url))):
        hit = hit & (F.col(f"_w{i}").bitwiseAND(m) == m)
    found = F.coalesce(hit & F.col(url).isNotNull(), F.lit(False))
    return (probe.join(F.broadcast(words), "_block", "left")
            .withColumn("_maybe", found)
            .drop("_block", *[f"_w{i}" for i in range(WORDS)]))


def listed(rows: DataFrame, urls: DataFrame, url: str = "url", flag: str = "listed") -> DataFrame:
    """``rows`` with ``flag``: whether the canonical form of ``url`` is among the canonical ``urls(url)``."""
    index = saved(urls.where(F.col("url").isNotNull()).select("url").distinct(), "listed-urls")
    blocks = blocks_for(index.count())
    bloom = saved(build_filter(index, blocks), "url-bloom")
    base = rows.drop(flag).withColumn("_canonical", canonical(F.col(url)))
    probed = may_be_listed(base, bloom, blocks)
    sure = probed.where(~F.col("_maybe")).withColumn(flag, F.lit(False))
    exact = index.select(F.col("url").alias("_listed_url"))
    hits = (probed.where(F.col("_maybe"))
            .join(exact, F.col("_canonical") == F.col("_listed_url"), "left")
            .withColumn(flag, F.col("_listed_url").isNotNull())
            .drop("_listed_url"))
    return sure.unionByName(hits).drop("_canonical", "_maybe")


def judge(pages: DataFrame, urls: DataFrame, rules: Sequence[tuple[str, str, str]], url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule and verdict.

    ``rules``: (verdict, host, path). A rule fits its host and all subdomains where the path starts with
    the rule's path; the longest fitting rule decides (ties: the longer host). Where none fits, a
    listed URL is blocked and any other allowed.
    """
    out = listed(pages, urls, url, "listed")
    host, path = host_path(F.col(url))
    out = out.drop("host", "path", "rule", "verdict").withColumns({"host": host, "path": path})
    rule, verdict = F.lit(None).cast("string"), F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    # from the shortest to the longest, so the longest is tested first
    for decision, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), len(r[1]))):
        fits = (((F.col("host") == rule_host) | F.endswith(F.col("host"), F.lit("." + rule_host)))
                & F.startswith(F.col("path"), F.lit(rule_path)))
        rule = F.when(fits, F.lit(rule_host + rule_path)).otherwise(rule)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return out.withColumns({"rule": rule, "verdict": verdict})
