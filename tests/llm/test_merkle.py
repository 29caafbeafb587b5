import collections
import hashlib
import re

import pytest
import xxhash
from helpers import odd_texts
from pyspark.sql import functions as F

from tablehaul.llm import merkle as M
from tablehaul.llm.queries import QUERIES

WHITE = r"[ \t\n\x0b\f\r]"
HAN = "぀-ヿ㐀-鿿"
TOKEN = re.compile(f"[{HAN}]{WHITE}*|[^ \t\n\x0b\f\r{HAN}]{{1,32}}{WHITE}*|{WHITE}+")


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def hash64(x):
    return xxhash.xxh64(x.encode(), seed=42).intdigest()


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def parts_of(line):
    parts, current = [], ""
    for t in TOKEN.findall(line.replace("\x1f", "␟")):
        current += t
        if signed(hash64(t)) % (M.CUT_SHARE * (4 if len(t) <= 2 else 1)) == 0:
            parts.append(current)
            current = ""
    parts.append(current)
    return [p[k:k + M.PART_CHARS] for p in parts for k in range(0, len(p), M.PART_CHARS)]


def leaves_of(line):
    return [hash64(p) & ((1 << M.LEAF_BITS) - 1) for p in parts_of(line)]


def tree(text):
    nodes = []
    for line in text.split("\n"):
        shown = "".join(f"{x:0{M.LEAF_HEX}X}" for x in leaves_of(line))
        nodes.append((sha(sha(line) + shown), shown, line == ""))
    sections, members = [], []
    for n, node in enumerate(nodes):
        members.append(node)
        if node[0][0] == M.SECTION_END or node[2] or n == len(nodes) - 1:
            sections.append(members)
            members = []
    digests = [sha("".join(x[0] for x in s)) for s in sections]
    root = sha("".join(digests))
    short = "".join(d[:M.SHORT] + "(" + ";".join(f"{x[0][:M.SHORT]}:{x[1]}" for x in s) + ")" for d, s in zip(digests, sections))
    return f"{root[:M.ROOT]}/{short}"


def likeness(a, b):
    if a == b:
        return 1.0
    x, y = (collections.Counter(v for line in t.split("\n") for v in leaves_of(line)) for t in (a, b))
    total = sum(x.values()) + sum(y.values())
    return 2 * sum((x & y).values()) / total if total else 0.0


def want(rows):
    """What each of the rows (doc_id, text) gives, as sorted tuples."""
    def place(r):
        i, t = r
        return (i is None, [-x for x in key(i)] if i is not None else 0, signed(hash64(t or "")))

    def key(i):
        return [i] if not isinstance(i, str) else [ord(c) for c in i.ljust(12, "\0")]

    rows = sorted(rows, key=place)
    out = []
    for k, (i, t) in enumerate(rows):
        t, following = t or "", rows[(k + 1) % len(rows)][1] or ""
        cut = len(t) // 3
        edited = t[:len(t) - cut] + following[:cut]
        lines, other = t.split("\n"), edited.split("\n")
        differ = [n for n in range(max(len(lines), len(other))) if lines[n:n + 1] != other[n:n + 1]]
        out.append((i, len(t), sha(edited), tree(t), tree(edited), round(likeness(t, edited), 9), round(likeness(t, following), 9),
                    differ[0] if differ else None))
    return sorted(out, key=str)


def got(df):
    return sorted([(r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9),
                    round(r.near_next, 9), r.changed_from) for r in df.collect()], key=str)


def texts():
    lined = ["\n".join(f"Line {i}. It has words! Yes{k}" for i in range(40)) for k in range(6)]
    return odd_texts() + lined + ["with\x1funit\x1f separators \x1f\x1f here", "x" * 3000, "same " * 500, "漢字と かな" * 90, "a\tb\x0bc\x85d　e \r\n f"]


@pytest.mark.parametrize("range_rows", [1, 3, 2000])
def test_against_brute_force(spark, monkeypatch, range_rows):
    monkeypatch.setattr(M, "RANGE_ROWS", range_rows)
    rows = [(7 * i - 20, t) for i, t in enumerate(texts())]
    rows += [(5000, "twin"), (5000, "twin"), (5000, "other"), *((None, f"nobody's {k} text") for k in range(9)), (None, None), (None, "")]
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], "doc_id long, text string, root string, _range int").repartition(3)
    assert got(M.fingerprints(df)) == want(rows)


def test_ids_of_other_types(spark, monkeypatch):
    monkeypatch.setattr(M, "RANGE_ROWS", 4)
    rows = [(f"doc-{i:03d}", f"text {i} " * (i % 7)) for i in range(40)] + [(None, "x")]
    assert got(M.fingerprints(spark.createDataFrame(rows, "doc_id string, text string"))) == want(rows)
    rows = [(i / 4, f"text {i}") for i in range(30)]
    assert got(M.fingerprints(spark.createDataFrame(rows, "doc_id double, text string"))) == want(rows)


def test_single_row_empty_table_and_hot_nulls(spark, monkeypatch):
    schema = "doc_id long, text string"
    assert got(M.fingerprints(spark.createDataFrame([(1, "Some text. More of it.")], schema))) == want([(1, "Some text. More of it.")])
    assert M.fingerprints(spark.createDataFrame([], schema)).count() == 0
    monkeypatch.setattr(M, "RANGE_ROWS", 10)
    rows = [(None, f"text {i}") for i in range(200)] + [(i, f"t{i}") for i in range(20)]
    df = spark.createDataFrame(rows, schema)
    sizes = M.in_ranges(df.withColumn("_tie", F.xxhash64("text")), "doc_id").groupBy("_range").count().collect()
    assert max(r["count"] for r in sizes) < 40 and len(sizes) > 15  # rows without an id are dealt out, too
    assert got(M.fingerprints(df)) == want(rows)


def test_range_numbers(spark):
    for cuts in ([], [3], [0, 2, 4, 7], list(range(0, 100, 3))):
        rows = spark.range(-2, 105).select("id", M._range_number(F.col("id"), cuts, "bigint").alias("n")).collect()
        assert all(r.n == sum(c <= r.id for c in cuts) for r in rows)


def test_an_edit_leaves_other_sections_and_parts(spark):
    lines = [f"Paragraph number {i}." for i in range(200)]
    both = spark.createDataFrame([(0, "\n".join(lines)), (1, "\n".join(lines[:100] + ["New."] + lines[100:]))], "id long, text string")
    a, b = (set(r.sections) for r in M.with_tree(both, "text").orderBy("id").collect())
    assert len(a) > 5 and len(a - b) == 1 and len(b - a) <= 2


def test_one_long_sentence_is_compared_in_parts(spark):
    words = [f"w{i * 7919 % 5000}" for i in range(3000)]
    rows = [(i, " ".join(words[k:k + 1000])) for i, k in enumerate((0, 1000, 2000))]
    out = {r.doc_id: r for r in M.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        assert out[i].near_edited == pytest.approx(2 / 3, abs=0.06) and out[i].near_next < 0.03
        assert len(out[i].fingerprint) < 0.15 * len(t)


def test_registered_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    df = QUERIES["op10_document_fingerprints"](spark, sf_dir)
    assert got(df) == want(docs)
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    rows = df.collect()
    assert sum(len(r.fingerprint) for r in rows) < 0.16 * sum(r.n_chars for r in rows)
    long = [r for r in rows if r.n_chars > 1000 and r.fingerprint != r.edited_fingerprint]
    assert sum(r.near_edited for r in long) / len(long) > 0.55
