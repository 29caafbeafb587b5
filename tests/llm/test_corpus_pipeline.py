import collections
import random
import re
import zlib

import corpus_pipeline as C
import numpy as np
import public_tokenizers
from helpers import documents, near_classes, odd_texts, prose, tables
from test_substring_dedup import brute as repeated
from tokenizers import Tokenizer

from tablehaul.llm.queries import QUERIES


def rows():
    rng = random.Random(9)
    out = []
    for i in range(60):
        words = [f"{rng.choice('bdf')}um{k}" for k in range(400)] if i % 2 else [f"{rng.choice('lmn')}zzk{k}" for k in range(400)]
        text = "\n".join(prose(rng, 14, words).capitalize() + "." for _ in range(5))
        out.append((i, text, "aa" if i % 2 else "bb", "s"))
    out += [(100, out[3][1].upper(), "aa", "s"), (101, out[4][1] + " end", "bb", "s"), (102, "123 456", None, None), (103, None, None, None)]
    return out


def test_stages(spark, tmp_path):
    data = rows()
    sf_dir = tables(spark, tmp_path, documents=documents(spark, data))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [n for n, _ in C.STAGES] == ["language_id", "exact_dedup", "near_dedup", "substring_dedup", "packing"]
    left = {}
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.dtypes == docs.dtypes
        docs = spark.createDataFrame(out.collect(), out.schema)
        left[name] = {r.doc_id: r.text for r in docs.collect()}
    assert set(left["language_id"]) == set(range(60)) | {100, 101}
    assert set(left["language_id"]) - set(left["exact_dedup"]) == {3}  # of equal texts the largest id stays
    classes = near_classes(sorted(left["exact_dedup"].items()))
    assert set(left["near_dedup"]) == set(classes.values()) and 101 not in left["near_dedup"]
    assert left["substring_dedup"] == left["near_dedup"]  # nothing else repeats: clean texts stay whole


def test_run(spark, tmp_path):
    sf_dir = tables(spark, tmp_path, documents=documents(spark, rows()))
    pieces = C.run(spark, sf_dir).collect()
    per_doc = {}
    for r in pieces:
        per_doc[r.doc_id] = per_doc.get(r.doc_id, 0) + r.length
        assert r.offset + r.length <= 2048
    assert set(per_doc) == (set(range(60)) - {3}) | {100}
    assert all(per_doc[r.doc_id] == r.doc_tokens for r in pieces)


def brute(data):
    """doc_id -> text that is packed, by plain Python: languages by letters (each text here is in one), copies and classes by comparing
    all texts, repeats by looking every passage up in all earlier texts."""
    texts = {i: t for i, t, *_ in data if t and re.search(r"[^\W\d_]", t)}
    groups = collections.defaultdict(list)
    for i, t in texts.items():
        groups[re.sub("[A-Z]", lambda m: m[0].lower(), t)].append(i)
    texts = {max(ids): texts[max(ids)] for ids in groups.values()}
    classes = near_classes(sorted(texts.items()))
    texts = {i: t for i, t in texts.items() if classes[i] == i}
    spans = repeated(sorted(texts.items()))
    out = {}
    for i, t in texts.items():
        left, at = "", 0
        for a, b in spans[i]:
            left, at = left + t[at:a], b
        if (left + t[at:]).strip(" "):
            out[i] = left + t[at:]
    return out


def test_run_against_brute_force(spark, tmp_path):
    rng = random.Random(10)
    passage = prose(rng, 60, [f"dum{k}" for k in range(500)]).capitalize() + "."
    data = rows()
    data += [(200 + k, f"{data[2 * k + 1][1]}\n{passage}\n{prose(rng, 30, [f'fum{x}' for x in range(500)])}.", "aa", "s") for k in range(4)]
    data += [(300, passage, "aa", "s"), (301, passage.lower(), "aa", "s"), (302, "", "aa", "s"), (303, prose(rng, 3000, [f"gum{k}" for k in range(900)]), "aa", "s")]
    want = brute(data)
    assert 300 not in want and 301 not in want and len(want[201]) < 300  # copies, passages and repeats do go
    sf_dir = tables(spark, tmp_path, documents=documents(spark, data))
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {i: np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], "<u4") for i, t in want.items()}
    covered, filled = collections.defaultdict(list), collections.defaultdict(list)
    for r in C.run(spark, sf_dir).collect():
        part = ids[r.doc_id][r.start:r.start + r.length]
        assert len(part) == r.length > 0 and zlib.crc32(part.tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
        covered[r.doc_id].append((r.start, r.length))
        filled[r.sequence_id].append((r.offset, r.length))
    assert set(covered) == set(want)
    for spans, size in [(s, len(ids[i])) for i, s in covered.items()] + [(s, None) for s in filled.values()]:
        at = 0
        for start, n in sorted(spans):  # without gaps or overlaps
            assert start == at
            at += n
        assert at == size if size is not None else at <= 2048
    assert len(filled) == -(-sum(map(len, ids.values())) // 2048)  # one group of documents: only the last sequence has room


def test_odd_and_empty_tables(spark, tmp_path):
    data = [(i, t, None if i % 3 else "aa", None) for i, t in enumerate(odd_texts())]
    some = tables(spark, tmp_path / "a", documents=documents(spark, data * 2))
    assert C.run(spark, some).count() > 0
    none = tables(spark, tmp_path / "b", documents=documents(spark, data).limit(0))
    assert C.run(spark, none).count() == 0


def test_every_operator_has_a_query():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
