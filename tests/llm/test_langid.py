import random

import numpy as np
import pytest
from helpers import documents, prose

from tablehaul.llm import langid as L


def test_forward_backward_against_enumeration():
    import itertools
    rng = np.random.default_rng(0)
    lengths = np.array([4, 1, 3])
    emit, trans = rng.random((8, 3)) + 0.1, rng.random((3, 3)) + 0.1
    p, moved = L.marginals(emit, lengths, trans)
    want, moves, at = np.zeros((8, 3)), np.zeros((3, 3)), 0
    for n in lengths:
        total = 0
        part, steps = np.zeros((n, 3)), np.zeros((3, 3))
        for labels in itertools.product(range(3), repeat=int(n)):
            w = np.prod([emit[at + t, x] for t, x in enumerate(labels)]) * np.prod([trans[a, b] for a, b in zip(labels, labels[1:])])
            total += w
            for t, x in enumerate(labels):
                part[t, x] += w
            for a, b in zip(labels, labels[1:]):
                steps[a, b] += w
        want[at:at + n] = part / total
        moves += steps / total
        at += n
    assert np.allclose(p, want) and np.allclose(moved, moves) and np.allclose(L.posteriors(emit, lengths, trans), want)


def test_features_of_long_words_are_complete():
    words = ["a", "abcdefgh", "abcdefghi", "x" * 1000, "b"]
    cells, counts = L.features(words, {"b": 2})
    per = [3 + 2 * 1 - 1 + 0, None, None, None, None]  # one letter: 1 unigram, 2 pairs, 1 triple, 1 + 1 affixes
    assert counts[0] == 1 + 2 + 1 + 2 and counts[4] == counts[0] + 1
    assert counts[3] == 1000 + 1001 + 1000 + 8
    again, n = L.features(words[::-1], {"b": 2})
    ends, ends2 = np.cumsum(counts), np.cumsum(n)
    assert sorted(cells[:ends[0]]) == sorted(again[ends2[3]:ends2[4]])


@pytest.fixture(scope="module")
def model():
    rng = random.Random(1)
    one, two = [f"{a}um{b}" for a in "bcdf" for b in "aeio"], [f"{a}zzk{b}" for a in "lmnp" for b in "uyea"]
    return L.train([(prose(rng, 80, one), "aa") for _ in range(60)] + [(prose(rng, 80, two), "bb") for _ in range(60)]), one, two


def test_code_switched_text_is_labelled_word_by_word(model):
    model, one, two = model
    rng = random.Random(2)
    text = prose(rng, 12, one) + " " + prose(rng, 8, two) + "\n" + prose(rng, 5, one)
    p, mass = L.Labeller(model).label([text, "", prose(rng, 3, two)])
    assert p[0].argmax(axis=1).tolist() == [0] * 12 + [1] * 8 + [0] * 5
    assert p[1].shape == (0, 2) and p[2].argmax(axis=1).tolist() == [1, 1, 1]
    assert abs(mass[0].sum() - 25) < 1e-3


@pytest.mark.parametrize("block", [1, 2, 7, 1000])
def test_messages_are_carried_over_blocks(block):
    rng = np.random.default_rng(1)
    lengths = np.array([1, 3, 50, 7, 8, 120, 2])
    for k in (1, 2, 5):
        emit, trans = rng.random((lengths.sum(), k)) ** 8 + 1e-9, np.exp(2 * rng.normal(size=(k, k)))
        assert np.allclose(L.posteriors(emit, lengths, trans, block), L.marginals(emit, lengths, trans)[0], atol=1e-9)


def test_blocks_and_a_small_memo_change_nothing(model, monkeypatch):
    model, one, two = model
    rng = random.Random(3)
    texts = [prose(rng, 900, one) + " " + prose(rng, 500, two) for _ in range(4)]
    want = L.judged(texts, L.Labeller(model))
    monkeypatch.setattr(L, "MEMO_WORDS", 5)
    monkeypatch.setattr(L, "BLOCK", 7)
    got = L.judged(texts, L.Labeller(model))
    assert got[0] == want[0] == ["aa"] * 4 and np.allclose(got[1], want[1], atol=1e-4)


def test_every_label_is_learnt(spark):
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz"
    own = {f"l{k:02d}": ["".join(rng.choice(letters) for _ in range(6)) for _ in range(12)] for k in range(70)}
    rows = [(70 * i + k, prose(rng, 30, words), lang, "s") for i in range(8) for k, (lang, words) in enumerate(own.items())]
    docs = documents(spark, rows)
    out = {r.doc_id: r.lang_pred for r in L.predict(docs, L.fit(docs)).collect()}
    right = [out[i] == lang for i, _, lang, _ in rows]
    assert {out[i] for i in out} == set(own) and sum(right) / len(right) > 0.98


def test_defined_cases(spark, model):
    rows = [(1, None, "aa", "s"), (2, "", "aa", "s"), (3, "12 ... !", None, None), (None, "bumа bume", "aa", None), (5, "lzzku", None, "s"),
            (5, "lzzku", None, "s"), (6, "\N{SUPERSCRIPT TWO}", None, None)]
    df = documents(spark, rows).selectExpr("*", "'clash' as score")
    got = L.predict(df, model[0])
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "lang_pred", "score"]
    out = sorted(((r.doc_id, r.lang_pred) for r in got.collect()), key=str)
    assert out == sorted([(1, "und"), (2, "und"), (3, "und"), (None, "aa"), (5, "bb"), (5, "bb"), (6, "und")], key=str)
    assert all(0 <= r.score <= 1 for r in got.collect())
    empty = df.limit(0)
    assert L.predict(empty, L.fit(empty)).count() == 0
    unlabelled = documents(spark, [(1, "some words", None, None)])
    assert [r.lang_pred for r in L.predict(unlabelled, L.fit(unlabelled)).collect()] == ["und"]


def test_held_out_accuracy(spark, sf_dir):
    import zlib

    from tablehaul.llm.queries import QUERIES
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op9_language_id"](spark, sf_dir).collect()
    assert len(rows) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) > 0.97
