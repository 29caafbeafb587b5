import collections
import random

import numpy as np
import public_tokenizers
import pytest
from helpers import odd_texts, prose
from tokenizers import Tokenizer

from tablehaul.llm import packing as P

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_word_encoding_equals_the_library(tokenizer):
    rng = random.Random(1)
    alphabet = list("abcdefIJKsStTreÀéßªº0129 \t\n.,!?'«»×÷") + list(
        "\N{GREEK CAPITAL LETTER SIGMA}\N{GREEK SMALL LETTER FINAL SIGMA}\N{LATIN CAPITAL LETTER I WITH DOT ABOVE}"
        "\N{LATIN SMALL LETTER DOTLESS I}\N{SUPERSCRIPT TWO}\N{VULGAR FRACTION ONE QUARTER}\N{NO-BREAK SPACE}"
        "\N{COMBINING ACUTE ACCENT}\N{EM DASH}\N{EURO SIGN}\N{CJK UNIFIED IDEOGRAPH-4E2D}\N{GRINNING FACE}\x0b\x1f\x85")
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 50))) for _ in range(3000)]
    texts += ["it's we'll '''s don't", "<|endoftext|> a <| b", "a" * 500, ""]
    encoder = P.WordEncoder(PATH)
    want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts]
    assert [encoder.encode(t) for t in texts] == want
    assert [encoder.encode(t) for t in texts] == want  # from the memo


def test_full_memo_changes_nothing(monkeypatch):
    rng = random.Random(2)
    texts = [prose(rng, 50) for _ in range(20)]
    whole, small = P.WordEncoder(PATH), P.WordEncoder(PATH)
    want = [whole.encode(t) for t in texts]
    monkeypatch.setattr(P, "MEMO_WORDS", 20)
    assert [small.encode(t) for t in texts] == want and len(small) == 20


@pytest.mark.parametrize("seed", range(5))
def test_pack_lengths(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([1, 2, 100, 2047, 2048, 2049, 5000, rng.randint(1, 3000)]) for _ in range(rng.randint(0, 300))]
    pieces = P.pack_lengths(lengths, 2048)
    covered, filled = collections.defaultdict(list), collections.defaultdict(list)
    for d, start, n, sequence, offset in pieces:
        covered[d].append((start, n))
        filled[sequence].append((offset, n))
    for d, n in enumerate(lengths):  # each id in exactly one piece
        at = 0
        for start, size in sorted(covered[d]):
            assert start == at and size > 0
            at += size
        assert at == n
    for spans in filled.values():  # gapless, within the capacity
        at = 0
        for offset, size in sorted(spans):
            assert offset == at
            at += size
        assert at <= 2048
    assert len(filled) * 2048 - sum(lengths) < 2048


def test_costs_are_balanced():
    rng = random.Random(4)
    lengths = [rng.randint(50, 900) for _ in range(600)]
    spent = collections.Counter()
    for _, _, n, sequence, _ in P.pack_lengths(lengths, 2048):
        spent[sequence] += P.cost(n)
    costs = sorted(spent.values())[1:]  # one sequence may be short
    assert costs[-1] < 1.5 * costs[0]


def test_frame(spark, tokenizer):
    texts = odd_texts()
    rows = [(None if i == 3 else i, t, "x") for i, t in enumerate(texts)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, offset string")
    got = P.pack(df, PATH).collect()
    per_doc = collections.Counter()
    for r in got:
        assert len(r.ids) == 4 * r.length
        per_doc[r.doc_id] += r.length
    for i, t, _ in rows[:len(texts)]:
        assert per_doc[i] == 2 * (len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1)
    one = [r for r in got if r.doc_id == 10]  # a very long text, whole and in order
    ids = tokenizer.encode(texts[10], add_special_tokens=False).ids + [1]
    for r in one:
        assert np.frombuffer(r.ids, "<u4").tolist() == ids[r.start:r.start + r.length] and r.doc_tokens == len(ids)
    assert P.pack(df.limit(0), PATH).count() == 0


def test_long_documents_make_more_groups(spark, monkeypatch):
    rng = random.Random(6)
    df = spark.createDataFrame([(i, prose(rng, 2000)) for i in range(40)], "doc_id long, text string")
    assert {r.sequence_id >> 32 for r in P.pack(df, PATH).collect()} == {0}
    monkeypatch.setattr(P, "GROUP_BYTES", 100_000)
    out = P.pack(df, PATH).collect()
    assert len({r.sequence_id >> 32 for r in out}) >= 3 and sum(r.length for r in out) == sum({r.doc_id: r.doc_tokens for r in out}.values())
