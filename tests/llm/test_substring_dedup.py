import random
import re

import pytest
from helpers import odd_texts, prose

from tablehaul.llm import substring_dedup as S


def brute(rows):
    """doc_id -> spans, by looking every passage up in all earlier texts."""
    first = {}
    for i, t in rows:
        if i is not None and t is not None:
            for *_, d in S.passages(t):
                first[d] = min(i, first.get(d, i))
    out = {}
    for i, t in rows:
        gone, seen = set(), {}
        for a, b, d in S.passages(t) if i is not None and t is not None else []:
            if first[d] < i or seen.get(d, b) <= a:
                gone |= set(range(a, b))
            seen.setdefault(d, b)
        edges = sorted(x for x in gone if x - 1 not in gone), sorted(x + 1 for x in gone if x + 1 not in gone)
        out[i] = list(zip(*edges))
    return out


def words_of(text):
    """(word, start, end) in lower case, as the units see them."""
    return [(m[0].lower(), m.start(), m.end()) for m in re.finditer(r"\w+", text)]


def check_windows(rows, got):
    """Every removed word lies in a run of MIN_WORDS words that stands in an earlier text, or before it in its own."""
    n = S.MIN_WORDS
    earlier = {}
    for i, t in sorted((r for r in rows if r[0] is not None and r[1]), key=lambda r: r[0]):
        ws = words_of(t)
        runs = [tuple(w[0] for w in ws[k:k + n]) for k in range(len(ws) - n + 1)]
        own = {}
        covered = set()
        for k, run in enumerate(runs):
            if earlier.get(run, i) < i or own.get(run, k) + n <= k:
                covered |= set(range(k, k + n))
            own.setdefault(run, k)
        for a, b in got[i]:
            assert all(k in covered for k, (_, s, e) in enumerate(ws) if a <= s and e <= b), (i, t[a:b])
        for run in runs:
            earlier.setdefault(run, i)


def sentence(rng, n=9):
    return prose(rng, n).capitalize() + "."


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    passage = " ".join(sentence(rng) for _ in range(8))
    texts = []
    for i in range(40):
        lines = [" ".join(sentence(rng) for _ in range(4)) for _ in range(3)]
        if i % 3 == 0:  # pasted into the middle of a paragraph
            lines[1] = lines[1] + " and " + passage + " but " + lines[2]
        if i % 5 == 0:
            lines.append("All rights are reserved by the owner of this page, always and for ever.")
        texts.append("\n".join(lines))
    texts += [texts[1], texts[2].upper()] + odd_texts()
    return list(enumerate(texts)), passage


def test_against_brute_force(spark, rows):
    data, passage = rows
    df = spark.createDataFrame([(*r, "clash") for r in data], "doc_id long, text string, removed string").repartition(3)
    got = {r.doc_id: r for r in S.cut_repeats(df).collect()}
    want = brute(data)
    for i, t in data:
        r = got[i]
        assert [tuple(s) for s in r.removed] == want[i]
        if t is None:
            assert r.text is None
            continue
        at, left = 0, ""
        for a, b in want[i]:
            left, at = left + t[at:a], b
        assert r.text == left + t[at:] and r.n_removed == len(t) - len(r.text)
    check_windows(data, want)
    middle = passage.split(". ", 1)[1]
    assert sum(middle in (r.text or "") for r in got.values()) == 1
    assert got[1].n_removed == 0 and got[40].text == "" and got[41].text == ""


def test_clean_texts_stay(spark):
    rng = random.Random(6)
    words = [f"u{i}" for i in range(5000)]
    df = spark.createDataFrame([(i, prose(rng, 200, words)) for i in range(50)], "doc_id long, text string")
    assert S.cut_repeats(df).where("n_removed > 0").count() == 0


def test_repeats_within_a_text_and_null_ids(spark):
    line = "One two three four five six seven eight nine ten eleven."
    rows = [(1, f"{line}\n{line}\n{line}"), (None, line), (None, line), (1, line), (2, f"x y z.\n{line}")]
    got = sorted(((r.doc_id, r.text) for r in S.cut_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == sorted([(1, line + "\n"), (None, line), (None, line), (1, line), (2, "x y z.\n")], key=str)


def test_drop_repeats_keeps_columns(spark):
    df = spark.createDataFrame([(1, "a b", "en", 3)], "doc_id long, text string, lang string, n_chars long")
    out = S.drop_repeats(df)
    assert out.dtypes == df.dtypes and out.count() == 1
    assert S.drop_repeats(df.limit(0)).count() == 0


@pytest.mark.parametrize("between", ["!! ", ".\n", "\n", "? and? "])
def test_short_units_are_found(spark, between):
    rng = random.Random(7)
    text = between.join(f"v{rng.randrange(10 ** 6)}" for _ in range(155))
    other = between.join(f"v{rng.randrange(10 ** 6)}" for _ in range(155))
    for t in (text, "One.\n" + text, "A sentence of several words. Two words. Another one of several. End."):
        found = S.passages(t)
        assert found[0][0] == 0 and found[-1][1] == len(t)  # every word is in a passage
        assert all(a[0] < b[0] <= a[1] or b[0] == a[0] for a, b in zip(found, found[1:]))
    df = spark.createDataFrame([(1, text), (2, other), (3, text), (4, other[:700] + "\n" + text)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in S.cut_repeats(df).collect()}
    assert (got[1], got[2], got[3]) == (text, other, "")
    assert len(got[4]) < 0.3 * len(text)  # the ends of two runs


def test_text_without_spaces_is_found(spark):
    rng = random.Random(8)
    a, b = ("".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(300)) for _ in range(2))
    df = spark.createDataFrame([(1, a), (2, b), (3, b[:100] + a[50:250])], "doc_id long, text string")
    got = {r.doc_id: r.text for r in S.cut_repeats(df).collect()}
    assert (got[1], got[2]) == (a, b) and len(got[3]) < 100


def test_every_passage_without_punctuation_is_found():
    rng = random.Random(11)
    words = [f"{rng.choice('bdfgklmnprst')}{rng.choice('aeiou')}{i}" for i in range(3000)]
    for _ in range(1500):
        passage, *around = (prose(rng, n, words[k::5]) for k, n in enumerate((51, 20, 20, 20, 20)))
        first = {S._name(p[2]) for p in S.passages(f"{around[0]} {passage} {around[1]}")}
        text = f"{around[2]} {passage} {around[3]}"
        at = text.index(passage)
        spans = S.repeated_spans(S.passages(text), first)
        assert len(spans) == 1 and at - 1 <= spans[0][0] and spans[0][1] <= at + len(passage)


def test_short_sentences_of_different_texts_are_no_passage(spark):
    """Three sentences of four words, each from another text, are no run of ten words that repeats."""
    rng = random.Random(15)
    words = [f"z{i}" for i in range(4000)]
    rows, pieces = [], []
    for i in range(30):
        short = prose(rng, 4, words).capitalize() + "."
        pieces.append(short)
        rows.append((i, f"{prose(rng, 12, words).capitalize()}. {short} {prose(rng, 12, words).capitalize()}."))
    rows += [(100 + k, " ".join(pieces[3 * k:3 * k + 3])) for k in range(10)]
    rows += [(200, "\n".join(pieces)), (201, "\n".join(pieces[:20])), (202, f"{prose(rng, 9, words)}. {pieces[0]} {pieces[1]} {pieces[2]}")]
    got = {r.doc_id: [tuple(x) for x in r.removed] for r in S.cut_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(not got[i] for i in [*range(30), *range(100, 110)])
    assert got[201] and got[202]  # pieces in the same order do repeat
    check_windows(rows, got)


def test_periodic_and_nested_repeats(spark):
    rng = random.Random(16)
    few = ["a", "b", "c"]
    rows = [(i, prose(rng, rng.randrange(0, 120), few)) for i in range(25)]
    rows += [(50, "same " * 300), (51, "same " * 9), (52, "x. " * 100), (53, "one two three four five six seven. " * 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: [tuple(x) for x in r.removed] for r in S.cut_repeats(df).collect()}
    assert got == brute(rows)
    check_windows(rows, got)
    assert sum(b - a for a, b in got[50]) > 1000 and not got[51]  # the first ten words of it stay


def test_pasted_passages_are_cut(spark):
    rng = random.Random(12)
    words = [f"p{i}" for i in range(20000)]
    passages = [prose(rng, 51, words) for _ in range(40)]
    rows = [(100 * k + i, f"{prose(rng, 30, words)} {p} {prose(rng, 30, words)}") for i, p in enumerate(passages) for k in range(2)]
    got = {r.doc_id: r.n_removed for r in S.cut_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] == 0 and got[100 + i] > 0 for i in range(40))


def test_signs_after_words_do_not_hide_a_copy():
    rng = random.Random(13)
    words = [f"s{i}" for i in range(3000)]
    lines = [prose(rng, rng.randrange(5, 30), words) + "." for _ in range(60)]
    plain = " ".join(lines)
    marked = " ".join(w + rng.choice(["###", "%%%", "&&&"]) for w in plain.split(" "))
    assert [p[2] for p in S.passages(plain)] == [p[2] for p in S.passages(marked)]


def test_long_texts_in_blocks(monkeypatch):
    rng = random.Random(14)
    text = ". ".join(prose(rng, rng.randrange(1, 40)) for _ in range(200)) + " é İ ß 中文字 \U0001f600 \U00020000x\ny"
    whole, borders = S.passages(text), S.units(text)[1:]
    for size in (1, 7, 1000):
        monkeypatch.setattr(S, "BLOCK", size)
        assert S.passages(text) == whole and S.units(text)[1:] == borders
    assert borders[1][0] == 0 and borders[1][-1] == len(text) and borders[1] == sorted(borders[1])
