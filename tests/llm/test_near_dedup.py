import random

import numpy as np
import pytest
from helpers import near_classes, odd_texts, prose

from tablehaul.llm import near_dedup as N


def edited(rng, text, share):
    words = text.split()
    for k in rng.sample(range(len(words)), int(share * len(words))):
        words[k] = "x%d" % rng.randrange(10**6)
    return " ".join(words)


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(0)
    element = rng.integers(0, 2**63, 300, dtype=np.uint64)
    for weights in (np.ones(300), rng.integers(1, 9, 300).astype(float), rng.random(300) * 5 + 0.01):
        other = np.where(rng.random(300) < 0.3, weights * rng.random(300) + 0.005, weights)
        keep = rng.random(300) < 0.9
        true = np.minimum(weights, other * keep).sum() / np.maximum(weights, other * keep).sum()
        s = N.signatures([element, element[keep]], [weights, other[keep]], 4096)
        assert abs((s[0] == s[1]).mean() - true) < 0.03


def test_signature_of_one_text_does_not_depend_on_the_others():
    rng = np.random.default_rng(1)
    sets = [rng.integers(0, 2**63, n, dtype=np.uint64) for n in (1, 2, 50, 3000)]
    weights = [np.ones(len(s)) for s in sets]
    together = N.signatures(sets, weights)
    for s, w, row in zip(sets, weights, together):
        assert (N.signatures([s], [w])[0] == row).all()


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    texts = odd_texts()
    for g in range(6):  # an original, near copies, and copies of near copies
        base = prose(rng, rng.choice([60, 150, 400]), [f"v{i}" for i in range(400)])
        texts += [base] + [edited(rng, base, rng.choice([0.005, 0.01, 0.02, 0.03, 0.04])) for _ in range(12)]
        far = edited(rng, base, 0.035)
        texts += [edited(rng, far, 0.01) for _ in range(5)] + [far, far]
    texts += [prose(rng, 80, [f"q{i}" for i in range(900)]) for _ in range(40)]
    return list(enumerate(texts))


def test_against_brute_force(spark, rows):
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, class_id string").repartition(4)
    got = N.near_groups(df).collect()
    want = near_classes(rows)
    assert {r.doc_id: r.class_id for r in got} == want and len(got) == len(rows)
    sizes = {}
    for c in want.values():
        sizes[c] = sizes.get(c, 0) + 1
    assert all(r.class_size == sizes[r.class_id] and r.kept == (r.doc_id == r.class_id) for r in got)


def test_components_of_a_long_chain(spark):
    names = [f"n{i:03d}" for i in range(60)]
    random.Random(1).shuffle(names)
    links = spark.createDataFrame(list(zip(names[:-1], names[1:])) + [("z1", "z2")], "a string, b string")
    got = {r.node: r.label for r in N.components(links).collect()}
    assert got == {**{n: "n000" for n in names}, "z1": "z1", "z2": "z1"}


def test_more_links_join_components(spark):
    labels = spark.createDataFrame([("a", "a"), ("b", "a"), ("c", "c"), ("d", "c"), ("y", "x"), ("x", "x")], "node string, label string")
    more = spark.createDataFrame([("b", "d"), ("d", "z"), ("p", "q")], "a string, b string")
    got = sorted(tuple(r) for r in N._merged(labels, more).collect())
    assert got == [*((n, "a") for n in "abcd"), ("p", "p"), ("q", "p"), ("x", "x"), ("y", "x"), ("z", "a")]


def test_few_tables_are_written(spark, rows, monkeypatch):
    tags, save = [], N.saved
    monkeypatch.setattr(N, "saved", lambda df, tag: tags.append(tag) or save(df, tag))
    star = spark.createDataFrame([("c", f"n{i}") for i in range(9)] + [("b", "c")], "a string, b string")
    assert {r.label for r in N.components(star).collect()} == {"b"} and len(tags) <= 4
    tags.clear()
    N.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len([t for t in tags if t not in ("labels", "heard", "links", "label-links")]) <= 16


def test_among_keeps_all_wanted_keys_and_few_others(spark, monkeypatch):
    df = spark.range(40000).selectExpr("if(id < 39990, concat('k', id), null) AS key", "id")
    wanted = df.where("id % 40 = 0").select("key")
    wanted = wanted.union(wanted)
    for bits, most in ((N.FILTER_BITS, 1020), (1 << 15, 3500), (1 << 3, 40000)):  # too few bits only keep more
        monkeypatch.setattr(N, "FILTER_BITS", bits)
        got = [r.id for r in N.among(df, "key", wanted).collect()]
        assert len(got) == len(set(got)) <= most and {i for i in range(0, 39990, 40)} <= set(got)
    assert N.among(df, "key", wanted.limit(0)).isEmpty()


def test_rows_without_a_mate_are_dropped_before_the_shuffles(spark, rows, monkeypatch):
    plans, save = {}, N.saved
    monkeypatch.setattr(N, "saved", lambda df, tag: plans.setdefault(tag, df._jdf.queryExecution().optimizedPlan().toString()) and save(df, tag))
    monkeypatch.setattr(N, "FILTER_BITS", 1 << 10)  # other keys share bits: the exact join must follow
    got = {r.doc_id: r.class_id for r in N.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == near_classes(rows)
    assert all("Join LeftSemi" in plans[tag] and "rightHint=(strategy=broadcast)" in plans[tag] for tag in ("mates", "shingle-sets"))


def test_null_and_repeated_ids(spark):
    rng = random.Random(2)
    a, b = prose(rng, 80), prose(rng, 80, [f"k{i}" for i in range(300)])
    rows = [(None, a), (None, a), (3, a), (3, a), (None, b), (4, None), (4, None), (None, None)]
    got = sorted(((r.doc_id, r.class_id, r.class_size, r.kept) for r in
                  N.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == sorted([(None, 3, 4, False)] * 2 + [(3, 3, 4, True)] * 2 + [(None, None, 1, True)] + [(4, 4, 1, True)] * 2
                         + [(None, None, 1, True)], key=str)


def test_drop_near_copies(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = near_classes(rows)
    assert sorted(r.doc_id for r in N.drop_near_copies(df).collect()) == sorted(set(want.values()))
    assert N.near_groups(df.limit(0)).count() == 0


def test_clean_rows_that_share_an_id_with_a_copy_stay(spark):
    rng = random.Random(3)
    a, b, c = (prose(rng, 80, [f"{k}{i}" for i in range(300)]) for k in "xyz")
    rows = [(1, a), (2, a + " more"), (2, b), (None, b + " end"), (None, c), (None, c + " and"), (7, None), (7, a + " here")]
    out = N.drop_near_copies(spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, place int")).collect()
    assert sorted(r.place for r in out if r.doc_id is not None) == [0, 2, 6]  # 1 and 7 are copies, 2 is not
    alone = [r.place for r in out if r.doc_id is None]
    assert len(alone) == 1 and alone[0] in (4, 5)  # of two copies without an id one stays
