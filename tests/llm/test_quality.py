import random
import zlib

import numpy as np
import pytest
from helpers import documents, odd_texts, prose

from tablehaul.llm import quality as Q
from tablehaul.llm.queries import QUERIES


def brute_pairs(text):
    kinds = [int(Q.CLASSES[b]) for b in text.encode()]
    out = np.zeros((Q.KINDS, Q.KINDS))
    for a, b in zip(kinds, kinds[1:]):
        out[a, b] += 1
    return np.sqrt(out / max(1, len(kinds) - 1)).ravel()


@pytest.mark.parametrize("window", [1 << 21, 64, 7])
def test_features_of_whole_texts(monkeypatch, window):
    monkeypatch.setattr(Q, "WINDOW", window)
    texts = [t for t in odd_texts() if len(t or "") < 5000] + ["", "ab " * 40]
    got = Q.features(texts)
    for row, text in zip(got, texts):
        assert np.allclose(row[:Q.KINDS ** 2], brute_pairs(text or ""), atol=1e-6)
    words = "a b b b C".split()
    assert np.allclose(Q.features(["a b b\nb C"])[0, -Q.DENSE:], [np.log1p(5), 3 / 5, 1, 3 / 5, np.log1p(9 / 5), 2 / 5]) and len(words) == 5
    assert Q.features([]).shape == (0, Q.WIDTH) and not Q.features([None, ""]).any()


def mixture(n_p, n_u, prior, seed=0):
    rng = np.random.default_rng(seed)

    def draw(n, good):
        x = rng.normal(size=(n, 6)).astype(np.float32)
        x[:, 0] += 4 if good else -1
        return x

    truth = rng.random(n_u) < prior
    u = np.where(truth[:, None], draw(n_u, True), draw(n_u, False))
    return draw(n_p, True), u, truth


@pytest.mark.parametrize("prior", [0.3, 0.6, 0.9])
def test_prior_and_decisions_without_a_negative_label(prior):
    p, u, truth = mixture(1500, 3000, prior)
    model = Q.train(p, u)
    assert abs(model["prior"] - prior) < 0.06
    x = np.column_stack([(u - model["mean"]) / model["scale"], np.ones(len(u))])
    said = x @ model["weights"] >= 0
    assert (said == truth).mean() > 0.95


def test_gradient_is_that_of_the_risk():
    """One step from zero goes down the unbiased risk; where its second part is below zero, it is pushed up."""
    p, u, _ = mixture(200, 200, 0.5)
    w = np.zeros(6)

    def risk(w, prior):
        lp, ln = np.log1p(np.exp(-(p @ w))).mean(), np.log1p(np.exp(p @ w)).mean()
        return prior * lp, np.log1p(np.exp(u @ w)).mean() - prior * ln

    def slope(f):
        return np.array([(f(w + 1e-5 * e) - f(w - 1e-5 * e)) / 2e-5 for e in np.eye(6)])

    whole = slope(lambda v: sum(risk(v, 0.5)))
    s = Q._sigmoid(p @ w), Q._sigmoid(u @ w)
    mine = -0.5 * (1 - s[0]) @ p / len(p) + s[1] @ u / len(u) - 0.5 * s[0] @ p / len(p)
    assert np.allclose(whole, mine, atol=1e-4)


def test_defined_cases(spark):
    rng = random.Random(4)
    good = [(i, prose(rng, 60), "en", "s") for i in range(300)]
    bad = [(1000 + i, "!! ".join(prose(rng, 60).upper().split()), "en", "s") for i in range(100)]
    odd = [(None, "some text", None, None), (5000, None, "en", "s"), (5001, "", "en", "s"), (7, good[7][1], "en", "s")]
    odd += [(6000 + i, t, None, None) for i, t in enumerate(odd_texts())]
    docs = documents(spark, good + bad + odd).selectExpr("*", "'clash' as score")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 300, 2)] + [(1001, 0, 0), (None, 1, 1), (3, None, 1), (4, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    model = Q.fit(docs, labels)
    got = Q.predict(docs, model)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "score", "predicted"]
    rows = got.collect()
    assert len(rows) == len(good) + len(bad) + len(odd)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r.text or "", r.score) == r.score  # equal texts, equal scores
    said = {r.doc_id: r.predicted for r in rows if r.doc_id is not None}
    assert np.mean([said[i] for i, *_ in good]) > 0.97 and np.mean([said[i] for i, *_ in bad]) < 0.1
    assert Q.predict(docs.limit(0), Q.fit(docs.limit(0), labels)).count() == 0
    nothing = Q.fit(docs, labels.limit(0))
    assert {(r.score, r.predicted) for r in Q.predict(docs, nothing).collect()} == {(0.5, 1)}


def test_held_out_labels_are_not_learnt(spark):
    docs = documents(spark, [(i, f"w{i} " * 9, "en", "s") for i in range(60)])
    labels = spark.createDataFrame([(i, 1) for i in range(60) if zlib.crc32(str(i).encode()) % 3 == 1], "doc_id long, quality int")
    assert labels.count() and Q.fit(docs, labels) is None


def test_whole_query_on_held_out_labels(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.1")
    rows = QUERIES["op12_quality"](spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    held = [(r.score, r.predicted, label[r.doc_id]) for r in rows if r.held_out and r.doc_id in label]
    assert np.mean([p == y for _, p, y in held]) > 0.96
    good, bad = np.array([s for s, _, y in held if y]), np.array([s for s, _, y in held if not y])
    assert (good[:, None] > bad[None, :]).mean() + (good[:, None] == bad[None, :]).mean() / 2 > 0.97
