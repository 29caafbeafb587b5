import math
import random

import numpy as np
import pytest

from tablehaul.llm import hard_negatives as H


def brute(rows, is_anchor, scale=256.0, positives=5, negatives=3):
    """All scores in Python integers; rows of (id, vector, label)."""
    used = [(i, [math.floor(scale * float(x)) for x in v], l) for i, v, l in rows
            if l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]

    def first(found, k):
        return sorted(found, key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:k]

    out = []
    for n, (a, q, label) in enumerate(used):
        if a is None or not is_anchor(a):
            continue
        every = [(sum(x * y for x, y in zip(q, p)), i, l) for m, (i, p, l) in enumerate(used) if m != n]
        for ps, pid, _ in first([x for x in every if x[2] == label], positives):
            fits = [x for x in every if x[2] != label and 50 * ps <= 100 * x[0] <= 95 * ps]
            out += [(a, pid, r, nid, ps, ns) for r, (ns, nid, _) in enumerate(first(fits, negatives), 1)]
    return sorted(out, key=str)


def mined(spark, rows, is_anchor=lambda c: c % 5 == 0, **kw):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(*r, "c") for r in rows], "vec_id long, embedding array<float>, label int, score string")
    got = H.mine(df, is_anchor(F.col("vec_id")), **kw).collect()
    return sorted([(r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in got], key=str)


def random_rows(n, dim, seed, spread=0.4, centres=4):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dim))
    out = []
    for i in range(n):
        v = middle[i % centres] + spread * rng.normal(size=dim)
        v *= rng.choice([0.2, 1.0, 3.0]) / np.linalg.norm(v)
        out.append((i, [float(np.float32(x)) for x in v], int(rng.integers(0, 3))))
    return out


@pytest.mark.parametrize("block, at_once, focus", [(2048, 8192, 4), (16, 8192, 4), (16, 7, 2), (5, 3, 1)])
def test_against_brute_force(spark, monkeypatch, block, at_once, focus):
    monkeypatch.setattr(H, "BLOCK", block)
    monkeypatch.setattr(H, "FOCUS", focus)
    rows = random_rows(240, 6, seed=block)
    assert mined(spark, rows, anchors_at_once=at_once) == brute(rows, lambda i: i % 5 == 0)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(H, "BLOCK", 8)
    rng = random.Random(5)
    rows = random_rows(60, 4, seed=1)
    rows += [(5, rows[5][1], rows[5][2])] * 3  # copies of an anchor
    rows += [(100 + i, rows[7][1], rows[7][2]) for i in range(12)]  # ties
    rows += [(None, rows[8][1], 1), (None, None, 1), (200, None, 1), (205, [1.0, None], 2), (210, [float("nan"), 1.0], 0),
             (215, [float("inf"), 0.0], 1), (220, [], 1), (225, [0.0] * 4, 2), (230, [0.5, -0.25], 0), (235, [1.0] * 9, 1), (240, [0.3], None)]
    rows += [(250, [3e6, -2e6, 1e6, 5.0], 0), (251, [2.9e6, -2e6, 1e6, 4.0], 0), (252, [2.5e6, -2e6, 1e6, 1.0], 1)]  # beyond exact doubles
    rng.shuffle(rows)
    assert mined(spark, rows) == brute(rows, lambda i: i % 5 == 0)


def test_few_partners_and_empty(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0, 0.0], 1)]) == []
    assert mined(spark, [(0, [1.0, 0.0], 1), (1, [1.0, 0.1], 1), (2, [0.8, 0.3], 2)]) == [(0, 1, 1, 2, 65536, 52224)]


def test_pruning_loses_nothing_and_prunes():
    """Every row that reaches the bound is a candidate; of a spread-out bucket most others are not."""
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(500, 3))
    vectors = np.floor(1000 * vectors / np.linalg.norm(vectors, axis=1)[:, None]).astype(np.int64)
    unit, lengths = H._unit(vectors)
    row = {"n": 500, "dim": 3, "longest": float(lengths.max()), "keys": np.arange(500).tobytes(), "ids": np.arange(500).tobytes(),
           "labels": np.zeros(500, np.int64).tobytes(), "no_id": np.zeros(500, bool).tobytes(), "anchors": np.ones(500, bool).tobytes(),
           "vectors": vectors.tobytes(), "places": np.argsort(unit, axis=0, kind="stable").T.astype(np.int16).tobytes()}
    bucket = H.Bucket(row)
    anchors = H.Anchors(np.arange(500), np.arange(500), np.zeros(500, bool), np.zeros(500), vectors)
    exact = vectors @ vectors.T
    for bound in (-5.0, 1e5, 6e5, 9e5, 9.9e5, 2e6):
        whole, picked = anchors.search(np.arange(500), np.full(500, bound), bucket)
        mask = np.zeros((500, 500), bool)
        mask[whole] = True
        for a, rows in picked:
            mask[a, rows] = True
        assert (mask | (exact < bound)).all()
        if bound == 9.9e5:
            assert mask.mean() < 0.05
    assert not mask.any()
