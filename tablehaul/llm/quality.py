"""Quality classifier by positive-unlabelled learning with the non-negative risk estimator.

Trusted positives are the texts labelled 1; everything else, also texts labelled 0, is unlabelled web text. With g the
score before the logistic function, l the logistic loss, p the positives, u the unlabelled and c the class prior, ``fit``
minimises

    c E_p[l(g)] + max(0, E_u[l(-g)] - c E_p[l(-g)])

in small batches: where the second part falls below zero, its gradient is reversed, so that the unlabelled positives are not
learnt by heart. The prior is not given: ``class_prior`` estimates it from the two samples by the best bin. A first model tells
positives from unlabelled on one half; on the other half the share of unlabelled over the share of positives above a
threshold is an upper bound of the prior, taken where its confidence bound is least.

Features come from the whole text, in bounded memory: the frequencies of pairs of byte classes (every ASCII sign is a class of
its own; letters, digits, white space, lead and following bytes of other letters are one each), the length, the shares of
distinct words and lines, the shares of the commonest word and of words like the one before, and the mean length of words. Labels, languages, sources and ids are no
features.

``fit`` works on a sample bounded by POSITIVES and UNLABELLED rows, chosen by a hash from counts over all rows; the feature rows
alone (2 bytes a feature) reach the driver, not the texts. ``predict`` is one pass over the texts without a shuffle.

Defined cases: a null text counts as empty; empty texts get the score that the model gives to features of zero. Rows without an
id take no part in learning; a text with several labels is positive if one of them is 1. Without positive rows, or without
texts, every score is 0.5. Equal texts get equal scores. Other columns pass through; one named like an added one is replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POSITIVES = 4000
UNLABELLED = 8000
# Bytes whose pairs are counted at once.
WINDOW = 1 << 21
STEPS = 2000
BATCH = 250
RATE = 0.01
DECAY = 1e-3
CLIP = 8
CONFIDENCE = 0.1
SEED = 5


def _classes() -> np.ndarray:
    """The class of each byte."""
    kind = np.zeros(256, np.int64)
    kind[ord("a"):ord("z") + 1], kind[ord("A"):ord("Z") + 1], kind[ord("0"):ord("9") + 1] = 1, 2, 3
    kind[128:192], kind[192:], kind[ord(" ")], kind[ord("\n")], kind[ord("\t")] = 4, 5, 6, 7, 8
    signs = [b for b in range(33, 127) if not kind[b]]
    kind[signs] = 9 + np.arange(len(signs))
    return kind


CLASSES = _classes()
KINDS = int(CLASSES.max()) + 1
DENSE = 6
WIDTH = KINDS * KINDS + DENSE


def _dense(text: str) -> tuple[float, ...]:
    words, lines = text.split(), text.split("\n")
    if not words:
        return (0.0,) * DENSE
    seen = Counter(words)
    return (np.log1p(len(words)), len(seen) / len(words), len(set(lines)) / len(lines), max(seen.values()) / len(words),
            np.log1p(len(text) / len(words)), sum(map(eq, words, words[1:])) / len(words))


def features(texts: list[str | None]) -> np.ndarray:
    """A row of WIDTH features for each text."""
    out = np.zeros((len(texts), WIDTH), np.float32)
    data = [(t or "").encode("utf-8", "replace") for t in texts]
    sizes = np.array([len(d) for d in data], np.int64)
    start = 0
    while start < len(data):  # as many texts as fill a window, or one longer than it
        end, held = start + 1, sizes[start]
        while end < len(data) and held + sizes[end] <= WINDOW:
            held += sizes[end]
            end += 1
        cells = np.zeros((end - start) * KINDS * KINDS, np.int64)
        joined = data[start] if end == start + 1 else b"".join(data[start:end])
        ends = np.cumsum(sizes[start:end])
        for at in range(0, max(0, len(joined) - 1), WINDOW):  # a long text in overlapping windows
            kind = CLASSES[np.frombuffer(joined[at:at + WINDOW + 1], np.uint8)]
            owner = np.searchsorted(ends, np.arange(at, at + len(kind)), side="right")
            same = owner[1:] == owner[:-1]
            cell = (owner[:-1] * KINDS + kind[:-1]) * KINDS + kind[1:]
            cells += np.bincount(cell[same], minlength=len(cells))
        pairs = cells.reshape(end - start, -1)
        out[start:end, :KINDS * KINDS] = np.sqrt(pairs / np.maximum(1, sizes[start:end] - 1)[:, None])
        start = end
    out[:, KINDS * KINDS:] = [_dense(t or "") for t in texts] if texts else np.zeros((0, DENSE))
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class _Adam:
    def __init__(self, width: int):
        self.w, self.m, self.v, self.t = *(np.zeros(width, np.float32) for _ in range(3)), 0

    def step(self, g: np.ndarray) -> None:
        self.t += 1
        g = g.astype(np.float32)
        g[:-1] += np.float32(DECAY) * self.w[:-1]  # the last weight is the bias
        self.m += np.float32(0.1) * (g - self.m)
        self.v += np.float32(0.001) * (g * g - self.v)
        rate = RATE * (1 - self.t / (STEPS + 1))
        self.w -= np.float32(rate) * (self.m / np.float32(1 - 0.9 ** self.t)) / (np.sqrt(self.v / np.float32(1 - 0.999 ** self.t)) + np.float32(1e-8))


def _batches(rng: np.random.Generator, n: int) -> Iterator[np.ndarray]:
    """Batches without end; each row comes once a round."""
    while True:
        yield from np.array_split(rng.permutation(n), max(1, n // BATCH))


def _train(p: np.ndarray, u: np.ndarray, prior: float | None, rng: np.random.Generator) -> np.ndarray:
    """Weights by the non-negative risk; without a prior, of plain positive against unlabelled."""
    model = _Adam(p.shape[1])
    for bp, bu in islice(zip(_batches(rng, len(p)), _batches(rng, len(u))), STEPS):
        xp, xu = p[bp], u[bu]
        sp, su = _sigmoid(xp @ model.w), _sigmoid(xu @ model.w)
        up = -(1 - sp) @ xp / len(xp)  # gradients of l(g) and l(-g)
        down = su @ xu / len(xu)
        if prior is None:
            model.step(up + down)
            continue
        risk = -np.log(1 - su + 1e-12).mean() + prior * np.log(1 - sp + 1e-12).mean()
        second = down - prior * (sp @ xp) / len(xp)
        model.step(prior * up + second if risk >= 0 else -second)
    return model.w


def class_prior(p: np.ndarray, u: np.ndarray, seed: int = SEED) -> float:
    """The share of positives among the unlabelled, by the best bin."""
    rng = np.random.default_rng(seed)
    mp, mu = np.zeros(len(p), bool), np.zeros(len(u), bool)
    mp[rng.permutation(len(p))[::2]] = True
    mu[rng.permutation(len(u))[::2]] = True
    if mp.all() or mu.all():
        return 0.5
    w = _train(p[mp], u[mu], None, rng)
    gp, gu = np.sort(p[~mp] @ w), np.sort(u[~mu] @ w)
    cuts = np.unique(gp)
    above_p = 1 - np.searchsorted(gp, cuts, "left") / len(gp)
    above_u = 1 - np.searchsorted(gu, cuts, "left") / len(gu)
    slack = np.sqrt(np.log(4 / CONFIDENCE) / 2) * (len(gp) ** -0.5 + len(gu) ** -0.5)
    best = int(np.argmin((above_u + slack) / above_p))
    return float(np.clip(above_u[best] / above_p[best], 0.01, 0.99))


def train(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None = None) -> dict | None:
    """The model from feature rows; None where there is nothing to learn from."""
    if not len(positive) or not len(unlabelled):
        return None
    spread = unlabelled.std(axis=0)
    used = np.flatnonzero(spread > 1e-6)  # features that never vary say nothing
    mean, scale = unlabelled[:, used].mean(axis=0), spread[used]

    def ready(x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.clip((x[:, used] - mean) / scale, -CLIP, CLIP), np.ones(len(x))]).astype(np.float32)

    p, u = ready(positive), ready(unlabelled)
    prior = class_prior(p, u) if prior is None else prior
    w = _train(p, u, prior, np.random.default_rng(SEED))
    return {"used": used, "mean": mean, "scale": scale, "weights": w, "prior": prior}


def scored(texts: list[str | None], model: dict | None) -> np.ndarray:
    """The probability of quality for each text."""
    if model is None:
        return np.full(len(texts), 0.5)
    out = np.empty(len(texts))
    for start in range(0, len(texts), 1024):
        x = features(texts[start:start + 1024])
        x = np.clip((x[:, model["used"]] - model["mean"]) / model["scale"], -CLIP, CLIP)
        # row by row, so that a score doesn't depend on the rows beside it
        out[start:start + 1024] = _sigmoid(np.einsum("ij,j->i", x, model["weights"][:-1]) + model["weights"][-1])
    return out


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def _draw(n: int, wanted: int) -> Column:
    """True for about ``wanted`` of ``n`` ids, by a hash."""
    share = min(1.0, wanted / max(1, n))
    return F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", prior: float | None = None) -> dict | None:
    """Learn from documents (doc_id, text) and labels (doc_id, ``label``) that are not held out."""
    docs = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", "text")
    trusted = labels.where(F.col("doc_id").isNotNull() & (F.col(label) == 1) & ~held_out(F.col("doc_id"))).select("doc_id").distinct()
    # a bounded set of ids, small enough to be sent to every task
    chosen = trusted.where(_draw(trusted.count(), POSITIVES)).withColumn("_positive", F.lit(True)).limit(2 * POSITIVES)
    picked = (docs.join(F.broadcast(chosen), "doc_id", "left").withColumn("_unlabelled", _draw(docs.count(), UNLABELLED))
              .where(F.col("_positive") | F.col("_unlabelled")))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features(batch.column("text").to_pylist()).astype(np.float16)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("_order", "_positive", "_unlabelled")),
                                              pa.array([r.tobytes() for r in x], pa.binary())], names=["place", "positive", "unlabelled", "x"])

    found = (picked.select(F.xxhash64("doc_id", "text").alias("_order"), "_positive", "_unlabelled", "text")
             .mapInArrow(rows, "place long, positive boolean, unlabelled boolean, x binary"))
    # ids are keys; should many rows share one, those beyond twice the bound are left out
    found = found.orderBy("place", "x").limit(2 * (POSITIVES + UNLABELLED)).toArrow()
    x = np.frombuffer(b"".join(found.column("x").to_pylist()), np.float16).reshape(-1, WIDTH).astype(np.float32)
    positive = np.array(found.column("positive").fill_null(False).to_pylist(), bool)
    unlabelled = np.array(found.column("unlabelled").to_pylist(), bool)
    return train(x[positive], x[unlabelled], prior)


def predict(docs: DataFrame, model: dict | None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (all columns, or those in ``keep``) with score and predicted."""
    keep = [c for c in keep or docs.columns if c not in ("score", "predicted")]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few numbers per feature
    kinds = dict(docs.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = scored(batch.column(text).to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(score)], names=[*keep, "score"])

    out = docs.select(*dict.fromkeys([*keep, text])).mapInArrow(run, schema)
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
