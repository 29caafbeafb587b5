"""Language ID by a linear-chain conditional random field over the words of each line.

Every word gets a label by forward-backward: emissions from affixes, character n-grams and a lexicon, and
learned transitions, so that text which switches languages is labelled word by word. A document's language
is the one with the largest share of label mass over its words; the share is the score.

``fit`` learns on the driver from a bounded sample of labelled rows, PER_LANGUAGE of every language that has a
label, chosen by a hash. The tasks that read them cut each into up to SEGMENTS segments of up to SEGMENT words of at
most WORD_CHARS letters, and these alone reach the driver; several of different documents in a row make a training chain, so
that transitions between languages are seen. ``predict`` labels whole texts; the model is broadcast (FEATURES rows of a
number per language, a bounded lexicon: a few MB for some dozen languages, in proportion to their number).

A chain is a line. One of more than BLOCK words is worked through in blocks, and the messages are carried over their
borders: each block's transfer matrix gives the forward message into the next block and the backward message out of it, so the
labels are those of the whole chain.

Defined cases: a null text or one without a letter is ``und`` with score 0. Without a labelled row every text
with a letter is ``und`` too. Repeated rows are judged alike; other columns pass through, one named like an
added one is replaced.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import per_worker, small, trim

PER_LANGUAGE = 400
SEGMENTS = 8
SEGMENT = 24
WORD_CHARS = 64
BLOCK = 512
FEATURES = 1 << 16
LEXICON_WORDS = 50_000
ROUNDS = 30
MEMO_WORDS = 300_000
TOKENS_AT_ONCE = 300_000
SEED = 11

LETTER = regex.compile(r"\p{L}")
TOKEN = re.compile(r"[^\W\d_]+|\n")
UNKNOWN = "und"


def features(words: list[str], lexicon: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of the words, flat, and how many each word has."""
    order, cells, counts = [], [], []
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    for width in sorted({1 << max(3, int(n - 1).bit_length()) for n in set(sizes.tolist())}):
        low = width // 2 if width > 8 else 0
        at = np.flatnonzero((sizes > low) & (sizes <= width))
        for part in np.array_split(at, max(1, len(at) * width // 2_000_000)):
            if len(part):
                numbers, n = _grams([words[i] for i in part], sizes[part], width)
                order.append(part)
                cells.append(numbers)
                counts.append(n)
    lex = np.array([lexicon.get(w, -1) for w in words], np.int64)
    have = np.flatnonzero(lex >= 0)
    order.append(have)
    cells.append(FEATURES + lex[have])
    counts.append(np.ones(len(have), np.int64))
    owner = np.repeat(np.concatenate(order), np.concatenate(counts))
    by = np.argsort(owner, kind="stable")
    return np.concatenate(cells)[by], np.bincount(owner, minlength=len(words))


def _grams(words: list[str], sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams (1 to 3 letters, with word edges) and affixes (1 to 4 letters)."""
    letters = np.array(words, f"<U{width}").view(np.uint32).reshape(len(words), width).astype(np.uint64)
    c = np.zeros((len(words), width + 2), np.uint64)  # edges are zeros
    c[:, 1:-1] = letters
    col = np.arange(width + 2)
    found, valid = [], []

    def add(kind: int, values: np.ndarray, ok: np.ndarray) -> None:
        h = (values + np.uint64(kind * 7919)) * np.uint64(0x9E3779B97F4A7C15)
        found.append((h >> np.uint64(48)).astype(np.int64) % FEATURES)
        valid.append(ok)

    mul = np.uint64(1_000_003)
    n = sizes[:, None]
    add(1, c[:, 1:-1], (col[:width] < n))
    pair = c[:, :-1] * mul + c[:, 1:]
    add(2, pair, col[:width + 1] <= n)
    add(3, pair[:, :-1] * mul + c[:, 2:], col[:width] < n)
    head = tail = np.zeros(len(words), np.uint64)
    rows = np.arange(len(words))
    for k in range(1, 5):
        ok = sizes >= k
        head = head * mul + c[:, min(k, width)]
        tail = tail * mul + c[rows, np.maximum(sizes - k + 1, 0)]
        add(3 + k, head[:, None], ok[:, None])
        add(8 + k, tail[:, None], ok[:, None])
    numbers, keep = np.concatenate(found, axis=1), np.concatenate(valid, axis=1)
    return numbers[keep], keep.sum(axis=1)


def chains(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chains over consecutive tokens, longest first: starts, lengths, and how many are longer than t."""
    starts = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    most = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(most), side="left")
    return starts, lengths, active


def marginals(emit: np.ndarray, lengths: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities of every token by forward-backward, and the summed transition mass.

    ``emit``: exp scores of tokens x labels, chain after chain; ``trans``: exp scores of label pairs.
    """
    starts, _, active = chains(lengths)
    alpha, beta = np.empty_like(emit), np.empty_like(emit)
    for t, k in enumerate(active):
        at = starts[:k] + t
        a = emit[at] if t == 0 else (alpha[at - 1] @ trans) * emit[at]
        alpha[at] = a / a.sum(axis=1, keepdims=True)
    after = 0
    moved = np.zeros_like(trans, dtype=np.float64)
    for t in range(len(active) - 1, -1, -1):
        k = active[t]
        at = starts[:k] + t
        b = np.full((k, emit.shape[1]), 1 / emit.shape[1], emit.dtype)
        if after:
            on = at[:after] + 1
            x = emit[on] * beta[on]
            y = x @ trans.T
            b[:after] = y / y.sum(axis=1, keepdims=True)
            pairs = alpha[at[:after]][:, :, None] * trans[None] * x[:, None, :]
            moved += (pairs / pairs.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        beta[at] = b
        after = k
    p = alpha * beta
    return p / p.sum(axis=1, keepdims=True), moved


def _borders(emit: np.ndarray, starts: np.ndarray, lengths: np.ndarray, follows: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Messages over the borders of blocks that follow each other: into each block from the one before (forward), and into its
    end from the one after (backward). ``follows``: the block goes on with the chain of the block before."""
    k = emit.shape[1]
    before, after = np.full((len(starts), k), 1 / k, emit.dtype), np.full((len(starts), k), 1 / k, emit.dtype)
    leads = np.append(follows[1:], False)  # the chain goes on after the block
    part = np.flatnonzero(follows | leads)
    if not len(part):
        return before, after
    # the block as a matrix: from the label before its first word to that of its last
    matrix = np.broadcast_to(np.eye(k, dtype=emit.dtype), (len(part), k, k)).copy()
    for t in range(int(lengths[part].max())):
        on = lengths[part] > t
        step = matrix[on]
        if t:
            step = step @ trans
        else:
            step[follows[part][on]] = step[follows[part][on]] @ trans
        step = step * emit[starts[part][on] + t][:, None, :]
        matrix[on] = step / step.sum(axis=(1, 2), keepdims=True)
    # block by block along the chains: the n-th blocks of all chains at once
    first = np.flatnonzero(~follows[part])
    size = np.diff(np.append(first, len(part)))
    for n in range(1, int(size.max())):
        at = first[size > n] + n
        message = np.einsum("bi,bij->bj", before[part[at - 1]], matrix[at - 1])
        before[part[at]] = message / message.sum(axis=1, keepdims=True)
    for n in range(int(size.max()) - 2, -1, -1):
        at = first[size > n + 1] + n
        message = np.einsum("bij,bj->bi", matrix[at + 1], after[part[at + 1]])
        after[part[at]] = message / message.sum(axis=1, keepdims=True)
    return before, after


def posteriors(emit: np.ndarray, lengths: np.ndarray, trans: np.ndarray, block: int | None = None) -> np.ndarray:
    """``marginals`` without the transition mass; chains longer than ``block`` are worked through in blocks of it."""
    block = block or BLOCK
    pieces = -(-lengths // block)
    nth = _ramp(pieces)
    follows = nth > 0
    begin = np.repeat(np.cumsum(lengths) - lengths, pieces) + nth * block
    size = np.minimum(np.repeat(lengths, pieces) - nth * block, block)
    before, after = _borders(emit, begin, size, follows, trans)
    order = np.argsort(-size, kind="stable")
    starts, size, follows, before, after = begin[order], size[order], follows[order], before[order], after[order]
    active = np.searchsorted(-size, -np.arange(int(size[0]) if len(size) else 0), side="left")
    alpha, beta = np.empty_like(emit), np.empty_like(emit)
    for t, k in enumerate(active):
        at = starts[:k] + t
        if t == 0:
            a = np.where(follows[:k, None], before[:k] @ trans, 1) * emit[at]
        else:
            a = (alpha[at - 1] @ trans) * emit[at]
        alpha[at] = a / a.sum(axis=1, keepdims=True)
    reach = 0
    for t in range(len(active) - 1, -1, -1):
        k = active[t]
        at = starts[:k] + t
        b = after[:k].copy()
        if reach:
            on = at[:reach] + 1
            y = (emit[on] * beta[on]) @ trans.T
            b[:reach] = y / y.sum(axis=1, keepdims=True)
        beta[at] = b
        reach = k
    p = alpha * beta
    return p / p.sum(axis=1, keepdims=True)


def scores(words: list[str], model: dict) -> np.ndarray:
    """exp emission scores of distinct words, scaled so that the best label has 1."""
    cells, counts = features(words, model["lexicon"])
    first = np.cumsum(counts) - counts
    total = np.add.reduceat(model["weights"][cells], first, axis=0)
    return np.exp(np.maximum(total - total.max(axis=1, keepdims=True), -60)).astype(np.float32)


def words_of(text: str) -> list[str]:
    return [w for w in TOKEN.findall(text.lower()) if w != "\n"]


def segments_of(text: str, seed: int) -> list[str]:
    """Up to SEGMENTS pieces of a text, of up to SEGMENT words each."""
    rng = np.random.default_rng([SEED, seed])
    words = [w[:WORD_CHARS] for w in words_of(text)]
    starts = range(0, len(words), SEGMENT)
    if len(starts) > SEGMENTS:
        starts = sorted(rng.choice(len(starts), SEGMENTS, replace=False) * SEGMENT)
    return [" ".join(words[s:s + int(rng.integers(SEGMENT // 3, SEGMENT + 1))]) for s in starts]


def train(sample: list[tuple[str, str]]) -> dict:
    """The model from (text, language) rows: weights, transitions, lexicon, languages."""
    return train_segments([(s, lang) for i, (text, lang) in enumerate(sample) for s in segments_of(text, i)])


def train_segments(sample: list[tuple[str, str]]) -> dict:
    """``train`` from (segment, language) rows."""
    languages = sorted({lang for _, lang in sample})
    number = {lang: i for i, lang in enumerate(languages)}
    rng = np.random.default_rng(SEED)
    segments = [(number[lang], text.split(" ")) for text, lang in sample]  # (label, words)
    if not segments:
        return {"languages": [], "weights": None, "trans": None, "lexicon": {}}
    n_labels = len(languages)
    counts = [Counter() for _ in languages]
    for label, words in segments:
        counts[label].update(words)
    seen = Counter()
    for c in counts:
        seen.update(c)
    lexicon = {}
    for w, n in seen.most_common(LEXICON_WORDS):
        if n < 3:
            break
        by = [c[w] for c in counts]
        best = int(np.argmax(by))
        lexicon[w] = best * 3 + (by[best] / n > 0.6) + (by[best] / n > 0.95)
    order = rng.permutation(len(segments))
    labels, tokens, lengths = [], [], []
    i = 0
    while i < len(order):  # chains of one to three segments
        take = order[i:i + int(rng.integers(1, 4))]
        i += len(take)
        for s in take:
            labels += [segments[s][0]] * len(segments[s][1])
            tokens += segments[s][1]
        lengths.append(sum(len(segments[s][1]) for s in take))
    types = sorted(set(tokens))
    index = {w: i for i, w in enumerate(types)}
    at = np.array([index[w] for w in tokens])
    gold = np.array(labels)
    lengths = np.array(lengths)
    cells, n = features(types, lexicon)
    owner = np.repeat(np.arange(len(types)), n)
    first = np.cumsum(n) - n
    size = FEATURES + 3 * n_labels
    weights, trans = np.zeros((size, n_labels)), np.zeros((n_labels, n_labels))
    inner = np.ones(len(at), bool)
    inner[np.cumsum(lengths)[:-1]] = False
    inner[0] = False
    seen_moves = np.zeros_like(trans)
    np.add.at(seen_moves, (gold[:-1][inner[1:]], gold[1:][inner[1:]]), 1)
    m = [np.zeros_like(weights), np.zeros_like(trans)]
    v = [np.zeros_like(weights), np.zeros_like(trans)]
    onehot = np.eye(n_labels)
    for step in range(1, ROUNDS + 1):  # Adam on the log-likelihood
        total = np.add.reduceat(weights[cells], first, axis=0)
        emit = np.exp(np.maximum(total - total.max(axis=1, keepdims=True), -60))
        p, moved = marginals(emit[at], lengths, np.exp(trans))
        by_type = np.stack([np.bincount(at, p[:, k] - onehot[gold, k], len(types)) for k in range(n_labels)], axis=1)
        g_w = np.stack([np.bincount(cells, by_type[owner, k], size) for k in range(n_labels)], axis=1) / len(at)
        g_t = (moved - seen_moves) / len(at)
        for x, g, i in ((weights, g_w + 1e-6 * weights, 0), (trans, g_t, 1)):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.99 * v[i] + 0.01 * g * g
            x -= 0.1 * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.99 ** step)) + 1e-10)
    return {"languages": languages, "weights": weights.astype(np.float32),
            "trans": np.exp(trans).astype(np.float32), "lexicon": lexicon}


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fit(docs: DataFrame) -> dict:
    """Learn from the labelled rows that are not held out."""
    rows = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull()
                      & ~held_out(F.col("doc_id")))
    # about PER_LANGUAGE rows of each language, by a hash threshold from the counts over all rows
    draw = F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1 << 30))
    counts = rows.groupBy("lang").count()  # a row per language
    limits = counts.select("lang", (F.least(F.lit(1.0), F.lit(1.2 * PER_LANGUAGE + 100) / F.col("count")) * (1 << 30)).cast("long").alias("_limit"))
    drawn = rows.withColumn("_draw", draw).join(F.broadcast(limits), "lang").where(F.col("_draw") < F.col("_limit"))
    # ids are keys; should many rows share one, its rows beyond the bound are left out
    place = Window.partitionBy("lang").orderBy("_draw", "doc_id", F.xxhash64("text"))
    chosen = drawn.select("lang", "text", "_draw", "doc_id").withColumn("_place", F.row_number().over(place)).where(F.col("_place") <= PER_LANGUAGE)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        per_worker("segments", lambda: None)
        for batch in small(batches):
            found = [segments_of(t, p) for t, p in zip(batch.column("text").to_pylist(), batch.column("_place").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("_place"), pa.array(found, pa.list_(pa.string()))],
                                             names=["lang", "place", "segments"])

    sample = chosen.select("lang", "_place", "text").mapInArrow(cut, "lang string, place int, segments array<string>").toArrow()
    sample = sample.sort_by([("lang", "ascending"), ("place", "ascending")])
    return train_segments([(s, lang) for lang, found in zip(sample.column("lang").to_pylist(), sample.column("segments").to_pylist())
                           for s in found])


class Labeller:
    """Labels texts in a worker; keeps the scores of words it has seen, up to MEMO_WORDS."""

    def __init__(self, model: dict):
        self.model = model
        self.memo: dict[str, int] = {"\n": -1}
        self.emit = np.empty((0, len(model["languages"])), np.float32)

    def _learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.memo]
        if len(self.memo) + len(new) > MEMO_WORDS:
            self.memo = {"\n": -1}
            self.emit = self.emit[:0]
            new = [w for w in words if w != "\n"]
        if new:
            self.memo.update(zip(new, range(len(self.emit), len(self.emit) + len(new))))
            self.emit = np.concatenate([self.emit, scores(new, self.model)])

    def label(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Per text the labels' probabilities of its words (in order), and the words' mass by label."""
        tokens = [TOKEN.findall(t.lower()) for t in texts]
        self._learn(set().union(*tokens))
        flat = np.fromiter((self.memo[w] for ws in tokens for w in ws), np.int64, sum(map(len, tokens)))
        doc = np.repeat(np.arange(len(texts)), [len(ws) for ws in tokens])
        word = flat >= 0
        # a chain ends with its line and its document
        line = np.cumsum(~word)
        place = np.flatnonzero(word)
        if not len(place):
            return [np.empty((0, self.emit.shape[1]), np.float32)] * len(texts), [np.zeros(self.emit.shape[1])] * len(texts)
        doc, line = doc[place], line[place]
        new = np.ones(len(place), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (line[1:] != line[:-1])
        lengths = np.diff(np.append(np.flatnonzero(new), len(place)))
        p = posteriors(self.emit[flat[place]], lengths, self.model["trans"])
        ends = np.searchsorted(doc, np.arange(len(texts) + 1))
        mass = np.stack([np.bincount(doc, p[:, k], len(texts)) for k in range(p.shape[1])], axis=1)
        return [p[a:b] for a, b in zip(ends[:-1], ends[1:])], list(mass)


def _ramp(counts: np.ndarray) -> np.ndarray:
    """0..n-1 for each n, one after the other."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def judged(texts: list[str | None], labeller: Labeller) -> tuple[list[str], list[float]]:
    """Language and score of each text."""
    languages = labeller.model["languages"]
    out_lang, out_score = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if not languages:
        return out_lang, out_score
    todo = [i for i, t in enumerate(texts) if t and LETTER.search(t)]
    while todo:
        part, size = [], 0
        while todo and (not part or size < TOKENS_AT_ONCE):
            part.append(todo.pop())
            size += len(texts[part[-1]]) // 6
        _, mass = labeller.label([texts[i] for i in part])
        for i, m in zip(part, mass):
            best = int(m.argmax())
            out_lang[i], out_score[i] = languages[best], float(min(1.0, m[best] / m.sum()))
    return out_lang, out_score


def predict(docs: DataFrame, model: dict, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (all columns, or those in ``keep``) with lang_pred and score."""
    keep = [c for c in keep or docs.columns if c not in ("lang_pred", "score")]
    base = docs.select(*dict.fromkeys([*keep, text]))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join(f"`{c}` {dict(docs.dtypes)[c]}" for c in keep) + ", lang_pred string, score double"
    tag = uuid.uuid4().hex  # this model's

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = per_worker(("labeller", tag), lambda: Labeller(shared.value))
        for batch in small(batches):
            lang, score = judged(batch.column(text).to_pylist(), labeller)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                names=[*keep, "lang_pred", "score"])
        trim()

    return base.mapInArrow(run, schema)
