"""Substring dedup by hashed units: every repeated passage is kept once, where it occurs first.

A text is cut into units. They end

* with lines and sentences; sentences below UNIT_WORDS words that follow each other (lists, table cells,
  signs after each word) count as one, in which only the words decide;
* in those, and in sentences over LONG_WORDS words, where the hash of three words is the least of WINDOW
  such hashes in a row. The words alone decide, so a passage is cut alike wherever it is pasted, and at
  least every WINDOW words but for pieces below PIECE_WORDS words, which go with the next.

What is compared are passages: from each unit on as many whole units as make MIN_WORDS words, and the last such piece to the end
of the text. A passage is normalised (case, punctuation, white space) and hashed to 128 bits. So whatever is removed lies
in a run of at least MIN_WORDS words that stands in one piece somewhere else. Han characters and kana are words each, and
count half a word.

The digests are grouped over all texts; the occurrence in the smallest doc_id, and there the first, stays. Of
the others, all words go; in one text a passage is repeated where it begins after its first occurrence ends. The removed spans
are returned as offsets into the original text (code points), with the text that is left. Of a passage pasted into a
sentence, the words before its first and after its last cut stay (mostly under WINDOW on either side).

Scale: one row per different passage of a text (an id and 16 bytes) is grouped with map-side combine, so that
a passage in a third of all texts costs each map task one row; those found repeated are joined back,
hot ones broadcast (fewer than 1,000); each text moves once, to its list of repeated passages. The digests are
written to the shared folder. A text, of any length, is handled by one task, never a group of texts.

Defined cases: null text stays null and an empty one empty; texts below MIN_WORDS words are never cut; rows without an id rank
last and are never cut; rows that share a doc_id count as one document, each cut by itself. A text repeated as a whole is
cut like any passage and may become empty. White space left around a cut is kept, except that a cut takes
the spaces after it. An empty table gives an empty result; a column named like an added one is replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lookup, per_worker, saved, small

MIN_WORDS = 10
UNIT_WORDS = 3
# Sentences over LONG_WORDS words are cut where the hash of HASHED words is the least of WINDOW in a row.
LONG_WORDS = 16
WINDOW = 12
HASHED = 3
PIECE_WORDS = 5
# Characters whose arrays are in memory at once.
BLOCK = 1 << 20

NO_WORD = re.compile(r"\W")
# Han and kana: written without spaces.
SPACELESS = [(0x3041, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)]


def _digest(words: str) -> bytes:
    return hashlib.blake2b(words.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def _kinds_of(codes: Iterable[int]) -> np.ndarray:
    """0 for no part of a word, 1 for one, 2 for a word by itself."""
    spaceless = [any(low <= c <= high for low, high in SPACELESS) for c in codes]
    return np.array([(chr(c).isalnum() or c == 95) * (1 + s) for c, s in zip(codes, spaceless)], np.int8)


KINDS = _kinds_of(range(1 << 16))


def _kinds(codes: np.ndarray) -> np.ndarray:
    if not len(codes) or codes.max() < len(KINDS):
        return KINDS[codes]
    different, at = np.unique(codes, return_inverse=True)
    return _kinds_of(different.tolist())[at]


def _within(x: np.ndarray, size: int, best: np.ufunc) -> np.ndarray:
    """The best of each ``size`` values in a row."""
    width = 1
    while width < size:
        step = min(width, size - width)
        x = best(x[:-step], x[step:])
        width += step
    return x


class _Words:
    """The words of a text: where they are, their hashes, and the normalised text, with a space after each word."""

    def __init__(self, text: str):
        lower = text.replace("\u0130", "i").lower()  # the one character that gets longer
        parts, at = [], 0
        while at < len(lower):
            end = at + BLOCK
            if end < len(lower):  # not inside a word
                gap = NO_WORD.search(lower, end)
                end = gap.start() if gap else len(lower)
            parts.append(self._block(lower[at:end], at))
            at = end
        columns = list(zip(*parts))
        self.text = "".join(columns.pop())
        self.start, self.end, self.hash, self.spaceless, self.marks, self.spaces, self.lines = map(np.concatenate, columns)
        self.offset = np.concatenate([[0], np.cumsum(self.end - self.start + 1)])

    @staticmethod
    def _block(lower: str, at: int) -> tuple:
        codes = np.frombuffer(lower.encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds = _kinds(codes)
        inside = kinds > 0
        starts = inside.copy()
        starts[1:] &= (kinds[:-1] != 1) | (kinds[1:] == 2)
        start = np.flatnonzero(starts)
        chars = np.flatnonzero(inside)
        word = np.cumsum(starts)[chars] - 1
        size = np.bincount(word, minlength=len(start))
        if len(start):
            value = _mixed((codes[chars].astype(np.uint64) << np.uint64(32)) + (chars - start[word]).astype(np.uint64))
            hashes = _mixed(np.add.reduceat(value, np.searchsorted(chars, start)))
        else:
            hashes = np.zeros(0, np.uint64)
        plain = np.full(len(chars) + len(start), 32, np.uint32)
        plain[np.arange(len(chars)) + word] = codes[chars]
        white = (codes == 32) | (codes == 9) | (codes == 13) | (codes == 10)
        wide = (codes == 0x3002) | (codes == 0xFF01) | (codes == 0xFF1F)  # these need no space after them
        marks = np.flatnonzero((codes == 46) | (codes == 33) | (codes == 63) | wide)
        return (start + at, start + size + at, hashes, kinds[start] == 2, marks + at, np.flatnonzero(white | wide) + at,
                np.flatnonzero(codes == 10) + at, plain.tobytes().decode("utf-32-le", "surrogatepass"))

    def plain(self, a: int, b: int) -> str:
        return self.text[self.offset[a]:self.offset[b] - 1]

    def ends(self) -> tuple[np.ndarray, np.ndarray]:
        """Where sentences and lines end: the number of the next word, and the offset, after the white space."""
        n, gap = len(self.start), self.spaces[1:] - self.spaces[:-1] != 1
        last = np.concatenate([self.spaces[:-1][gap], self.spaces[-1:]]) + 1  # ends of white space
        space = np.searchsorted(self.spaces, self.marks)
        mark = self.marks[space < len(self.spaces)]
        space = self.spaces[space[space < len(self.spaces)]]
        word, cut = np.searchsorted(self.start, mark), last[np.searchsorted(last, space, "right")]
        real = np.searchsorted(self.start, space) == word  # white space before the next word
        at = dict(zip(word[real].tolist(), cut[real].tolist()))
        at |= dict(zip(np.searchsorted(self.start, self.lines).tolist(), (self.lines + 1).tolist()))
        words = np.array(sorted(w for w in at if 0 < w < n), np.int64)
        return words, np.array([at[w] for w in words.tolist()], np.int64)

    def least(self) -> list[int]:
        """Numbers of the words before which the words' hashes say to cut."""
        n = len(self.hash) - HASHED + 1
        if n < WINDOW:
            return []
        rolled = self.hash[:n].copy()
        for k in range(1, HASHED):
            rolled = _mixed(rolled + self.hash[k:n + k])
        least = _within(rolled, WINDOW, np.minimum)
        beyond = np.zeros(WINDOW - 1, np.uint64)
        highest = _within(np.concatenate([beyond, least, beyond]), WINDOW, np.maximum)  # of the windows around each
        return (np.flatnonzero(highest == rolled) + HASHED - 1).tolist()


def units(text: str) -> tuple[_Words, list[int], list[int]]:
    """The words, and the borders of the units: numbers of words, and offsets in the text."""
    words = _Words(text)
    n = len(words.start)
    if n < UNIT_WORDS:
        return words, [0, n], [0, len(text)]
    at, cut = words.ends()
    bounds = np.concatenate([[0], at, [n]])
    short = bounds[1:] - bounds[:-1] < UNIT_WORDS
    real = ~(short[:-1] & short[1:])
    firsts = [0, *at[real].tolist()]
    pooled = short[np.concatenate([[True], real])].tolist()
    offsets = [0, *cut[real].tolist()]
    inner, k = words.least(), 0
    cuts, places = [], []  # word numbers and text offsets at which units start
    for i, (a, b) in enumerate(zip(firsts, [*firsts[1:], n])):
        cuts.append(a)
        places.append(offsets[i])
        last = a
        while k < len(inner) and inner[k] < b:
            c = inner[k]
            k += 1
            if c - last >= PIECE_WORDS and b - c >= PIECE_WORDS and (pooled[i] or b - a > LONG_WORDS):
                cuts.append(c)
                places.append(int(words.end[c - 1]))
                last = c
    cuts.append(n)
    places.append(len(text))
    return words, cuts, places


def passages(text: str, min_words: int = MIN_WORDS) -> list[tuple[int, int, bytes]]:
    """(start, end, digest) of each passage, in order of their starts."""
    if not text:
        return []
    words, cuts, places = units(text)
    weight = np.arange(len(words.start) + 1, dtype=np.float64)
    if words.spaceless.any():
        weight[1:] -= np.cumsum(words.spaceless) / 2
    size = weight[cuts].tolist()
    out, j, last = [], 0, len(cuts) - 1
    for i in range(last):
        while j < last and size[j] - size[i] < min_words:
            j += 1
        if size[j] - size[i] < min_words:
            break
        out.append((places[i], places[j], _digest(words.plain(cuts[i], cuts[j]))))
    if out and out[-1][1] < places[-1]:  # the units after the last passage are fewer words than one
        i = len(out) - 1
        out.append((places[i], places[-1], _digest(words.plain(cuts[i], cuts[-1]))))
    return out


def repeated_spans(found: list[tuple[int, int, bytes]], elsewhere: set[str]) -> list[tuple[int, int]]:
    """Spans to cut: passages that occur in an earlier text or earlier in this one."""
    spans: list[tuple[int, int]] = []
    first: dict[bytes, int] = {}
    for start, end, digest in found:
        if first.setdefault(digest, end) <= start or bool(elsewhere) and _name(digest) in elsewhere:
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], max(end, spans[-1][1]))
            else:
                spans.append((start, end))
    return spans


def _digests(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) -> doc_id and the different digests of its passages, in two halves."""
    per_worker("units", lambda: None)  # what another stage kept goes
    for batch in small(batches):
        ids, raw = [], []
        for i, text in enumerate(batch.column("text").to_pylist()):
            own = {p[2] for p in passages(text, min_words)}
            ids += [i] * len(own)
            raw += own
        halves = np.frombuffer(b"".join(raw), "<i8").reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(pa.array(ids, pa.int64())), pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy())],
            names=["doc_id", "high", "low"])


def _name(digest: bytes) -> str:
    high, low = np.frombuffer(digest, "<i8").tolist()
    return f"{high}:{low}"


def cut_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the text that is left, ``removed`` (spans: start, end) and ``n_removed`` (code points)."""
    id_type = dict(docs.dtypes)["doc_id"]
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("doc_id is not null and text is not null")
    found = saved(texts.mapInArrow(partial(_digests, min_words=min_words), f"doc_id {id_type}, high long, low long"), "units")
    # one half finds the candidates, both decide
    often = saved(found.groupBy("high").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "frequent-units")
    again = lookup(found, often, "high", ["n"], "n", found.count(), ["doc_id", "low"]).where("n is not null")
    again = saved(again.select("doc_id", F.concat_ws(":", "high", "low").alias("unit")), "unit-occurrences")
    first = saved(again.groupBy("unit").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
                  .where("n > 1"), "repeated-units")
    later = (lookup(again, first, "unit", ["first_id"], "n", again.count(), ["doc_id", "unit"])
             .where("first_id < doc_id")
             .groupBy(F.col("doc_id").alias("_id")).agg(F.collect_set("unit").alias("_elsewhere")))  # at most a text's own units
    base = docs.drop("removed", "n_removed").join(saved(later, "later-units"), F.col("doc_id") == F.col("_id"), "left").drop("_id")
    columns = [c for c in base.columns if c not in ("text", "_elsewhere")]
    schema = ", ".join(f"`{c}` {t}" for c, t in base.dtypes if c in columns)
    schema = f"{schema}, text string, removed array<struct<start: int, end: int>>, n_removed int"
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        per_worker("units", lambda: None)
        for batch in small(batches):
            left, removed = [], []
            for doc_id, text, elsewhere in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(),
                                               batch.column("_elsewhere").to_pylist()):
                spans = []
                if text and doc_id is not None:
                    spans = repeated_spans(passages(text, min_words), set(elsewhere or ()))
                    at, kept = 0, []
                    for a, b in spans:
                        kept.append(text[at:a])
                        at = b
                    text = "".join([*kept, text[at:]])
                left.append(text)
                removed.append([{"start": a, "end": b} for a, b in spans])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(left, pa.string()), pa.array(removed, span_type),
                 pa.array([sum(s["end"] - s["start"] for s in r) for r in removed], pa.int32())],
                names=[*columns, "text", "removed", "n_removed"])

    return base.mapInArrow(cut, schema)


def drop_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated passages cut out of the text, n_chars (if there) to match."""
    out = cut_repeats(docs, min_words)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return out.select(*docs.columns)
