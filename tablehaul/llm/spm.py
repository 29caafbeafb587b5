"""SentencePiece encoding and decoding on the tokenizers library.

``rebuild`` parses the model's protobuf and builds a tokenizer of the tokenizers library from it: the
normaliser (the model's character map, extra spaces, the leading and the space marker), the pieces with
their unigram scores (or, for a BPE model, the merges in the order of their scores), and byte fallback.
Control, byte and unused pieces are never matched in text.

``encode`` works in batches: every text is normalised and cut where no piece crosses, before its markers and
between words and other signs (a model whose pieces cross markers gets whole texts); each new chunk is
encoded once per worker, many at a time by the library's threads, and checked against the sentencepiece
library. Where the two differ, the chunk gets sentencepiece's ids and its texts are marked. ``decode`` turns
ids into text; ``encode`` does so for a new chunk's ids, and puts a text together from its chunks' texts.

Scale: a map over the rows, no shuffle; memory is bounded by MEMO_CHUNKS and BATCH_BYTES, and by a single
text. The model is read from its path on every executor (a file of an installed package, or one on a
shared mount).

Defined cases: a null text has null ids and stays null; an empty one has none. Repeated rows are encoded
alike. Text that holds a marker is encoded as sentencepiece does, as a space, and so decodes to one.
Columns named like an added one are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import per_worker

MARK = "\N{LOWER ONE EIGHTH BLOCK}"  # sentencepiece's sign for a space
MEMO_CHUNKS = 300_000
BATCH_BYTES = 1_000_000
CHUNKS_PER_CALL = 2_000
CALLS = 8

# Kinds of model and of piece in the protobuf; fixed values.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def parse(raw: bytes):
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(raw)
    return proto


def normalizer_of(proto):
    """The model's normaliser, without the marker of the text's start."""
    from tokenizers import Regex, normalizers

    spec, steps = proto.normalizer_spec, []
    if spec.precompiled_charsmap:
        steps.append(normalizers.Precompiled(spec.precompiled_charsmap))
    if spec.remove_extra_whitespaces:
        steps += [normalizers.Replace(Regex(r"\A +| +\z"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if spec.add_dummy_prefix:
        steps.append(normalizers.Prepend(" "))
    if spec.escape_whitespaces:
        steps.append(normalizers.Replace(" ", MARK))
    return normalizers.Sequence(steps)


def rebuild(proto, normalize: bool = True):
    """The tokenizers-library counterpart of a parsed sentencepiece model."""
    from tokenizers import Tokenizer, decoders, models

    pieces, kind = list(proto.pieces), proto.trainer_spec.model_type
    unknown = next(i for i, p in enumerate(pieces) if p.type == UNKNOWN)
    fallback = proto.trainer_spec.byte_fallback
    if kind == UNIGRAM:
        # names that no text contains keep the pieces that text must not match out of the search
        names = [p.piece if p.type in (NORMAL, USER_DEFINED, BYTE) else f"\U0010fffe{i}" for i, p in enumerate(pieces)]
        model = models.Unigram(list(zip(names, (p.score for p in pieces))), unknown, fallback)
    elif kind == BPE:
        vocab = {p.piece: i for i, p in enumerate(pieces)}
        whole = {p.piece for p in pieces if p.type in (NORMAL, USER_DEFINED)}
        merges = []
        for p in pieces:
            if p.piece in whole:
                for k in range(1, len(p.piece)):
                    left, right = p.piece[:k], p.piece[k:]
                    if left in whole and right in whole:
                        merges.append((-p.score, vocab[left], vocab[right], left, right))
        model = models.BPE(vocab, [m[3:] for m in sorted(merges)], unk_token=pieces[unknown].piece,
                           fuse_unk=True, byte_fallback=fallback)
    else:
        raise ValueError(f"model type {kind}: only unigram and BPE models are supported")
    out = Tokenizer(model)
    if normalize:
        out.normalizer = normalizer_of(proto)
    steps = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    if proto.normalizer_spec.add_dummy_prefix:
        steps.append(decoders.Strip(" ", 1, 0))
    out.decoder = decoders.Sequence(steps)
    return out


def word_letters(pieces: list[str]) -> re.Pattern:
    """Letters, digits and the like that stand beside no other sign (the marker apart) in any piece."""
    pairs = {(a, b) for p in pieces for a, b in zip(p, p[1:]) if MARK not in (a, b)}
    mixed: set[str] = set()
    while True:
        more = {x for a, b in pairs for x, y in ((a, b), (b, a))
                if re.match(r"\w", x) and x not in mixed and (y in mixed or not re.match(r"\w", y))}
        if not more:
            return re.compile("[^\\W" + "".join(map(re.escape, sorted(mixed))) + "]")
        mixed |= more


class Encoder:
    """Ids of texts (32-bit, little-endian) and whether both libraries agree on them.

    A text is cut where no piece crosses: before spaces, and between words and other signs. The memo keeps the
    first MEMO_CHUNKS chunks, among them the frequent ones; later ones live for one call.
    """

    def __init__(self, path: str):
        import sentencepiece

        with open(path, "rb") as f:
            raw = f.read()
        self.proto = parse(raw)
        self.reference = sentencepiece.SentencePieceProcessor(model_proto=raw)
        self.plain = rebuild(self.proto, normalize=False)
        self.normalizer = normalizer_of(self.proto)
        pieces = [p.piece for p in self.proto.pieces if p.type in (NORMAL, USER_DEFINED)]
        spec = self.proto.normalizer_spec
        simple = not (spec.precompiled_charsmap or spec.remove_extra_whitespaces)
        crossing = any(MARK in p.lstrip(MARK) for p in pieces)
        self.by_chunk = not crossing and simple and spec.add_dummy_prefix and spec.escape_whitespaces
        self.letter = word_letters(pieces)
        word = self.letter.pattern
        self.chunk = re.compile(f" *(?:{word}+|(?:(?!{word})[^ ])+)| +")
        self.inner = next((c for c in "abcdefghijklmnopqrstuvwxyz0123456789" if self.letter.match(c)), "")
        self.leads = np.array([p.piece.startswith(MARK) for p in self.proto.pieces])
        self.memo: dict[str, bytes] = {}
        self.wrong: set[str] = set()
        self.altered: set[str] = set()  # chunks whose ids don't give their text again

    def _checked(self, found: list[int], text: str, before: str = "") -> tuple[bytes, bool]:
        """sentencepiece's ids of a text (that stands after another), and whether they are those found."""
        wanted = self.reference.encode(before + text)[len(self.reference.encode(before)):]
        return np.array(wanted, "<u4").tobytes(), wanted == found

    def _learn(self, chunks: list[str]) -> dict[str, bytes]:
        out = {}
        # chunks that begin with a space and hold more can stand in a row as one text, whose ids are theirs
        rows = [c for c in chunks if c[0] == " " and not c.isspace()]
        rows.sort(key=lambda c: c[1] == " ")
        for i in range(0, len(rows), CHUNKS_PER_CALL * CALLS):
            groups = [rows[k:k + CHUNKS_PER_CALL] for k in range(i, min(len(rows), i + CHUNKS_PER_CALL * CALLS), CHUNKS_PER_CALL)]
            texts = ["".join(g) for g in groups]
            marked = [t.replace(" ", MARK) for t in texts]
            for group, text, e in zip(groups, texts, self.plain.encode_batch(marked, add_special_tokens=False)):
                found = e.ids
                ids = np.array(found, "<u4")
                cuts = np.flatnonzero(self.leads[ids])  # a chunk with one space has one such piece, its first
                if group[-1][1] == " " or len(cuts) != len(group):
                    starts = np.cumsum([0] + [len(c) for c in group[:-1]])
                    cuts = np.searchsorted([o[0] for o in e.offsets], starts)
                raw, cuts = ids.tobytes(), [*(cuts * 4).tolist(), 4 * len(ids)]
                parts = [raw[a:b] for a, b in zip(cuts, cuts[1:])]
                if self.reference.encode(text[1:]) == found:  # sentencepiece adds the first marker itself
                    out.update(zip(group, parts))
                else:
                    for c, part in zip(group, parts):
                        self._keep(out, c, self._checked(np.frombuffer(part, "<u4").tolist(), c, "\n"))
        for c in chunks:
            if c not in out:
                after = "" if self.letter.match(c) or c.isspace() else self.inner
                ids = self.plain.encode(c.replace(" ", MARK), add_special_tokens=False).ids
                self._keep(out, c, self._checked(ids, c, after or "\n"))
        return out

    def _keep(self, out: dict[str, bytes], chunk: str, found: tuple[bytes, bool]) -> None:
        out[chunk], same = found
        if not same:
            self.wrong.add(chunk)

    def _spell(self, learnt: dict[str, bytes]) -> None:
        """Decodes the ids of new chunks and notes those that give another text."""
        texts = _texts_of(self.plain, list(learnt.values()))  # the decoder takes the first space for the added one
        self.altered.update(c for c, t in zip(learnt, texts) if t != c.removeprefix(" "))

    def encode(self, texts: list[str], decoded: bool = False) -> list[tuple]:
        """Per text its ids and whether the libraries agree, on demand also the text of its ids."""
        if not self.by_chunk:
            found = self.plain.encode_batch([self.normalizer.normalize_str(t) for t in texts], add_special_tokens=False)
            out = [self._checked(e.ids, t) for e, t in zip(found, texts)]
            return [(*o, t) for o, t in zip(out, _texts_of(self.plain, [o[0] for o in out]))] if decoded else out
        # the text's start gets a marker, which is a space's; a marker in a text is read as a space
        split = [self.chunk.findall(" " + t.replace(MARK, " ")) if t else [] for t in texts]
        chunks = set().union(*split)
        new = [c for c in chunks if c not in self.memo]
        known = self.memo if len(self.memo) + len(new) <= MEMO_CHUNKS else {c: self.memo[c] for c in chunks if c in self.memo}
        learnt = self._learn(new)
        known.update(learnt)
        if decoded:
            self._spell(learnt)
        ids = known.__getitem__
        out = [(b"".join(map(ids, cs)), not self.wrong or self.wrong.isdisjoint(cs)) for cs in split]
        if decoded:
            # every chunk has whole characters, so the text of ids that stand in a row is that of each in a row
            whole = [not self.altered or self.altered.isdisjoint(cs) for cs in split]
            rest = iter(_texts_of(self.plain, [o[0] for o, w in zip(out, whole) if not w]))
            out = [(*o, "".join(cs).removeprefix(" ") if w else next(rest)) for o, cs, w in zip(out, split, whole)]
        if known is not self.memo:
            self.wrong.difference_update(new)
            self.altered.difference_update(new)
        return out


def _slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Runs of rows that hold about BATCH_BYTES in a column, so that a worker has few texts in memory at once."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    run = np.cumsum(sizes) // BATCH_BYTES
    starts = np.flatnonzero(np.diff(run, prepend=-1))
    for a, b in zip(starts, [*starts[1:], batch.num_rows]):
        yield batch.slice(a, b - a)


def _texts_of(decoder, ids: list[bytes | None]) -> list[str | None]:
    """The library's texts of encoded ids."""
    out = decoder.decode_batch([np.frombuffer(r or b"", "<u4").tolist() for r in ids], skip_special_tokens=False)
    return [None if r is None else t for r, t in zip(ids, out)]


def encode(docs: DataFrame, model_path: str, text: str = "text", keep: list[str] | None = None,
           decoded: bool = False) -> DataFrame:
    """``docs`` (all columns, or those in ``keep``) with ids (binary, 32 bits each) and parity; on demand also
    with ``decoded``, the text of the ids, by the same worker."""
    added = ["ids", "parity", *(["decoded"] if decoded else [])]
    keep = [c for c in keep or docs.columns if c not in added]
    schema = ", ".join(f"`{c}` {dict(docs.dtypes)[c]}" for c in keep) + ", ids binary, parity boolean"
    schema += ", decoded string" if decoded else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_worker(("sentencepiece", model_path), lambda: Encoder(model_path))
        for batch in (part for whole in batches for part in _slices(whole, text)):
            texts = batch.column(text).to_pylist()
            found = encoder.encode([t or "" for t in texts], decoded)
            ids = [None if t is None else f[0] for t, f in zip(texts, found)]
            parity = [None if t is None else f[1] for t, f in zip(texts, found)]
            more = [pa.array([None if t is None else f[2] for t, f in zip(texts, found)], pa.string())] if decoded else []
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(ids, pa.binary()), pa.array(parity, pa.bool_()), *more],
                names=[*keep, *added])

    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(run, schema)


def decode(rows: DataFrame, model_path: str, ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """``rows`` (all columns, or those in ``keep``) with ``decoded``, the text of the ids."""
    keep = [c for c in keep or rows.columns if c != "decoded"]
    schema = ", ".join(f"`{c}` {dict(rows.dtypes)[c]}" for c in keep) + ", decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = per_worker(("decoder", model_path), lambda: rebuild(parse(open(model_path, "rb").read()), normalize=False))
        for batch in (part for whole in batches for part in _slices(whole, ids)):
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(_texts_of(decoder, batch.column(ids).to_pylist()), pa.string())],
                names=[*keep, "decoded"])

    return rows.select(*dict.fromkeys([*keep, ids])).mapInArrow(run, schema)
