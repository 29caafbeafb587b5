"""Cost-balanced packing of documents into token sequences.

Each document's ids (and an end id) are cut where they exceed the sequence length: whole sequences first,
the rest is packed. The cost of a piece of n ids is linear plus quadratic (attention) in n. In descending
order of length, each piece goes to the lowest-cost sequence with room for it; where no room is large
enough, it is cut at the lowest-cost sequence that has room left. Only as many sequences are opened as the
ids need, so at most one sequence of a group is padded.

Scale: documents are dealt by a hash into groups of about GROUP_DOCS, or of GROUP_BYTES of text where they are long, each packed
by one task; one shuffle of the ids, 2 bytes each. A word is encoded once per worker and kept in a bounded memo; the ids are those of
the tokenizers library, which encodes every new word, and the whole text where it holds anything but Latin
letters, digits and common signs.

Defined cases: null text is empty and has the end id alone; repeated rows are packed like any others, each
by itself; null ids pass through; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_worker, small, trim

SEQUENCE_TOKENS = 2048
END_ID = 1
# A group is packed by one task: so many documents on average, fewer where they are long.
GROUP_DOCS = 2048
GROUP_BYTES = 8 << 20
LINEAR_COST = 1.0
QUADRATIC_COST = 1.0 / 4096
MEMO_WORDS = 200_000

# The tokenizer's own split of lower-cased text, over the alphabet that PLAIN admits; fixed values.
LETTERS = "a-zªµºß-öø-ɏ"
DIGITS = "0-9²³¹¼½¾"
WORD = re.compile(f"[{LETTERS}]+|[{DIGITS}]|'s|'t|'re|'ve|'m|'ll|'d|[^\\s{LETTERS}{DIGITS}]+")
PLAIN = re.compile("[\t\n\v\f\r -~\xa0-\u024f\u2010-\u2027\u2030-\u205e\u20a0-\u20bf]*")


class WordEncoder(dict):
    """Ids of texts as little-endian 16-bit numbers, by the tokenizers library, each new word once.

    The dict keeps the first MEMO_WORDS words, among them the frequent ones; later words are encoded anew.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 65536:
            raise ValueError("16-bit ids need a vocabulary of at most 65,536")
        self.as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

    def __missing__(self, word: str) -> bytes:
        letters = word if word.isascii() else self.as_bytes.pre_tokenize_str(word)[0][0]
        ids = array("H", [t.id for t in self.tokenizer.model.tokenize(letters)]).tobytes()
        if len(self) < MEMO_WORDS:
            self[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if "<|" in text or not PLAIN.fullmatch(text):
            return array("H", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.__getitem__, WORD.findall(text.replace("Σ", "σ").lower())))


def tokenize(rows: DataFrame, tokenizer_path: str, keep: list[str]) -> DataFrame:
    """rows(keep..., text) -> keep..., ids (binary, 16 bits each, with the end id)."""
    schema = ", ".join(f"`{c}` {dict(rows.dtypes)[c]}" for c in keep) + ", ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_worker(("words", tokenizer_path), lambda: WordEncoder(tokenizer_path))
        end = np.array([END_ID], "<u2").tobytes()
        for batch in small(batches):
            ids = [encoder.encode(t.as_py() or "") + end for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(ids, pa.binary())],
                                             names=[*keep, "ids"])
        trim()

    return rows.mapInArrow(run, schema)


def cost(n: np.ndarray | int) -> np.ndarray | float:
    return LINEAR_COST * n + QUADRATIC_COST * n * n


def pack_lengths(lengths: list[int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of documents with these numbers of ids."""
    pieces, rest, sequence = [], [], 0
    for d, n in enumerate(lengths):
        whole = n // capacity
        for k in range(whole):
            pieces.append((d, k * capacity, capacity, sequence, 0))
            sequence += 1
        if n % capacity:
            rest.append((n % capacity, d, whole * capacity))
    opened = -(-sum(n for n, _, _ in rest) // capacity)
    room, spent = np.full(opened, capacity, np.int64), np.zeros(opened)
    for n, d, start in sorted(rest, key=lambda x: (-x[0], x[1])):
        while n:
            fits = room >= n
            if not fits.any():
                fits = room > 0
            j = int(np.where(fits, spent, np.inf).argmin())
            put = min(n, int(room[j]))
            pieces.append((d, start, put, sequence + j, capacity - int(room[j])))
            room[j] -= put
            spent[j] += cost(put)
            n, start = n - put, start + put
    return pieces


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = SEQUENCE_TOKENS) -> DataFrame:
    """Pieces of the documents: doc_id, start, length, doc_tokens, sequence_id, offset, ids (binary, 32 bits each)."""
    size = docs.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length(F.col("text").cast("string"))).alias("bytes")).first()
    groups = max(1, -(-size["rows"] // GROUP_DOCS), -(-(size["bytes"] or 0) // GROUP_BYTES))
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("_group", F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).cast("long"))
    encoded = tokenize(rows, tokenizer_path, ["doc_id", "_group"])

    def pack_group(key: tuple, table: pa.Table) -> pa.Table:
        per_worker("groups", lambda: None)  # the words' ids aren't needed any more
        table = table.sort_by([("doc_id", "ascending"), ("ids", "ascending")])
        ids = [np.frombuffer(b, "<u2") for b in table.column("ids").to_pylist()]
        found = pack_lengths([len(x) for x in ids], capacity)
        long = pa.int64()
        return pa.table({
            "doc_id": table.column("doc_id").take([p[0] for p in found]) if found else table.column("doc_id")[:0],
            "start": pa.array([p[1] for p in found], long),
            "length": pa.array([p[2] for p in found], long),
            "doc_tokens": pa.array([len(ids[p[0]]) for p in found], long),
            "sequence_id": pa.array([(key[0].as_py() << 32) + p[3] for p in found], long),
            "offset": pa.array([p[4] for p in found], long),
            "ids": pa.array([ids[d][s:s + n].astype("<u4").tobytes() for d, s, n, _, _ in found], pa.binary()),
        })

    schema = (f"doc_id {dict(rows.dtypes)['doc_id']}, start long, length long, doc_tokens long, sequence_id long, "
              "offset long, ids binary")
    return encoded.groupBy("_group").applyInArrow(pack_group, schema)
