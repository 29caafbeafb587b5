"""Arrow record batches of a bounded size for a consumer.

``arrow_batches`` turns a result into rows that each hold one encoded Arrow batch, made on the executors;
``iter_arrow_batches`` is the consumer edge: it pulls them partition by partition, so the caller never holds
the whole table, and no row becomes a Python object on the way.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Default rows per streamed batch and per whole-result batch.
STREAM_BATCH_ROWS = 10_000
RESULT_BATCH_ROWS = 65_536


def arrow_batches(df: DataFrame, batch_size: int = STREAM_BATCH_ROWS) -> DataFrame:
    """(n_rows, batch): the rows of ``df`` in Arrow IPC streams of at most ``batch_size`` rows each."""
    if batch_size < 1:
        raise ValueError("batch_size must be >= 1")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa

        for b in batches:
            for start in range(0, b.num_rows, batch_size):
                part = b.slice(start, batch_size)
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.schema) as writer:
                    writer.write_batch(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.num_rows], pa.int32()), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                    names=["n_rows", "batch"])

    return df.mapInArrow(encode, "n_rows int, batch binary")


def decode_batches(encoded: DataFrame, schema: T.StructType | str) -> DataFrame:
    """The rows of encoded batches."""
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa

        for b in batches:
            for raw in b.column("batch"):
                yield from pa.ipc.open_stream(raw.as_buffer())

    return encoded.mapInArrow(decode, schema)


def iter_arrow_batches(df: DataFrame, batch_size: int = STREAM_BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """Yield the result as Arrow batches of at most ``batch_size`` rows, partition by partition."""
    for row in arrow_batches(df, batch_size).toLocalIterator():
        yield from pa.ipc.open_stream(row["batch"])
