"""Event-time windows over batch tables and over streams of files.

``event_windows`` is one plan for both: a group-by on the window and the keys, with a watermark where the input is a stream.
``run_once`` works through everything that has arrived, one micro-batch after the other, and stops; a later run with the same
checkpoint goes on from there. The file sink commits each micro-batch once, so a restart repeats and loses nothing.

A stream's window is written when the watermark (the latest event time seen, less ``delay``) has passed its end, once and for
good. A row that comes when its window is closed is late and left out; any other is counted, in whatever order rows come. A window that
is still open when a run ends waits in the state for the next one. Rows without a time belong to no window.

Times count by their own clock (zone-less) or as instants; either way windows are aligned to 1970-01-01 00:00 and
their ends come back in the type of the time column, so no session setting plays a part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.axis import axis


def as_instant(df: DataFrame, time: str) -> Column:
    """The time as an instant: a zone-less clock is taken for UTC."""
    return F.timestamp_micros(axis(df, time))


def as_clock(instant: str, like: T.DataType) -> Column:
    """An instant in the type of the original time column."""
    if isinstance(like, T.TimestampNTZType):
        return F.expr(f"timestampadd(MICROSECOND, unix_micros({instant}), TIMESTAMP_NTZ '1970-01-01 00:00:00')")
    return F.expr(instant)


def event_windows(events: DataFrame, time: str, width: str, aggregates: dict[str, Column], slide: str | None = None,
                  keys: Sequence[str] = (), delay: str = "0 seconds") -> DataFrame:
    """Rows (window_start, window_end, keys, aggregates) of tumbling windows of ``width``, or sliding ones every ``slide``.

    ``aggregates`` maps names to aggregate columns over ``events``.
    """
    kind = events.schema[time].dataType
    timed = events.withColumn("_instant", as_instant(events, time)).where(F.col("_instant").isNotNull())
    if events.isStreaming:
        timed = timed.withWatermark("_instant", delay)
    window = F.window("_instant", width, slide) if slide else F.window("_instant", width)
    found = timed.groupBy(window.alias("_window"), *keys).agg(*[c.alias(n) for n, c in aggregates.items()])
    return found.select(as_clock("_window.start", kind).alias("window_start"), as_clock("_window.end", kind).alias("window_end"),
                        *keys, *aggregates)


def file_stream(spark: SparkSession, path: str, schema: T.StructType, files_at_once: int | None = None) -> DataFrame:
    """The Parquet files under ``path`` as a stream, oldest first, ``files_at_once`` (all that are there) in a micro-batch."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    return (reader.option("maxFilesPerTrigger", files_at_once) if files_at_once else reader).parquet(path)


def run_once(rows: DataFrame, path: str, checkpoint: str, timeout: float | None = None) -> None:
    """Work through what has arrived and append the result to the Parquet table at ``path``."""
    query = (rows.writeStream.format("parquet").outputMode("append").option("path", path)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    try:
        if timeout is None:
            query.awaitTermination()
        elif not query.awaitTermination(timeout):
            raise TimeoutError(f"the stream to {path} did not end within {timeout} seconds")
    finally:
        if query.isActive:
            query.stop()


def written(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table that ``run_once`` wrote: the files of committed micro-batches."""
    return spark.read.schema(schema).parquet(path)
