"""Sessions: the events of a key with no gap of ``gap`` or more between one and the next.

``sessions`` makes them of a table. Events are cut into pieces by key and time bucket, so a key with most of the rows is spread
over its buckets; each piece makes its own sessions, and a window over those (a few rows a piece) joins what goes on over a border.

``session_stream`` makes the same sessions of a stream, with state per key: the open sessions, and a timer for when the watermark
passes the first one's end plus the gap. Then that session is given out, once and for good. Rows may come in any order; one that
is older than the watermark is late and left out. Both count a session's events and add up a value.

Rows without a time belong to no session; events without a key are those of the key NULL. A NULL value adds nothing. Times are
handled as in ``windows``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.axis import axis
from .windows import as_clock, as_instant

MICROS = 1_000_000


def _micros(gap: timedelta) -> int:
    micros = gap // timedelta(microseconds=1)
    if micros <= 0:
        raise ValueError("gap must be > 0")
    return micros


def _joined(rows: DataFrame, partition: list[str], order: str, begin: str, end: str, gap: int) -> DataFrame:
    """``rows`` with _no: rows of a partition go on with the rows before them while less than ``gap`` lies between."""
    before = Window.partitionBy(*partition).orderBy(order)
    reached = F.max(end).over(before.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.coalesce((F.col(begin) - reached >= gap).cast("long"), F.lit(1))
    return rows.withColumn("_fresh", fresh).withColumn(
        "_no", F.sum("_fresh").over(before.rowsBetween(Window.unboundedPreceding, Window.currentRow)))


def sessions(events: DataFrame, time: str, keys: Sequence[str], gap: timedelta, value: str | None = None,
             bucket: timedelta | None = None) -> DataFrame:
    """Rows (keys, session_start, session_end, n_events, total): the first and the last event of each session, how many there
    are and the sum of ``value``. ``bucket`` is the length of a piece (1,000 gaps where None)."""
    micros = _micros(gap)
    width = _micros(bucket) if bucket is not None else 1000 * micros
    kind = events.schema[time].dataType
    keys = list(keys)
    amount = F.col(value).cast("double") if value else F.lit(None).cast("double")
    rows = events.select(*keys, axis(events, time).alias("_t"), amount.alias("_v")).where(F.col("_t").isNotNull())
    rows = rows.withColumn("_b", F.floor(F.col("_t") / F.lit(width)))
    pieces = _joined(rows, [*keys, "_b"], "_t", "_t", "_t", micros).groupBy(*keys, "_b", "_no").agg(
        F.min("_t").alias("_s"), F.max("_t").alias("_e"), F.count(F.lit(1)).alias("_n"), F.sum("_v").alias("_v"))
    whole = _joined(pieces.drop("_no"), keys, "_s", "_s", "_e", micros).groupBy(*keys, "_no").agg(
        F.timestamp_micros(F.min("_s")).alias("_s"), F.timestamp_micros(F.max("_e")).alias("_e"), F.sum("_n").alias("n_events"),
        F.sum("_v").alias("total"))
    return whole.select(*keys, as_clock("_s", kind).alias("session_start"), as_clock("_e", kind).alias("session_end"), "n_events", "total")


STATE_TYPE = "starts array<long>, ends array<long>, counts array<long>, totals array<double>"


def _merge(open_sessions: list[list], gap: int) -> list[list]:
    """Sessions [start, end, n, total] joined where less than ``gap`` lies between."""
    out: list[list] = []
    for s, e, n, total in sorted(open_sessions, key=lambda x: x[:2]):
        if out and s - out[-1][1] < gap:
            last = out[-1]
            last[1], last[2] = max(last[1], e), last[2] + n
            last[3] = total if last[3] is None else last[3] if total is None else last[3] + total
        else:
            out.append([s, e, n, total])
    return out


def _due(end: int, gap: int) -> int:
    """The millisecond at which a session is over."""
    return -(-(end + gap) // 1000)


def session_stream(events: DataFrame, time: str, keys: Sequence[str], gap: timedelta, delay: str, value: str | None = None) -> DataFrame:
    """The sessions of a stream, each as the watermark passes its end plus the gap (columns as in ``sessions``)."""
    micros = _micros(gap)
    kind = events.schema[time].dataType
    keys = list(keys)
    amount = F.col(value).cast("double") if value else F.lit(None).cast("double")
    rows = events.select(*keys, as_instant(events, time).alias("_instant"), axis(events, time).alias("_t"), amount.alias("_v"))
    rows = rows.where(F.col("_t").isNotNull()).withWatermark("_instant", delay)
    names = [f"_k{i}" for i in range(len(keys))]
    out_type = T.StructType([T.StructField(n, events.schema[k].dataType) for n, k in zip(names, keys)] + [
        T.StructField("_s", T.LongType()), T.StructField("_e", T.LongType()), T.StructField("n_events", T.LongType()),
        T.StructField("total", T.DoubleType())])

    def step(key: tuple, frames: Iterator, state) -> Iterator:
        import pandas as pd

        open_sessions = []
        if state.exists:
            open_sessions = [list(x) for x in zip(*state.get)]
            open_sessions = [[s, e, n, None if t != t else t] for s, e, n, t in open_sessions]
        watermark = state.getCurrentWatermarkMs()
        if not state.hasTimedOut:
            for frame in frames:
                frame = frame[frame["_t"] >= watermark * 1000] if watermark > 0 else frame  # others are late
                values = [None if v != v else v for v in frame["_v"].astype("float64")]
                open_sessions = _merge(open_sessions + [[int(t), int(t), 1, v] for t, v in zip(frame["_t"], values)], micros)
        over = [x for x in open_sessions if _due(x[1], micros) < watermark]
        left = [x for x in open_sessions if _due(x[1], micros) >= watermark]
        if left:
            starts, ends, counts, totals = (list(x) for x in zip(*left))
            state.update((starts, ends, counts, [float("nan") if t is None else t for t in totals]))
            state.setTimeoutTimestamp(max(min(_due(e, micros) for e in ends), watermark + 1))
        elif state.exists:
            state.remove()
        if over:
            columns = {n: [k] * len(over) for n, k in zip(names, key)}
            columns |= {c: [x[i] for x in over] for i, c in enumerate(("_s", "_e", "n_events", "total"))}
            yield pd.DataFrame(columns)[out_type.fieldNames()]

    from pyspark.sql.streaming.state import GroupStateTimeout

    found = rows.groupBy(*keys).applyInPandasWithState(step, out_type, STATE_TYPE, "append", GroupStateTimeout.EventTimeTimeout)
    found = found.withColumn("_s", F.timestamp_micros("_s")).withColumn("_e", F.timestamp_micros("_e"))
    return found.select(*[F.col(n).alias(k) for n, k in zip(names, keys)], as_clock("_s", kind).alias("session_start"),
                        as_clock("_e", kind).alias("session_end"), "n_events", "total")
