"""Windows and sessions over tables and streams of files: late rows, restarts, and both against brute force."""

import collections
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tablehaul.streaming import event_windows, file_stream, run_once, session_stream, sessions, written

DAY = dt.datetime(2024, 5, 1)
SCHEMA = "id long, at timestamp_ntz, user string, value double"


def counts():
    return {"n": F.count(F.lit(1)), "total": F.sum("value")}


def clock(hours):
    return None if hours is None else DAY + dt.timedelta(hours=hours)


class Feed:
    """A folder into which batches of (id, hours, user, value) arrive, and a stream over it."""

    def __init__(self, spark, folder, plan, files_at_once=None):
        self.spark, self.base, self.plan, self.n, self.files = spark, str(folder), plan, 0, files_at_once

    def arrive(self, rows):
        df = self.spark.createDataFrame([(i, clock(h), u, v) for i, h, u, v in rows], SCHEMA)
        df.coalesce(1).write.parquet(f"{self.base}/in/batch-{self.n}")
        self.n += 1

    def run(self):
        out = self.plan(file_stream(self.spark, f"{self.base}/in", self.spark.createDataFrame([], SCHEMA).schema, self.files))
        run_once(out, f"{self.base}/out", f"{self.base}/checkpoint", timeout=180)
        return [tuple(r) for r in written(self.spark, f"{self.base}/out", out.schema).collect()]


def events(n, seed, span=200.0):
    rng = random.Random(seed)
    return sorted(((i, round(rng.uniform(0, span), 3), rng.choice("aaaab"), float(rng.randrange(9))) for i in range(n)), key=lambda r: r[1])


def by_window(rows, width, slide=None, keyed=True):
    slide = slide or width
    out = collections.defaultdict(lambda: [0, 0.0])
    for _, h, u, v in rows:
        at = h // slide * slide
        while at > h - width:
            cell = out[(clock(at), clock(at + width), *((u,) if keyed else ()))]
            cell[0] += 1
            cell[1] += v
            at -= slide
    return sorted((*k, *v) for k, v in out.items())


def test_batch_windows_and_rows_without_a_time(spark):
    rows = events(300, 1)
    df = spark.createDataFrame([(i, clock(h), u, v) for i, h, u, v in rows] + [(999, None, "a", 1.0)], SCHEMA)
    assert sorted(map(tuple, event_windows(df, "at", "6 hours", counts(), keys=["user"]).collect())) == by_window(rows, 6)
    assert sorted(map(tuple, event_windows(df, "at", "24 hours", counts(), slide="8 hours").collect())) == by_window(rows, 24, 8, False)
    assert event_windows(df.limit(0), "at", "6 hours", counts()).count() == 0


def test_windows_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([(1, clock(5.5), "a", 1.0)], SCHEMA)
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Kathmandu", "America/St_Johns"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            row = event_windows(df, "at", "24 hours", counts()).first()
            assert (row.window_start, row.window_end) == (clock(0), clock(24))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("width, slide", [(6, None), (24, 8)])
def test_stream_with_a_restart_gives_the_closed_windows_of_the_batch(spark, tmp_path, width, slide):
    rows = events(240, 2)
    feed = Feed(spark, tmp_path, lambda e: event_windows(e, "at", f"{width} hours", counts(), keys=["user"], delay="2 hours",
                                                        slide=f"{slide} hours" if slide else None))
    seen = []
    for k in range(4):
        feed.arrive(rows[60 * k:60 * k + 60])
        out = feed.run()  # stops, and starts again from its checkpoint
        assert set(seen) <= set(out)  # what was given out stays as it is
        seen = out
    mark = clock(rows[-1][1] - 2)
    assert sorted(seen) == [w for w in by_window(rows, width, slide) if w[1] <= mark] and len(seen) > 20
    assert sorted(feed.run()) == sorted(seen)  # nothing new has arrived


def test_late_rows_are_left_out_and_others_counted_in_any_order(spark, tmp_path):
    feed = Feed(spark, tmp_path, lambda e: event_windows(e, "at", "1 hour", counts(), delay="2 hours"))
    feed.arrive([(1, 9.5, "a", 1.0), (2, 12.0, "a", 1.0)])  # the watermark goes to 10:00
    feed.run()
    feed.arrive([(3, 9.7, "a", 100.0), (4, 10.2, "a", 1.0), (5, 11.5, "a", 1.0), (6, 10.1, "a", 1.0), (7, None, "a", 1.0)])  # 3 is late
    feed.run()
    feed.arrive([(8, 30.0, "a", 1.0)])
    out = {r[0]: r[2:] for r in feed.run()}
    assert out == {clock(9): (1, 1.0), clock(10): (2, 2.0), clock(11): (1, 1.0), clock(12): (1, 1.0)}


def by_gap(rows, gap):
    users = collections.defaultdict(list)
    for _, h, u, v in rows:
        users[u].append((h, v))
    out = []
    for u, found in users.items():
        run = []
        for h, v in sorted(found, key=lambda x: x[0]):
            if run and h - run[-1][0] >= gap:
                out.append((u, run))
                run = []
            run.append((h, v))
        out.append((u, run))
    return sorted(((u, clock(r[0][0]), clock(r[-1][0]), len(r), None if all(v is None for _, v in r) else sum(v or 0 for _, v in r))
                   for u, r in out), key=str)


@pytest.mark.parametrize("bucket", [None, 1, 7, 1000])
def test_batch_sessions_over_borders_of_pieces(spark, bucket):
    rows = events(150, 3) + [(200 + i, 300 + i, "long", None) for i in range(60)] + [(400, 5.0, None, 1.0), (401, 5.0, None, 1.0)]
    rows += [(500, 10.0, "edge", 1.0), (501, 12.0, "edge", 1.0), (502, 13.999, "edge", 1.0)]  # a gap of two hours parts, less doesn't
    df = spark.createDataFrame([(i, clock(h), u, v) for i, h, u, v in rows] + [(999, None, "a", 1.0)], SCHEMA).repartition(5)
    got = sessions(df, "at", ["user"], dt.timedelta(hours=2), "value", bucket=dt.timedelta(hours=bucket) if bucket else None)
    assert sorted(map(tuple, got.collect()), key=str) == by_gap(rows, 2)
    assert sessions(df.limit(0), "at", ["user"], dt.timedelta(hours=2)).count() == 0
    with pytest.raises(ValueError):
        sessions(df, "at", ["user"], dt.timedelta(0))


def test_session_stream_gives_the_sessions_of_the_batch(spark, tmp_path):
    rows = events(160, 4)
    feed = Feed(spark, tmp_path, lambda e: session_stream(e, "at", ["user"], dt.timedelta(hours=3), "1 hour", "value"))
    seen = []
    for k in range(4):
        feed.arrive(rows[40 * k:40 * k + 40])  # sessions go on over the borders of batches
        out = feed.run()
        assert set(seen) <= set(out)
        seen = out
    mark = clock(rows[-1][1] - 1)
    want = [s for s in by_gap(rows, 3) if s[2] + dt.timedelta(hours=3) < mark]
    assert sorted(seen, key=str) == want and len(want) > 10
    borders = [clock(rows[40 * k][1]) for k in (1, 2, 3)]
    assert any(s[1] < b <= s[2] for s in want for b in borders)


def test_session_stream_joins_what_comes_out_of_order_and_drops_late_rows(spark, tmp_path):
    feed = Feed(spark, tmp_path, lambda e: session_stream(e, "at", ["user"], dt.timedelta(hours=1), "4 hours", "value"), files_at_once=1)
    feed.arrive([(1, 10.0, "a", 1.0), (2, 11.5, "a", None), (3, 12.0, "b", 1.0)])  # the watermark goes to 8:00
    feed.arrive([(4, 10.8, "a", 1.0), (5, 7.0, "a", 100.0), (6, None, "a", 1.0)])  # 4 joins 1 and 2, 5 is late
    feed.arrive([(7, 40.0, "b", 1.0)])
    assert sorted(feed.run()) == [("a", clock(10), clock(11.5), 3, 2.0), ("b", clock(12), clock(12), 1, 1.0)]
