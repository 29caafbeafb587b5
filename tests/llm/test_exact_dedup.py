import collections
import hashlib

import numpy as np
import pytest
from helpers import odd_texts
from pyspark.sql import functions as F

from tablehaul.llm import exact_dedup as X

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOWER)].append(i)
    out = []
    for i, t in rows:
        norm = (t or "").translate(LOWER)
        ids = [x for x in groups[norm] if x is not None]
        keep = max(ids) if ids else None
        out.append((i, keep, len(groups[norm]), i == keep, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("digest_chars, capacity", [(64, 65536), (64, 1), (1, 65536), (1, 2)])
def test_against_brute_force(spark, digest_chars, capacity):
    rows = [(None if i % 9 == 5 else i, t) for i, t in enumerate(odd_texts() * 3 + [f"d{k % 17}" for k in range(60)])]
    df = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, kept string")
    got = X.exact_groups(df, capacity, digest_chars)
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got.collect()], key=str) == brute(rows)


def test_directory_doubles_until_buckets_fit():
    counts = np.zeros(16, np.int64)
    counts[[0, 1, 2, 9]] = [5, 5, 1, 40]
    buckets = X.directory(counts, 10)
    assert [b[0] for b in buckets] == sorted({b[0] for b in buckets})
    assert sum(16 >> d for _, d in buckets) == 16  # they tile the key space
    for start, depth in buckets:
        assert counts[start:start + (16 >> depth)].sum() <= 10 or depth == 4
    assert (9, 4) in buckets and (0, 3) in buckets
    assert X.directory(np.zeros(16, np.int64), 10) == [(0, 0)]


def test_the_index_decides(spark, monkeypatch):
    """What the owners found under a bucket and chain is what the rows get."""
    docs = spark.createDataFrame([(i, f"text {i % 5}") for i in range(20)], "doc_id long, text string")
    build = X.build_index
    monkeypatch.setattr(X, "build_index", lambda *a: build(*a).withColumn("keep_id", F.col("keep_id") - 5))
    assert {(r.doc_id % 5, r.keep_id) for r in X.exact_groups(docs).collect()} == {(i, 10 + i) for i in range(5)}
    monkeypatch.setattr(X, "build_index", lambda *a: build(*a).withColumn("_bucket", F.col("_bucket") + 1))
    assert {r.keep_id for r in X.exact_groups(docs, 1).collect()} == {None}  # nothing is found in another bucket
    monkeypatch.setattr(X, "build_index", lambda rows, hot, table: rows.groupBy("_h", "_norm").agg(F.max("doc_id").alias("keep_id")))
    with pytest.raises(Exception):  # plain groups are no index
        X.exact_groups(docs).collect()


def test_index_of_buckets_and_chains(spark):
    rows = [(i, f"text {i % 300}") for i in range(900)] + [(1000 + i, "hot") for i in range(900)]
    keyed = spark.createDataFrame(rows, "doc_id long, _norm string").withColumn("_h", X.text_hash(F.col("_norm"), 2))
    hashes = keyed.groupBy("_h").count()
    table = X.build_directory(hashes, 10)
    index = X.build_index(keyed, hashes.where("count > 500"), table).collect()
    assert len(index) == 301 and sum(r.group_size for r in index) == 1800
    chains = collections.defaultdict(list)
    for r in index:
        chains[(r._bucket, r._h)].append(r)
    assert any(len(c) > 1 for c in chains.values())
    for c in chains.values():
        assert sorted(r._chain for r in c) == list(range(1, len(c) + 1)) and {r._length for r in c} == {len(c)}
        assert len({r._norm for r in c}) == len(c) and {r.n_rows for r in c} == {sum(r.group_size for r in c)}
    per_bucket = collections.Counter(b for b, _ in chains)
    assert max(per_bucket.values()) <= 10 and len(per_bucket) > 10  # the directory has doubled until all fit


def test_drop_copies_and_empty(spark):
    rows = [(1, "a", "x"), (2, "A", "y"), (3, None, None), (4, "", "z"), (5, "b", "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(r.doc_id for r in X.drop_copies(df).collect()) == [2, 4, 5]
    assert X.drop_copies(df).columns == df.columns
    assert X.exact_groups(df.limit(0)).count() == 0


def test_no_python_in_the_plan(spark, sf_dir):
    from tablehaul.llm.queries import QUERIES
    plan = QUERIES["op3_exact_dedup"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
