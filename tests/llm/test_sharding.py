import collections
import zlib

import numpy as np
import pytest
from helpers import odd_texts

from tablehaul.llm import sharding as S


def test_draws_follow_the_hypergeometric_law():
    rng = np.random.default_rng(0)
    got = np.array([S.draw_hypergeometric(rng, 30, 70, 20) for _ in range(20000)])
    want = rng.hypergeometric(30, 70, 20, 20000)
    assert abs(got.mean() - 6) < 0.06 and abs(got.std() - want.std()) < 0.05
    assert S.draw_hypergeometric(rng, 5, 0, 3) == 3 and S.draw_hypergeometric(rng, 0, 5, 3) == 0
    big = S.draw_hypergeometric(rng, 10**12, 10**12, 10**9)
    assert abs(big - 5 * 10**8) < 10**6


def test_matrix_sums_are_exact():
    rows, shards = [17, 0, 83, 400], S.shard_sizes(500, 40)
    m = S.communication_matrix(rows, shards, 1)
    assert m.sum(axis=1).tolist() == rows and m.sum(axis=0).tolist() == shards and (m >= 0).all()


@pytest.mark.parametrize("n", [0, 1, 39, 5003])
def test_sizes_and_slots(spark, n, monkeypatch):
    monkeypatch.setattr(S, "BLOCK_ROWS", 20)
    df = spark.range(n).selectExpr("id as doc_id", "concat('t', id) as text", "'clash' as shard")
    rows = S.shuffle_into_shards(df, 40).collect()
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    sizes = [len(slots[s]) for s in range(40)]
    assert sorted(r.doc_id for r in rows) == list(range(n))
    assert max(sizes) - min(sizes) <= 1 and all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_odd_rows_and_repartitioning(spark):
    texts = odd_texts()
    rows = [(None if i % 4 == 0 else i // 2, t) for i, t in enumerate(texts)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string")
    a = sorted(map(str, S.shuffle_into_shards(df, 7).collect()))
    b = sorted(map(str, S.shuffle_into_shards(df.repartition(5), 7).collect()))
    assert a == b and len(a) == len(rows)
    assert S.shuffle_into_shards(df, 7, seed=8).count() == len(rows)


def test_order_is_random(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK_ROWS", 50)
    rows = S.shuffle_into_shards(spark.range(4000).selectExpr("id as doc_id", "'x' as text"), 4).collect()
    ids, shard, slot = (np.array([r[k] for r in rows]) for k in ("doc_id", "shard", "slot"))
    assert abs(np.corrcoef(ids, shard)[0, 1]) < 0.06 and abs(np.corrcoef(ids, slot)[0, 1]) < 0.06


def test_query(spark, sf_dir):
    from tablehaul.llm.queries import QUERIES
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op2_sharding"](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        raw = (docs[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "rows", None)
