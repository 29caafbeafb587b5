import hashlib
import random
import zlib

import pytest

from tablehaul.llm import prefix_trie as P
from tablehaul.llm.queries import QUERIES, rebuilt_conversations


def brute(convs):
    """{conversation: [(turn, size)]} -> rows of all nodes, by sets of prefixes."""
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(t for t, _ in turns[:d]), []).append(c)
    size = {tuple(t for t, _ in turns[:d]): turns[d - 1][1] if d else 0 for turns in convs.values() for d in range(len(turns) + 1)}
    children = {}
    for path in nodes:
        if path:
            children.setdefault(path[:-1], []).append(path)
    out = []
    for path, members in nodes.items():
        below = [p for p in nodes if p[:len(path)] == path]
        ends = sorted(c for c in members if len(convs[c]) == len(path))
        out.append((min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members), len(children.get(path, [])),
                    sum(p not in children for p in below), sum((len(nodes[p]) - 1) * size[p] for p in below),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def shown(df):
    return sorted([(r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
                   for r in df.collect()], key=str)


def random_convs(n, seed, deep=7, width=2):
    """Conversations with many common prefixes, copies, nested ones and some without turns."""
    rng = random.Random(seed)
    convs = {}
    for c in rng.sample(range(10 * n), n):
        kind = rng.random()
        if convs and kind < 0.3:
            turns = rng.choice(list(convs.values()))
            convs[c] = list(turns[:rng.randint(0, len(turns))])
        else:
            convs[c] = [(f"t{rng.randrange(width)}", 0) for _ in range(rng.randint(0, deep))]
    convs[10 * n + 3] = [(f"long{i}", 0) for i in range(70)]  # two copies of a deep one
    convs[10 * n + 7] = convs[10 * n + 3] + [("more", 0)]
    return {c: [(t, len(t) + i % 3) for i, (t, _) in enumerate(ts)] for c, ts in convs.items()}


def frame(spark, convs, extra=()):
    rows = [(c, i * 10, t.encode(), s, "clash") for c, ts in convs.items() for i, (t, s) in enumerate(ts)]
    rows += [(c, None, None, 0, "clash") for c, ts in convs.items() if not ts or c % 2]
    return spark.createDataFrame([*rows, *extra], "conv_id long, position long, digest binary, size long, node string").repartition(5)


@pytest.mark.parametrize("shard, piece, n", [(4096, 256, 60), (3, 2, 60), (1, 1, 25)])
def test_against_brute_force(spark, monkeypatch, shard, piece, n):
    monkeypatch.setattr(P, "LEAST_TURNS", 20)
    convs = random_convs(n, seed=shard)
    extra = [(None, 0, b"x", 5, "no conversation"), (None, None, None, 0, "x")]
    assert shown(P.trie(frame(spark, convs, extra), shard_convs=shard, end_piece=piece)) == brute(convs)


def test_shards_are_cut_and_merged():
    """The shards of a range hold the conversations one after the other; a digest tells the same node apart nowhere."""
    convs, turns = [1, 2, 5, 9], [[b"a", b"b"], [b"a"], [b"a", b"b"], []]
    rows = list(P.local_nodes(convs, turns, [[3, 4], [3], [3, 4], []]))
    assert [(r[2], r[4], r[6], r[7], r[8], r[9], r[10]) for r in rows] == [
        (0, 1, 4, 1, 1, 10, ["9"]), (1, 1, 3, 1, 1, 10, ["2"]), (2, 1, 2, 0, 1, 4, ["1,5"])]
    other = list(P.local_nodes([20], [[b"a", b"b", b"c"]], [[3, 4, 1]]))
    assert [r[0] for r in other[:3]] == [r[0] for r in rows]


def rebuilt(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            key = hashlib.sha256(b"".join(f"{len(x)}:{x}".encode() for x in (role or "", text or ""))).digest()
            own.setdefault(c, []).append((turn is not None, turn or 0, key, len((text or "").encode())))
    own = {c: [(k, s) for _, _, k, s in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + ts[h:]
    return out


def odd_conversations(spark):
    rows = [(0, None, "user", "first"), (0, 1, None, None), (0, 1, "user", "x"), (0, 1, "user", "x"), (0, 2, "a", "é" * 9)]
    rows += [(c, t, "user", f"q{t}") for c in (1, 2, 3, 4) for t in range(c * 3)]
    rows += [(7, 0, "user", "alone"), (None, 0, "user", "nobody"), (8, 0, "u", "ser"), (9, 0, "us", "er")]
    rows += [(c, t, "user", f"same {t}") for c in range(20, 60) for t in range(6)]
    rows += [(61, t, "user", "deep %d" % (t % 7)) for t in range(300)]
    return rows, spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, digest int")


def test_rebuilt_conversations_with_odd_rows(spark):
    rows, df = odd_conversations(spark)
    assert shown(P.trie(rebuilt_conversations(df))) == brute(rebuilt(rows))
    assert P.trie(rebuilt_conversations(df.limit(0))).count() == 0


def test_whole_query_and_its_turns(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    assert shown(QUERIES["op11_prefix_trie"](spark, sf_dir)) == brute(rebuilt(rows))


def test_with_turns(spark):
    convs = {3: [("a", 1), ("b", 1)], 4: [("a", 1)]}
    turns = spark.createDataFrame([(c, i, t) for c, ts in convs.items() for i, (t, _) in enumerate(ts)], "conv_id long, position int, text string")
    nodes = P.trie(frame(spark, convs))
    got = P.with_turns(nodes, turns, ["text"]).collect()
    assert sorted([(r.depth, r.text) for r in got], key=str) == [(0, None), (1, "a"), (2, "b")]
