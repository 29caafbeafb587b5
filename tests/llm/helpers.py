"""Fixtures and brute-force versions shared by the tests of this folder."""

import collections
import random
import re

WORDS = "the of and to in is that was for it with as his on be at by had not are but from or have an".split()


def prose(rng, n, vocabulary=None):
    words = vocabulary or WORDS + ["w%d" % i for i in range(200)]
    return " ".join(rng.choice(words) for _ in range(n))


def documents(spark, rows):
    """rows of (doc_id, text, lang, source); n_chars is filled in."""
    full = [(i, t, lang, source, len(t) if t is not None else None) for i, t, lang, source in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")


def tables(spark, tmp_path, **frames):
    """Write frames as the tables of an input folder."""
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def odd_texts(seed=3):
    """Nulls, empties, repeats, ties, signs only, and a very long text."""
    rng = random.Random(seed)
    long = prose(rng, 9000)
    a = prose(rng, 60)
    return [None, "", "", " \n\t ", "...!?", "a", "A", a, a, a.upper(), long, long, a + " tail", "é É ß 中文 \U0001f600", "x\n\ny\n"]


def shingles(text, k=5):
    words = re.findall(r"\w+", (text or "").lower())
    if not words:
        return None
    return collections.Counter(tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1)))


def similarity(x, y):
    low = sum(min(n, y[s]) for s, n in x.items())
    return low / (sum(x.values()) + sum(y.values()) - low)


def near_classes(rows, threshold=0.8):
    """doc_id -> smallest doc_id of its class, by comparing all pairs."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = [i for i in sets if sets[i]]
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if find(i) != find(j) and similarity(sets[i], sets[j]) >= threshold:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in sets}
