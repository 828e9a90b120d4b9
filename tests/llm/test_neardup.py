import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tierload.llm import neardup as N

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(t, q):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    if len(w) < q:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + q]) for i in range(len(w) - q + 1)}


def brute(rows, q, percent=80):
    sets = [(i, shingle_set(t, q)) for i, t in rows]
    name = {i: i for i, _ in sets if i is not None}

    def root(x):
        while name[x] != x:
            x = name[x]
        return x

    real = [(i, s) for i, s in sets if s and i is not None]
    for k, (i, s) in enumerate(real):
        for j, t in real[:k]:
            if min(len(s), len(t)) * 100 >= percent * max(len(s), len(t)):
                both = len(s & t)
                if 100 * both >= percent * (len(s) + len(t) - both):
                    a, b = sorted((root(i), root(j)))
                    name[b] = a
    return sorted(((i, len(s), root(i) if i is not None else None, i is None or root(i) == i) for i, s in sets), key=repr)


def check(df, q=4):
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in N.near_duplicates(df, q=q).collect()), key=repr)
    assert got == brute(rows, q)
    return got


def test_table_matches_brute_force(spark, documents):
    got = check(documents)
    assert any(not r[3] for r in got)


def test_chains_hubs_and_families(spark):
    r = random.Random(5)
    base = [f"w{i}" for i in range(300)]
    texts = [" ".join(base)]
    for _ in range(60):  # variants near the base, far from one another
        w = list(base)
        for _ in range(7):
            w[r.randrange(300)] = f"n{r.random()}"
        texts.append(" ".join(w))
    chain = [f"c{i}" for i in range(200)]
    for k in range(12):  # each near the next one only
        texts.append(" ".join(chain[12 * k:] + [f"e{i}" for i in range(12 * k)]))
    rows = [(1000 - i if i % 2 else i, t) for i, t in enumerate(texts)]
    got = check(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert len({c for _, _, c, _ in got}) < len(rows) / 2


def test_hubs_are_confirmed_in_parts(spark, monkeypatch):
    monkeypatch.setattr(N, "PART", 3)
    sets = spark.createDataFrame([(i, 4, [1, 2, 3, 4 if i % 2 else -i]) for i in range(1, 41)],
                                 "node long, n int, shingles array<long>")
    pairs = ([(1, i) for i in range(2, 31)] + [(i, 40) for i in range(2, 31)])   # a hub on either side
    got = N.confirm(spark.createDataFrame(pairs, "a long, b long"), sets, 80).collect()
    assert sorted((r.a, r.b, r.linked) for r in got) == sorted((a, b, a % 2 == 1 and b % 2 == 1) for a, b in pairs)
    assert N.confirm(spark.createDataFrame([], "a long, b long"), sets, 80).count() == 0


def test_guaranteed_distance():
    """All pairs up to the pigeonhole distance share an index key."""
    from itertools import combinations
    r = np.random.default_rng(2)
    most = N.CHUNKS * (N.ERRORS + 1) - 1
    for _ in range(300):
        wrong = r.permutation(N.SYMBOLS)[:most]
        ok = np.ones(N.SYMBOLS, bool)
        ok[wrong] = False
        assert any(ok.reshape(N.CHUNKS, N.CHUNK)[c, list(k)].all() for c in range(N.CHUNKS)
                   for k in combinations(range(N.CHUNK), N.CHUNK - N.ERRORS))


def test_signature_estimates_similarity():
    words = [f"w{i}" for i in range(2000)]
    a, b = " ".join(words), " ".join(words[:1800] + [f"x{i}" for i in range(200)])
    first, h, n = N.shingles(pa.array([a, b]), 4)
    s = N.signatures(first, h, n)
    want = 1 - len(shingle_set(a, 4) & shingle_set(b, 4)) / len(shingle_set(a, 4) | shingle_set(b, 4))
    assert abs((s[0] != s[1]).mean() - want) < 0.2


@pytest.mark.parametrize("q", [4, 5])
def test_edges(spark, edge, q):
    check(edge.select("doc_id", "text"), q)
    kept = N.deduplicate(edge)
    assert kept.columns == edge.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "2", "3", "None", "5", "7", "8", "9"])
    assert N.near_duplicates(edge.limit(0)).count() == 0
