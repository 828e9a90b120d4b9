import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tierload.llm import collocations as C

PIECE, WORD = re.compile(r"[.,;:!?\x0A-\x0D]"), re.compile(r"[^\x20\x09]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def brute(rows, longest=3, min_count=10, percent=50, top=2000):
    count, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in PIECE.split((text or "").translate(UPPER)):
            w = WORD.findall(piece)
            total[lang] += len(w)
            for size in range(1, longest + 1):
                for i in range(len(w) - size + 1):
                    count[lang][tuple(w[i:i + size])] += 1
    out = []
    for lang, f in count.items():
        able = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        gone = {p[i:j] for p, a in able.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                if j - i < len(p) and 100 * a >= percent * f[p[i:j]]}
        best = []
        for p, a in able.items():
            if p not in gone:
                score, k = min((10 ** 6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                best.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


def both(df, **kw):
    rows = [tuple(r) for r in df.select("lang", "text").collect()]
    got = sorted(tuple(r) for r in C.collocations(df, **kw).collect())
    return got, brute(rows, **{k: v for k, v in kw.items() if k != "ranked"})


@pytest.mark.parametrize("ranked", [C.RANKED, 200, 0])
def test_table_matches_brute_force(spark, documents, ranked):
    """Also with few or no ranked ids, where the others keep their hash."""
    got, want = both(documents, ranked=ranked)
    assert got == want and len({r[0] for r in want}) >= 4


def test_longer_phrases_and_small_top(spark, documents):
    got, want = both(documents, longest=5, min_count=4, percent=80, top=30)
    assert got == want and any(len(r[2].split(" ")) == 5 for r in want)


def test_edges(spark, edge):
    got, want = both(edge, min_count=2)
    assert got == want and want
    assert C.collocations(edge.limit(0)).count() == 0
    assert C.collocations(edge.where("doc_id = 2")).count() == 0


def test_pieces_overlaps_and_languages(spark):
    rows = [("en", "Go go GO go. go\tgo!a b a b\x0ca b,"), (None, "x y x y x y"), ("und", "x y z x y"), ("de", "go go go"), ("fr", "..,;")]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got, want = both(df, min_count=2, percent=90)
    assert got == want
    assert ("en", "go go", 4) in {(r[0], r[2], r[3]) for r in got}
    assert {r[6] for r in got if r[0] == "und"} == {10}


def test_ties_keep_byte_order(spark):
    text = " . ".join(f"{a} {b}" for a, b in (("é", "x"), ("z", "y"), ("~", "q"), ("😀", "p"), ("￮", "o")))
    df = spark.createDataFrame([("en", text)] * 10, "lang string, text string")
    got, want = both(df, top=4)
    assert got == want and [r[2] for r in got] == ["z y", "~ q", "é x", "￮ o"]


def test_tiles_and_coo_agree(monkeypatch):
    """The same counts whichever tiles are dense, and when they are flushed early."""
    r = np.random.default_rng(5)
    ids = np.sort(r.integers(1, 1 << 62, 4000).astype(np.uint64))
    ranks = C.Ranks(ids, np.arange(4000), ids, None)
    x, y = (np.minimum(r.zipf(1.3, 60_000) - 1, 3999) for _ in range(2))
    want = Counter(zip(ids[x].tolist(), ids[y].tolist(), strict=True))
    for full, tiles, coo in ((1, 2, 10), (1 << 40, 2, 100), (500, 12, 1 << 30)):
        monkeypatch.setattr(C, "FULL", full)
        monkeypatch.setattr(C, "TILES", tiles)
        monkeypatch.setattr(C, "COO", coo)
        counter, got = C.TileCounter(ranks, ranks), Counter()
        batches = []
        for part in np.array_split(np.arange(60_000), 7):
            a, b = x[part], y[part]
            lost = (a + b) % 50 == 0  # as if unranked
            batches += counter.add(ids[a], ids[b], np.where(lost, -1, a), b)
        for b in [*batches, *counter.rest()]:
            for left, right, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                got[left, right] += n
        assert got == want
