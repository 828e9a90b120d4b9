import re

import pyarrow as pa
import pytest

from tierload.llm import decontam as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, window=10):
    grams = []
    for i, t in items:
        w = words(t)
        q = min(window, len(w))
        grams += [(str(i) if i is not None else "null", tuple(w[k:k + q])) for k in range(len(w) - q + 1) if q]
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for name, g in grams:
            for k in range(len(w) - len(g) + 1):
                if tuple(w[k:k + len(g)]) == g:
                    hit.update(range(k, k + len(g)))
                    found.add(name)
        out.append((i, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


DOCS = [(1, "The quick brown fox jumps over the lazy dog and runs, away from it all today"), (2, None), (3, ""), (4, "a b a b a b c d"),
        (5, "x THE QUICK brown fox jumps over the lazy dog and runs away from it all y"), (5, "dup é中 id a b"), (None, "solo word")]
ITEMS = [("q1", "quick brown fox jumps over the lazy dog and runs away from"), ("q2", "a b"), ("q3", "word"), ("q4", None), ("q5", " ,;"),
         (None, "é中 id"), ("q2", "b c"), ("q6", "the quick brown fox jumps over the lazy dog and")]


@pytest.mark.parametrize("block_words", [1_000_000, 5])
def test_hits_match_brute_force(spark, block_words):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").repartition(3)
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    got = sorted(((r[0], r[1], r[2], r[3]) for r in D.hits(docs, items, block_words=block_words).collect()), key=repr)
    assert got == brute(DOCS, ITEMS)


def test_hits_on_the_table(spark, documents):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    d = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    i = [tuple(r) for r in items.select("item_id", "text").collect()]
    got = sorted((tuple(r) for r in D.hits(documents, items, block_words=700).collect()), key=repr)
    want = brute(d, i)
    assert got == want and any(r[2] for r in want)


def test_longest_matches(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS[:1], "item_id string, text string")
    got = sorted(tuple(r) for r in D.matches(docs, items).collect())
    assert got == [(1, 1, "q1", 0, 12), (5, 2, "q1", 0, 12)]


def test_suffixes_are_sorted_and_ranges_complete():
    q = D.QueryBlock(["a"], pa.array(["b c d"]), 3)
    s = D.Shard(pa.array(["b c d b c d", "c d b c"]), q)
    assert list(s.keys) == sorted(s.keys)
    place, _ = s.occurrences()
    assert sorted(place.tolist()) == [0, 3]


def test_edges_and_clean(spark, edge):
    items = spark.createDataFrame([("i", "alpha beta gamma")], "item_id string, text string")
    kept = D.clean(edge, items)
    assert kept.columns == edge.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 5, 6, 7, 8, 9]
    none = items.limit(0)
    assert D.clean(edge, none).count() == edge.count()
    assert D.hits(edge.limit(0), items).count() == 0
