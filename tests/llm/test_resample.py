import hashlib
import math
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tierload.llm import resample as R

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def features(text):
    w = WORD.findall((text or "").translate(UPPER))
    return w, w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]


def brute(rows, target, percent=25, seed=7, buckets=10_000):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    s, t = [0] * buckets, [0] * buckets
    for count, texts in ((s, [x for _, x in rows]), (t, target)):
        for x in texts:
            for f in features(x)[1]:
                count[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in range(buckets)]
    out = []
    for i, x in rows:
        w, f = features(x)
        weight = sum(gain[bucket(g)] for g in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(w), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    rank = {}
    for k, r in enumerate(able[:percent * len(able) // 100], 1):
        rank.setdefault(r, []).append(k)
    return sorted(((*r, rank[r].pop(0) if rank.get(r) else None) for r in out), key=repr)


def both(df, target, **kw):
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in R.resample(df, target, **kw).collect()), key=repr)
    return got, brute(rows, [r.text for r in target.collect()], **kw)


def test_table_matches_brute_force(spark, documents):
    got, want = both(documents, spark.read.parquet(f"{SF_SMALL}/benchmark.parquet"))
    assert got == want
    able = sum(r[1] >= 20 for r in want)
    assert sorted(r[5] for r in got if r[5]) == list(range(1, able // 4 + 1))


def test_edges(spark, edge):
    target = spark.createDataFrame([("alpha w1x1",), (None,), ("",)], "text string")
    got, want = both(edge, target, percent=60)
    assert got == want and any(r[5] for r in want)
    got, want = both(edge, target.limit(0))
    assert got == want
    assert R.resample(edge.limit(0), target).count() == 0


def test_target_like_documents_are_drawn(spark):
    rows = [(i, " ".join(f"{'law' if i % 4 == 0 else 'sea'}{(i * 7 + k) % 50}" for k in range(200))) for i in range(200)]
    target = spark.createDataFrame([(" ".join(f"law{k}" for k in range(50)),)] * 40, "text string")
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    drawn = [r.doc_id for r in R.resample(df, target).where("rank is not null").collect()]
    assert len(drawn) == 50 and sum(i % 4 == 0 for i in drawn) >= 40  # a blind draw takes some 12


def test_reruns_and_partitions_agree(spark, documents):
    target = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    a = sorted((tuple(r) for r in R.resample(documents.repartition(7), target).collect()), key=repr)
    b = sorted((tuple(r) for r in R.resample(documents.repartition(2), target).collect()), key=repr)
    assert a == b


def test_compose_equals_crc():
    r = np.random.default_rng(3)
    parts = [bytes(r.integers(0, 256, int(n)).tolist()) for n in [0, 1, 2, 7, 300, 70_001, *r.integers(0, 60, 50)]]
    a, b = parts, parts[::-1]
    got = R.compose(np.array([zlib.crc32(x) for x in a], np.uint32), np.array([zlib.crc32(x) for x in b], np.uint32),
                    np.array([len(x) for x in b], np.int64))
    assert got.tolist() == [zlib.crc32(x + y) for x, y in zip(a, b, strict=True)]


def test_words_are_whole_and_overlap(spark):
    """A word inside a longer one is no match, and neighbours share their delimiter."""
    import pyarrow as pa
    row, crc, size = R.payloads(pa.array(["a ab  abc-a,é\x00b", None, "", "ab"]))
    words = ["a", "ab", "abc", "a", "é", "b", "ab"]
    assert row.tolist() == [0] * 6 + [3]
    assert crc.tolist() == [zlib.crc32(w.encode()) for w in words] and size.tolist() == [len(w.encode()) for w in words]


def test_ranks_over_many_ranges(spark):
    df = spark.range(5000).select(F.col("id"), (F.col("id") % 7).alias("score"))
    out, n = R.ranked(df.repartition(11), [F.desc("score"), F.asc("id")], "t")
    got = [(r["id"], r["rank"]) for r in out.orderBy("rank").collect()]
    want = sorted(range(5000), key=lambda i: (-(i % 7), i))
    assert n == 5000 and got == [(i, k) for k, i in enumerate(want, 1)]
