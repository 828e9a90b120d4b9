import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierload.llm import substrings as S

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, q=13):
    least = {}
    for i, t in rows:
        w = WORD.findall(t or "")
        for k in range(len(w) - q + 1):
            g = tuple(w[k:k + q])
            if i is not None:
                least[g] = min(i, least.get(g, i))
    out = []
    for i, t in rows:
        w, gone = WORD.findall(t or ""), set()
        for k in range(len(w) - q + 1):
            if i is not None and least[tuple(w[k:k + q])] < i:
                gone.update(range(k, k + q))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def both(df, **kw):
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in S.digest(df, **kw).collect()), key=repr)
    return got, brute(rows)


@pytest.mark.parametrize("max_bits", [1 << 31, 1 << 21])
def test_table_matches_brute_force(spark, documents, max_bits):
    got, want = both(documents, max_bits=max_bits)
    assert got == want and sum(r[2] for r in want) > 0


def test_edges(spark, edge):
    got, want = both(edge)
    assert got == want
    assert S.digest(edge.limit(0)).count() == 0


def test_small_case_and_text(spark):
    a = "one two three four five six seven eight nine ten eleven twelve thirteen"
    df = spark.createDataFrame([(5, a + " tail"), (3, "head " + a), (9, a), (9, "x " + a), (2, a[:-9]), (7, a + " " + a)], "doc_id long, text string")
    got, want = both(df.repartition(4))
    assert got == want
    kept = {(r.doc_id, r.kept_text) for r in S.digest(df, with_text=True).collect()}
    assert (5, "tail") in kept and (9, "x") in kept and (7, "") in kept and (3, "head " + a) in kept


def test_pack_round_trip():
    r = np.random.default_rng(1)
    for n in (0, 1, 50, 5000):
        p = np.sort(r.integers(0, S.BLOCK, n))
        assert S.unpack(S.pack(p)).tolist() == p.tolist()


def test_sketch_loses_no_repeated_window(spark, documents):
    src = documents.select(F.col("doc_id").alias("id"), "text")
    shape = S.Shape(1000, 2, 1 << 31)
    rows = S.suspects(src, shape, S.sketch(src, shape, 13), 13).collect()
    seen = {}
    for r in documents.collect():
        w = WORD.findall(r.text)
        for k in range(len(w) - 12):
            seen.setdefault(tuple(w[k:k + 13]), set()).add(r.doc_id)
    assert len({r.window for r in rows}) >= sum(len(d) > 1 for d in seen.values()) > 0


def test_settled_ids_are_not_shuffled_by_window(spark):
    """3,000 equal texts: only one row per batch and window meets the others."""
    text = " ".join(f"w{i}" for i in range(20))
    docs = spark.range(3000).repartition(4).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"))
    src = docs.select(F.col("doc_id").alias("id"), "text")
    shape = S.Shape(3000 * 8, 2, 1 << 31)
    rows = S.save(S.suspects(src, shape, S.sketch(src, shape, 13), 13), "suspects")
    assert rows.count() <= 4 * 8 and rows.select(F.sum(F.size("rest"))).first()[0] >= 8 * 2996
    gone = S.removals(rows)
    assert gone.count() == 8 * 2999 and gone.distinct().count() == 8 * 2999 and gone.where("id = 0").count() == 0
    plan = gone._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("hashpartitioning(window"):]
    assert below.index("ReadSchema: struct<window:bigint,least:bigint>") < below.index("Generate")
