import random
import re

import pytest
from pyspark.sql import functions as F

from tierload.llm import mixture as M


def test_targets():
    assert M.shared_targets({"a": 10, "b": 100, "c": 50}, {"a": 3, "b": 1, "c": 2}, 240) == {"a": 20.0, "c": 100.0, "b": 120.0}
    assert M.shared_targets({}, {}, 0) == {}


def test_flow_prefers_unrepeated_words_and_fills_quotas():
    flow = M.route({("a",): 10, ("a", "b"): 10, ("b",): 5}, {"a": 15, "b": 20})
    given = {s: sum(f.get(s, 0) for f in flow.values()) for s in "ab"}
    assert given == {"a": 15, "b": 20}
    used = {p: sum(f.values()) for p, f in flow.items()}
    assert all(used[p] <= 2 * c for p, c in {("a",): 10, ("a", "b"): 10, ("b",): 5}.items())
    # cost: 25 words at 0, the other 10 at 1; nothing is repeated before everything is used
    assert all(used[p] >= c for p, c in {("a",): 10, ("a", "b"): 10, ("b",): 5}.items())
    # the overlap serves the source that lacks words
    assert M.route({("a",): 10, ("a", "b"): 10}, {"a": 10, "b": 10}) == {("a",): {"a": 10}, ("a", "b"): {"b": 10}}


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_mix_comes_near_its_targets_and_reruns_agree(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = M.mix_documents(docs).collect()
    again = M.mix_documents(docs.repartition(5)).collect()
    assert sorted(map(tuple, out)) == sorted(map(tuple, again))
    texts = {r.doc_id: r.text for r in docs.collect()}
    by = {}
    for r in out:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id])) and r.taken in (0, r["size"], 2 * r["size"])
        by.setdefault(r.source, []).append(r)
    total = sum(r["size"] for r in out)
    assert abs(sum(rs[0].target for rs in by.values()) - min(1.5 * total, 2 * total)) < 1e-6 * total
    for rs in by.values():
        assert sum(r["size"] for r in rs) == rs[0].source_size
        largest = max(r["size"] for r in rs)
        assert abs(sum(r.taken for r in rs) - rs[0].target) <= largest / 2 + 1


def test_overlapping_sources(spark):
    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.lit("a b c d e f g h i j").alias("text"))
    member = F.when(F.col("doc_id") % 3 == 0, F.array(F.lit("x"))).when(
        F.col("doc_id") % 3 == 1, F.array(F.lit("y"), F.lit("x"), F.lit("x"))).otherwise(F.array().cast("array<string>"))
    rows = M.sized(docs, "doc_id", "text", member, 1)
    got = {tuple(r["pattern"]): r["n"] for r in M.mix(rows, {"x": 2000, "y": 1500}).groupBy("pattern").agg(F.sum("taken").alias("n")).collect()}
    assert got[()] == 0 and got[("x",)] + got[("x", "y")] == 3500


def test_long_documents_do_not_keep_a_source_from_its_target(spark):
    r = random.Random(9)
    rows = [(1000 * s + i, 100_000 if i == 0 else r.randint(60, 400), f"s{s}") for s in range(8) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, n int, source string").select("doc_id", F.expr("repeat('w ', n)").alias("text"), "source")
    table = M.sized(docs, "doc_id", "text", F.array("source"), 17)
    total = {f"s{s}": sum(n for _, n, x in rows if x == f"s{s}") for s in range(8)}
    out = M.mix(table, {s: n // 2 for s, n in total.items()}).collect()
    for s, n in total.items():
        mine = [x for x in out if x["pattern"] == [s]]
        # nearer than half of any document that could still be added
        assert abs(sum(x.taken for x in mine) - n // 2) <= min(x["size"] for x in mine if not x.taken) / 2


def test_edges(spark, edge):
    got = sorted((tuple(r) for r in M.mix_documents(edge).select("doc_id", "source", "size", "taken").collect()), key=repr)
    assert len(got) == edge.count()
    assert all(t <= 2 * n for _, _, n, t in got)
    four = [r for r in got if r[0] == 4]
    assert four[0] == four[1]
    assert M.mix_documents(edge.limit(0)).count() == 0


def test_too_many_patterns_raise(spark, documents):
    rows = M.sized(documents, "doc_id", "text", F.array(F.col("doc_id").cast("string")), 1)
    with pytest.raises(ValueError):
        M.mix(rows, {}, max_patterns=10)
