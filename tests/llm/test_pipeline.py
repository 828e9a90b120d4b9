import corpus_pipeline as C
from tierload.llm import decontam, neardup, pii, quality


def test_each_stage_does_its_part(spark, documents):
    docs, sf = documents, "/root/testdata/sf0.001"
    seen = [{r.doc_id for r in docs.collect()}]
    for name, stage in C.STAGES:
        out = C.save(stage(spark, docs, sf), name)
        if name != "mixing":
            assert out.columns == documents.columns
        seen.append({r.doc_id for r in out.collect()})
        assert seen[-1] <= seen[-2] and seen[-1]
        if name == "quality_rules":
            kept = quality.ledger(docs).where(~quality.DEFAULT_POLICY.rejects(quality.F.col("fail_bits")))
            assert seen[-1] == {r.doc_id for r in kept.collect()}
        if name == "near_dedup":
            assert all(r.kept for r in neardup.near_duplicates(out).collect())
        if name == "decontamination":
            assert not decontam.hits(out, spark.read.parquet(f"{sf}/benchmark.parquet")).where("n_hit > 0").count()
        if name == "personal_data":
            assert not pii.extract(out).where("size(base) > 0").count() and seen[-1] == seen[-2]
        docs = out
    assert docs.where("taken <= 0 OR copies NOT IN (1, 2)").count() == 0


def _run(spark, stage, rows, schema="doc_id long, text string, lang string, source string, n_chars long, copies string"):
    df = spark.createDataFrame([(*r, "en", "s", 1, "x") for r in rows], schema).repartition(3)
    return df, dict(C.STAGES)[stage](spark, df, "/root/testdata/sf0.001")


TEXT = " ".join(f"alpha{i}" for i in range(80))
NEAR = TEXT + " omega"
OTHER = " ".join(f"beta{i}" for i in range(80))


def test_near_dedup_judges_rows_not_ids(spark):
    """An id that repeats with another text keeps that text; of equal rows of one id, one stays."""
    rows = [(1, TEXT), (2, NEAR), (2, OTHER), (4, OTHER + " x"), (4, OTHER + " x"), (5, "a few words"), (5, "a few words"), (6, None), (6, "")]
    _, out = _run(spark, "near_dedup", rows)
    got = sorted((r.doc_id, r.text or "") for r in out.collect())
    assert got == [(1, TEXT), (2, OTHER), (5, "a few words"), (6, ""), (6, "")]


def test_near_dedup_null_ids_come_last(spark):
    _, out = _run(spark, "near_dedup", [(None, TEXT), (7, TEXT), (None, OTHER), (None, OTHER), (None, None)])
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)
    assert got == sorted([(7, TEXT), (None, OTHER), (None, None)], key=repr)


def test_mixing_returns_every_row_it_takes(spark):
    rows = [(None, TEXT), (None, OTHER), (2, "a b c d e"), (2, TEXT), (3, None), (4, "")] + [(i, f"{OTHER} {i}") for i in range(10, 40)]
    df, out = _run(spark, "mixing", rows)
    got = [(r.doc_id, r.text, r.copies, r.taken) for r in out.collect()]
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "copies", "taken"]
    assert all(t == c * len(x.split()) and c in (1, 2) for _, x, c, t in got)
    # the target is 1.5 times the words of the one source: every row with words is taken once at least
    assert sorted(((i, x) for i, x, _, _ in got), key=repr) == sorted(((i, x) for i, x in rows if x), key=repr)
    total = sum(len((x or "").split()) for _, x in rows)
    assert abs(sum(t for *_, t in got) - 1.5 * total) <= 81


def test_every_stage_takes_edge_cases(spark, edge):
    """Nulls, repeated ids, very long texts, clashing columns, and an empty table."""
    sf = "/root/testdata/sf0.001"
    docs = edge.withColumn("n_chars", C.F.length("text").cast("long"))
    before = sorted((r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None)
    for name, stage in C.STAGES:
        out = C.save(stage(spark, docs, sf), name)
        assert C.save(stage(spark, docs.limit(0), sf), name).count() == 0
        if name != "mixing":
            assert out.columns == docs.columns
        assert out.count() <= docs.count() and {(r.doc_id) for r in out.collect()} <= {i for i, _ in before} | {None}
        if name in ("decontamination", "personal_data"):
            assert out.count() == docs.count()
        if name == "mixing":
            assert out.where("copies IS NULL OR taken IS NULL").count() == 0 and out.count() > 0
