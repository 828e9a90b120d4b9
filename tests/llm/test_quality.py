import re

from tierload.llm import quality as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(t):
    t = t or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    grams = {}
    for i in range(len(w) - 2):
        grams.setdefault(tuple(w[i:i + 3]), []).append(i)
    hit = {i + j for at in grams.values() if len(at) > 1 for i in at for j in range(3)}
    return {"n_chars": len(t), "n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", t)),
            "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(hit),
            "n_alpha_words": sum(any(c.isascii() and c.isalpha() or ord(c) >= 0x80 for c in x) for x in w),
            "n_upper": sum("A" <= c <= "Z" for c in t), "n_letters": sum(c.isascii() and c.isalpha() for c in t)}


def test_measures_match_brute_force(spark, documents, edge):
    more = spark.createDataFrame([(1, "a b c a b c\n\n x \n x \nx\r\n x "), (2, "q q q q"), (3, "a\x0bb c   d\n"), (4, "l\nl\nl")],
                                 "doc_id long, text string")
    for df in (documents, edge, more):
        got = sorted((tuple(r[m] for m in ("doc_id", *Q.MEASURES)) for r in Q.ledger(df).collect()), key=repr)
        want = sorted(((r.doc_id, *(brute(r.text)[m] for m in Q.MEASURES)) for r in df.select("doc_id", "text").collect()), key=repr)
        assert got == want


def test_bits_and_policies(spark, documents):
    rows = Q.ledger(documents).collect()
    for r in rows:
        bits = sum(1 << i for i, (_, f) in enumerate(Q.RULES) if f({m: r[m] for m in Q.MEASURES}))
        assert bits == r.fail_bits
    kept = {r.doc_id for r in Q.apply_policy(documents).collect()}
    assert kept == {r.doc_id for r in Q.ledger(documents).where(~Q.DEFAULT_POLICY.rejects(Q.F.col("fail_bits"))).collect()}
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    short = {r.doc_id for r in rows if r.n_words < 50}
    good = {r.doc_id for r in labels.where("quality = 1").collect()} - short
    assert len(good & kept) / len(good) > 0.98


def test_ablations(spark, documents):
    ledger = Q.ledger(documents)
    bits = [r.fail_bits for r in ledger.collect()]
    p = Q.DEFAULT_POLICY
    hard, soft = p.mask(p.hard), p.mask(p.soft)

    def rejected(b, drop=0):
        return bool(b & hard & ~drop) or (b & soft & ~drop).bit_count() > p.max_soft

    for r in Q.ablations(ledger).collect():
        bit = 1 << Q.BIT[r.rule]
        assert r.n_failed == sum(bool(b & bit) for b in bits)
        assert r.n_rejected_alone == sum(rejected(b) and not rejected(b, bit) for b in bits)
        assert r.n_kept_without == sum(not rejected(b, bit) for b in bits)
    assert Q.ablations(ledger.limit(0)).agg({"n_failed": "sum"}).first()[0] == 0


def test_edges(spark, edge):
    kept = Q.apply_policy(edge)
    assert kept.columns == edge.columns and {r.doc_id for r in kept.collect()} <= {5, 6, 8}
    assert Q.ledger(edge).count() == edge.count()
    assert Q.ledger(edge.limit(0)).count() == 0 and Q.apply_policy(edge.limit(0)).count() == 0
