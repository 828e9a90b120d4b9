import random
import re

from pyspark.sql import functions as F

from tierload.llm import pii as P

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def ok(kind, m):
    d = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(x) <= 255 for x in m.split("."))
    if kind == "phone":
        return 9 <= len(d) <= 15
    if kind == "card":
        s = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d)))
        return 12 <= len(d) <= 19 and s % 10 == 0
    return True


def brute(t):
    return sorted((m.start(), k, m.end()) for k, kind in enumerate(BASE) for m in re.finditer(BASE[kind], t or "") if ok(kind, m[0]))


def compare(df):
    got = sorted((r.doc_id, [tuple(s) for s in r.base]) for r in P.extract(df.where("doc_id IS NOT NULL")).select("doc_id", "base").collect())
    want = sorted((r.doc_id, brute(r.text)) for r in df.where("doc_id IS NOT NULL").select("doc_id", "text").collect())
    assert got == want
    return want


def test_base_spans_on_the_table(spark, documents):
    assert sum(len(s) for _, s in compare(documents)) > 10


def test_base_spans_on_random_texts(spark):
    r = random.Random(4)
    parts = [*"a1.@+- ()_%", "é😀", "4111 1111 1111 1111", "10.0.0.255", "1.2.3.4.5.6.7.8", "x@y.zz", "+1 (555) 123-4567", "256", "@b.c", "0000"]
    rows = [(i, "".join(r.choice(parts) for _ in range(r.randint(0, 14)))) for i in range(3000)]
    rows += [(9000, "1" * 50_000), (9001, "a" * 50_000), (9002, "1-" * 20_000 + "1"), (9003, "a@b" + ".c" * 20_000), (9004, "+1" + "-" * 20_000)]
    compare(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))


def test_context_finds_unseen_identifiers(spark):
    rows = [(i, f"please write my contact mail: user{i}@example.org thanks") for i in range(6)]
    rows += [(20, "please write my contact mail: user20-at-example thanks"), (21, "unrelated words here user99-nothing-5 thanks"),
             (22, "later we saw user20-at-example, again"), (23, None), (24, "")]
    rows += [(30 + i, f"see section number {i}00{i}000 there") for i in range(6)]
    out = P.extract(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    got = {r.doc_id: [rows_text(rows, r.doc_id)[s[0]:s[2]] for s in r.spans if s[1] == P.CONTEXT] for r in out.collect()}
    assert got[20] == ["user20-at-example"] and got[22] == ["user20-at-example"]
    assert all(not v for k, v in got.items() if k not in (20, 22))
    text = {r.doc_id: r.t for r in out.select("doc_id", P.spans_text(F.col("spans")).alias("t")).collect()}
    assert text[0] == "email:30:47" and text[23] == "" and text[20] == "context:30:47"


def rows_text(rows, i):
    return dict(rows)[i]


def test_redact(spark, edge):
    df = spark.createDataFrame([(1, "mail a.b@c.de and +1 (743) 555-3824 é 10.0.0.1"), (2, None), (2, "none"), (3, "4111 1111 1111 1111"),
                                (3, "4111 1111 1111 1111"), (4, "")], "doc_id long, text string").withColumn("spans", F.lit(1))
    got = sorted(((r.doc_id, r.text) for r in P.redact(df).collect()), key=repr)
    assert got == sorted([(1, "mail [EMAIL] and [PHONE] é [IP]"), (2, None), (2, "none"), (3, "[CARD]"), (3, "[CARD]"), (4, "")], key=repr)
    same = P.redact(edge)
    assert same.columns == edge.columns and same.count() == edge.count()
    assert P.redact(edge.limit(0)).count() == 0 and P.extract(edge.limit(0)).count() == 0


def test_context_of_quoted_tokens(spark):
    long = "w" * 300
    rows = [(i, f'some text token = "{i:040x}"### more') for i in range(5)]
    rows += [(10, f'token = "{10:040x}" more'), (11, 'so TOKEN = "not-a-hex-11", more'), (12, 'we set "not-a-hex-11" twice')]
    rows += [(20 + i, f"Contact: <user{i}@example.org> thanks") for i in range(4)] + [(30, "Contact: <user30-at-example> thanks")]
    rows += [(40 + i, f"{long} {long} {' ' * 90}user{i}@example.com") for i in range(4)] + [(50, f"{long} {long} user50-at-example")]
    rows += [(51, f"x{long} {long} user51-at-example"), (52, f"mail:{10:04}-at-example")]
    out = P.extract(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    got = {r.doc_id: [rows_text(rows, r.doc_id)[s[0]:s[2]] for s in r.spans if s[1] == P.CONTEXT] for r in out}
    want = {i: [f"{i:040x}"] for i in (*range(5), 10)} | {11: ["not-a-hex-11"], 12: ["not-a-hex-11"], 30: ["user30-at-example"],
                                                          50: ["user50-at-example"]}
    assert {k: v for k, v in got.items() if v} == want


def test_context_finds_all_planted_tokens(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    spans = {r.doc_id: {(s[0], s[2]) for s in r.spans if s[1] == P.CONTEXT} for r in P.extract(docs).collect()}
    planted = [(r.doc_id, m.span(1)) for r in docs.collect() for m in re.finditer(r'token = "([0-9a-f]{40})"', r.text or "", re.I)]
    assert len(planted) > 10 and all(span in spans[i] for i, span in planted)
