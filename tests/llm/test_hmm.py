import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tierload.llm import hmm as H

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(t):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return [*WORD.findall(t), None]


def held():
    return F.crc32(F.col("doc_id").cast("string")) % 7 == 2


def brute_base(rows):
    out, counts = {}, {}
    test = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    for i, t in rows:
        if not test[i]:
            for x in tokens(t):
                counts[x] = counts.get(x, 0) + 1
    n, v = sum(counts.values()), len(counts)
    for i, t in rows:
        w = tokens(t)
        out.setdefault(i, []).append((test[i], len(w), sum(x in counts for x in w), n,
                                      sum(math.log10((counts.get(x, 0) + 1) / (n + v + 1)) for x in w)))
    return out


@pytest.mark.parametrize("known", [H.KNOWN, 50])
def test_base_columns_and_gain(spark, documents, known):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    want = brute_base(rows)
    got = H.score_texts(documents, held(), known=known, own=min(H.OWN, known)).collect()
    assert len(got) == len(rows)
    for r in got:
        h, n, k, t, b = want[r.doc_id][0]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (h, n, k, t)
        assert abs(r.base_score - b) < 1e-6 * abs(b)
    test = [r for r in got if r.held_out]
    assert test
    if known == H.KNOWN:
        assert sum(r.score for r in test) > sum(r.base_score for r in test)


def test_forward_matches_enumeration_and_em_rises():
    r = np.random.default_rng(0)
    k, size = 3, 7
    m = H.Model(r.dirichlet(np.ones(k)), r.dirichlet(np.ones(k), k), r.dirichlet(np.ones(size), k).T)
    texts = [r.integers(0, size, n).astype(np.uint16) for n in (6, 4, 4, 1)]
    flat, base = np.concatenate(texts), np.cumsum([0, 6, 4, 4])
    lengths = np.array([6, 4, 4, 1])
    score, _, _ = H.forward(m, lengths, flat, base)
    for s, x in zip(score, texts, strict=True):
        a = m.start * m.emit[x[0]]
        for o in x[1:]:
            a = (a @ m.move) * m.emit[o]
        assert abs(s - math.log10(a.sum())) < 1e-9
    # expected counts: emissions add up to tokens, moves to transitions, starts to texts
    into = np.zeros((size + k + 1, k))
    H.expected(m, lengths, flat, base, into)
    assert abs(into[:size].sum() - 15) < 1e-9 and abs(into[size:size + k].sum() - 11) < 1e-9 and abs(into[-1].sum() - 4) < 1e-9
    last = score.sum()
    for _ in range(5):
        into = np.zeros((size + k + 1, k))
        H.expected(m, lengths, flat, base, into)
        m = H.Model(into[-1] / into[-1].sum(), into[size:size + k] / into[size:size + k].sum(1, keepdims=True), into[:size] / into[:size].sum(0))
        now = H.forward(m, lengths, flat, base)[0].sum()
        assert now >= last - 1e-9
        last = now


def test_shared_symbols_are_distributions(spark):
    """The known words of a class and its unknown one share its mass; own symbols carry one word."""
    rows = [(i, f"the cat w{i} sat w{i % 9}") for i in range(60)]
    src = spark.createDataFrame(rows, "id long, text string").withColumn("held_out", F.lit(False))
    counts = H.token_counts(src)
    a = H.alphabet(counts, 4, 3, 1000)
    c = {r.word: r.c for r in counts.collect()}
    mass = {}
    own = set(a.words[a.symbols >= 0].tolist())
    for w, n in c.items():
        u = np.array([w]).view(np.uint64)
        if int(u[0]) not in own and w != int(H.END.view(np.int64)):
            g = int(a.class_of(u)[0])
            mass[g] = mass.get(g, 0) + (n + 1) / 10 ** a.room[g]
    for g, m in mass.items():
        assert abs(m + 1 / 10 ** a.room[g] - 1) < 1e-9
    assert abs(a.unigram.sum() - 1) < 1e-9 and a.ends == 60 and a.n == sum(c.values())


def test_edges(spark, edge):
    got = H.score_texts(edge, held(), states=2, rounds=2)
    rows = [tuple(r) for r in edge.select("doc_id", "text").collect()]
    want = brute_base(rows)
    out = got.collect()
    assert len(out) == len(rows) and all(math.isfinite(r.score) for r in out)
    for r in out:
        assert any(r.n_tokens == w[1] and r.n_known == w[2] and abs(r.base_score - w[4]) < 1e-6 * abs(w[4]) for w in want[r.doc_id])
    assert H.score_texts(edge.limit(0), held()).count() == 0
    nothing = H.score_texts(edge, F.lit(True), states=2, rounds=1).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in nothing)


def test_sequence_blocks_cover_all_rows():
    seqs = [b"\x01\x00" * n for n in (5, 1, 3, 2)]
    batch = pa.RecordBatch.from_arrays([pa.array(seqs, pa.binary())], ["symbols"]).slice(1)
    rows = [(r.tolist(), s.tolist()) for r, s, _, _ in H.sequence_blocks(batch, 4)]
    assert sorted(x for r, _ in rows for x in r) == [0, 1, 2]


@pytest.mark.parametrize("known", [0, 1, 7, 40, 299, 300, 1000])
def test_the_frequent_words_are_cut_by_histograms(spark, known):
    r = np.random.default_rng(known)
    c = np.concatenate([r.integers(1, 5, 200), r.integers(1, 4000, 60), r.integers(1, 1 << 40, 38), [2048, 2047]])
    word = r.integers(-(1 << 63), 1 << 63, len(c))
    df = spark.createDataFrame([(int(a), int(b)) for a, b in zip(word, c, strict=True)], "word long, c long")
    got = {(x.word, x.c) for x in H.frequent(df, known).collect()}

    def level(n):
        return n >> max(n.bit_length() - 11, 0) << max(n.bit_length() - 11, 0)
    want = sorted(((int(a), int(b)) for a, b in zip(word, c, strict=True)), key=lambda x: (-level(x[1]), x[0]))[:known]
    assert got == set(want)
    assert H.frequent(df.limit(0), known).count() == 0


def test_ties_of_the_cut_stay_within_the_bound(spark):
    df = spark.range(5000).select(F.xxhash64("id").alias("word"), F.lit(1).cast("long").alias("c"))
    n = H.frequent(df, 1000).count()
    assert 990 <= n <= 1000


def test_a_word_of_held_out_texts_alone_is_looked_up_once_a_text(spark):
    a = H.alphabet(spark.createDataFrame([(int(H.END.view(np.int64)), 2), (5, 3)], "word long, c long"), 4, 3, 10)
    src = spark.createDataFrame([(1, True, "new new other NEW"), (2, True, ""), (3, True, None)], "id long, held_out boolean, text string")
    got = {r.id: sorted(x.times for x in r.rest) for r in H.encode(src, a).collect()}
    assert got == {1: [1, 3], 2: [], 3: []}
