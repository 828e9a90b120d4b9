import math

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tierload.llm import langid as L

PATH = public_tokenizers.path("piece_bpe_32k.model")


def held():
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


@pytest.fixture(scope="module")
def pieces():
    return L.vocabulary(PATH)


def segmentations(word, pieces):
    """Every way to cut a word, by plain recursion."""
    if not word:
        yield []
    for m in range(1, len(word) + 1):
        if word[:m] in pieces:
            for rest in segmentations(word[m:], pieces):
                yield [pieces[word[:m]], *rest]


def spans(words):
    data = np.frombuffer(b"".join(words), np.uint8)
    end = np.cumsum([len(w) for w in words])
    return data, end - [len(w) for w in words], end


WORDS = [w.encode() for w in ("the", "a", "straße", "é", "中文", "😀", "Wörter,", "x1", "international")] + [b"\xff\xfe"]


def test_forward_sums_all_segmentations(pieces):
    r = np.random.default_rng(2)
    p = r.dirichlet(np.ones(len(pieces)), 3)
    number = {x: i for i, x in enumerate(pieces)}
    got = L.log_probabilities(L.Pieces(pieces), p, *spans(WORDS))
    for w, row in zip(WORDS, got, strict=True):
        ways = list(segmentations(b" " + w, number))
        assert len(ways) > 1 or w == b"\xff\xfe"
        for j in range(3):
            assert row[j] == pytest.approx(math.log(sum(math.prod(p[j, i] for i in way) for way in ways)), rel=1e-9)


def test_expected_counts_match_enumeration(pieces):
    r = np.random.default_rng(4)
    p = r.dirichlet(np.ones(len(pieces)), 2)
    number = {x: i for i, x in enumerate(pieces)}
    lang, n = np.arange(len(WORDS)) % 2, np.arange(1, len(WORDS) + 1)
    into, want = np.zeros(p.shape), np.zeros(p.shape)
    L.expected_pieces(L.Pieces(pieces), p, pa.array(WORDS, pa.binary()), lang, n, into)
    for w, j, c in zip(WORDS, lang, n, strict=True):
        ways = list(segmentations(b" " + w, number))
        mass = [math.prod(p[j, i] for i in way) for way in ways]
        for way, x in zip(ways, mass, strict=True):
            for i in way:
                want[j, i] += c * x / sum(mass)
    assert np.allclose(into, want, rtol=1e-9, atol=1e-12)


def test_lattice_holds_every_piece(pieces):
    """Each piece inside each part is an edge, sorted by its end; sweeps are ranges of nodes."""
    number = {x: i for i, x in enumerate(pieces)}
    pool = L.Pieces(pieces)
    assert sum(len(known) - 1 for _, _, _, known, _ in pool.levels) == len({x[:m] for x in pieces for m in range(1, len(x) + 1)})
    words = [*WORDS, WORDS[0], ("é中" * 40).encode(), b"\x00\x00"]
    data, start, end = spans(words)
    word, first, a, z = L.word_parts(data, start, end)
    parts = [b" " * f + data[s:e].tobytes() for f, s, e in zip(first, a, z, strict=True)]
    lat = L.Lattice(pool, data, start, end)
    assert (np.diff(lat.dst) >= 0).all() and (np.diff(lat.size) <= 0).all() and lat.word.tolist() == word[lat.by].tolist()
    node = {(int(lat.column[t]) + j): (int(lat.by[j]), t) for t, n in enumerate(lat.width) for j in range(n)}
    got = sorted((*node[s], node[d][1], i) for s, d, i in zip(lat.src.tolist(), lat.dst.tolist(), lat.piece.tolist(), strict=True))
    assert all(node[s][0] == node[d][0] for s, d in zip(lat.src.tolist(), lat.dst.tolist(), strict=True))
    assert got == sorted((k, s, e, number[w[s:e]]) for k, w in enumerate(parts) for s in range(len(w)) for e in range(s + 1, len(w) + 1)
                         if w[s:e] in number)


def test_positions_are_followed_only_while_a_piece_begins():
    """Longer lengths of the vocabulary are not looked at once no position's bytes begin a piece."""
    pool = L.Pieces(sorted({bytes([i]) for i in range(256)} | {b"ab", b"zzzzzzzz"}))
    assert len(pool.levels) == 8
    pool.levels[3:] = [None] * 5  # reading one fails
    p = L.smoothed(np.ones((2, len(pool))))
    assert np.isfinite(L.log_probabilities(pool, p, *spans([b"abab" * 10, b"zzx", b"b"]))).all()


def test_chunks_do_not_matter(pieces, monkeypatch):
    r = np.random.default_rng(5)
    pool, p = L.Pieces(pieces), r.dirichlet(np.ones(len(pieces)), 2)
    words = [*WORDS, ("é中" * 100).encode(), *WORDS]
    lang, n = np.arange(len(words)) % 2, np.arange(1, len(words) + 1)

    def both():
        into = np.zeros(p.shape)
        L.expected_pieces(pool, p, pa.array(words, pa.binary()), lang, n, into)
        return L.log_probabilities(pool, p, *spans(words)), into

    (a, x) = both()
    monkeypatch.setattr(L, "NODES", 1)
    (b, y) = both()
    assert np.allclose(a, b, rtol=1e-12) and np.allclose(x, y, rtol=1e-9, atol=1e-12)


def test_long_words_are_scored_in_parts(pieces):
    """Whole, within the range of doubles, and never inside a character."""
    words = [("é中" * 4000).encode(), b"z" * 59 + "中".encode() + b"q" * 100, b"\x80" * 500, b"a"]
    data, start, end = spans(words)
    word, first, a, z = L.word_parts(data, start, end)
    assert b"".join(data[s:e].tobytes() for s, e in zip(a, z, strict=True)) == b"".join(words)
    assert (z - a + first).max() <= L.PART + 1 and first.tolist().count(1) == 4
    for s, e, w in zip(a, z, word, strict=True):
        if w < 2:
            data[s:e].tobytes().decode()
    p = L.smoothed(np.zeros((2, len(pieces))))
    p[1] = L.smoothed(np.eye(1, len(pieces)))[0]
    got = L.log_probabilities(L.Pieces(pieces), p, data, start, end)
    assert np.isfinite(got).all() and (got < 0).all()


def test_rounds_raise_the_likelihood(spark, documents, pieces):
    pool = L.Pieces(pieces)
    words = documents.where("lang is not null").select(F.col("lang").alias("label"), "text")
    words = L.save(L.training_words(words), "t")
    labels = sorted(r[0] for r in words.select("label").distinct().collect())
    rows = words.toArrow().to_batches()

    def likelihood(p):
        total = 0.0
        for b in rows:
            data, start, end = spans(b.column("word").to_pylist())
            lp = L.log_probabilities(pool, p, data, start, end)
            at = [labels.index(x) for x in b.column("label").to_pylist()]
            total += (lp[np.arange(len(at)), at] * b.column("n").to_numpy()).sum()
        return total

    scores = [likelihood(L.train(words, labels, pool, k)) for k in (0, 1, 2, 3)]
    assert scores == sorted(scores)


def test_held_out_accuracy(spark, documents):
    rows = L.identify(documents, held(), PATH).join(documents.select("doc_id", "lang", "text"), "doc_id").collect()
    judged = [r for r in rows if r.held_out and r.lang and len(r.text or "") > 20]
    assert len(rows) == documents.count() and len(judged) > 20
    assert sum(r.lang_pred == r.lang for r in judged) / len(judged) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_labels_of_judged_texts_and_partitions_do_not_matter(spark, documents):
    other = documents.withColumn("lang", F.when(held(), F.lit("zz")).otherwise(F.col("lang"))).withColumn("source", F.lit("s")).repartition(5)
    a = sorted(tuple(r) for r in L.identify(documents, held(), PATH, rounds=1).collect())
    b = sorted(tuple(r) for r in L.identify(other, held(), PATH, rounds=1).collect())
    assert a == b


def test_edges(spark, edge):
    rows = [tuple(r) for r in L.identify(edge, held(), PATH).collect()]
    assert len(rows) == edge.count()
    by_id = {r[0]: r for r in rows}
    assert {by_id[i][2:] for i in (2, 3, 7)} == {("und", 0.0)}
    assert by_id[8][2] in ("en", "xx") and by_id[None][1] is False
    assert L.identify(edge.limit(0), held(), PATH).count() == 0
    unlabelled = edge.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in L.identify(unlabelled, held(), PATH).collect()} == {"und"}


def test_letters_decide_und(spark):
    df = spark.createDataFrame([(1, "12 34 -- !", "en"), (2, "ein Wort", "de"), (4, "a word", "en"), (5, "中", "zh"), (6, "٣", "en")],
                               "doc_id long, text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in L.identify(df, F.lit(False), PATH).collect()}
    assert got[1] == ("und", 0.0) and got[6] == ("und", 0.0) and got[2][0] == "de" and got[5][0] == "zh"
