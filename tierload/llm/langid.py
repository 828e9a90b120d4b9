"""Language identification by unigram piece models, summed over all segmentations.

The pieces are those of a fixed public vocabulary (never trained here),
taken as byte strings; every single byte is a piece too, so every text can
be segmented.  A word (with the space before it) is produced by drawing
pieces until it is complete; its probability in a language is the sum over
*all* ways to cut it into pieces, by the forward recursion.  A text's
probability is the product over its words.

1. *Word table*: training words are counted per language (combined per
   task, shuffled by word, written once).
2. *Expectation maximisation*: each round, tasks run forward and backward
   over their rows of the word table and return expected piece counts,
   summed per language and piece as fixed-point integers, so results do
   not depend on task order.  The driver holds the model only: one
   number per language and piece.
3. *Prediction*: a block's distinct words are scored once for all
   languages; a text's languages compete by posterior probability, with
   the languages' shares of the training texts as prior.

All words of a block advance one byte at a time.  The pieces that begin at
a position are found by walking on as long as its bytes begin a piece, so
the work follows the beginnings found, not the lengths of the vocabulary.  A share ``FLOOR`` of the
probability is spread evenly over the vocabulary, at every corpus size;
with it and the factor ``TILT`` per byte (taken out again), a word of
``PART`` bytes stays within the range of doubles.  Longer words are
scored in parts of at most ``PART`` bytes that end between characters.

Defined cases: a null text, or one without a letter, is ``und`` with score
0, as is any text when nothing could be learned; a language seen only in
texts without words is learned from its prior; a null id is not held out; rows
that repeat an id are judged each, and their label counts each time; an
empty table gives an empty result; equal probabilities go to the language
that comes first by code point; only id, text and label are read, so other
columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierload.llm.common import arrow_map, save
from tierload.llm.text import Words, blocks, take_spans

ROUNDS, FLOOR, PART = 3, 1e-3, 60
TILT = 10.0 ** 3.5
FIXED = 1 << 10
BLOCK_BYTES = 4 << 20
NODES = 1 << 18  # nodes x languages of one pass
UNKNOWN = "und"

_P = np.uint64(0x9E3779B97F4A7C15)
_END = 256  # after a part; no byte


def vocabulary(path: str) -> list[bytes]:
    """Distinct pieces of a sentencepiece vocabulary as bytes (a space begins a word), and all single bytes."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {bytes([i]) for i in range(256)}
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)):
            pieces.add(model.id_to_piece(i).replace("▁", " ").encode())
    return sorted(p for p in pieces if p)


class Pieces:
    """Pieces and all beginnings of pieces by length and hash, with the piece's number or -1; the top of a hash tells where to look."""

    def __init__(self, pieces: list[bytes]) -> None:
        self.sizes = np.array([len(p) for p in pieces])
        self.longest = int(self.sizes.max())
        raw = np.zeros((len(pieces), self.longest), np.uint8)
        raw[np.arange(self.longest) < self.sizes[:, None]] = np.frombuffer(b"".join(pieces), np.uint8)
        h = np.zeros(len(pieces), np.uint64)
        self.levels: list[tuple] = []
        for m, power in enumerate(np.cumprod(np.full(self.longest, _P), dtype=np.uint64), 1):
            live = np.flatnonzero(self.sizes >= m)
            h[live] += raw[live, m - 1] * power
            known, at = np.unique(h[live], return_inverse=True)
            ids = np.full(len(known) + 1, -1)
            whole = self.sizes[live] == m
            ids[at[whole]] = live[whole]
            bits = len(known).bit_length() + 2
            top = np.searchsorted(known, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
            self.levels.append((power, np.uint64(64 - bits), top.astype(np.int32), np.append(known, ~np.uint64(0)), ids))

    def __len__(self) -> int:
        return len(self.sizes)


class Lattice:
    """All pieces inside each of a number of words: edges between byte positions.

    A node is a position in a part of a word.  The parts are sorted by
    size, longest first (``by``: their former places; ``word``: the word of
    each), and nodes are numbered position by position, so that a step of a
    sweep is one range of nodes and of edges.  Each node but a part's first
    has an edge into it, each but its last (``stop``) one out of it, as all
    single bytes are pieces.  Edges are sorted by their end and length.
    """

    def __init__(self, pieces: Pieces, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        word, first, a, z = word_parts(data, start, end)
        self.by = np.argsort(a - z - first, kind="stable")
        self.word, first, a, z = (x[self.by] for x in (word, first, a, z))
        self.size = z - a + first
        self.width = np.cumsum(np.bincount(self.size, minlength=1)[::-1])[::-1]  # parts that have each position
        self.column = np.concatenate([[0], np.cumsum(self.width)])
        self.nodes = int(self.column[-1])
        self.stop = self.column[self.size] + np.arange(len(self.size))
        # bytes part by part, an _END behind each
        part = np.repeat(np.arange(len(self.size)), self.size + 1)
        off = np.cumsum(self.size + 1) - self.size - 1
        place = np.arange(self.nodes) - off[part]
        number = self.column[place] + part
        flat = np.full(self.nodes + pieces.longest, _END, np.uint16)
        flat[off[first > 0]] = 0x20
        inner = np.flatnonzero((place >= first[part]) & (place < self.size[part]))
        flat[inner] = data[(a - first)[part[inner]] + place[inner]]
        # from each position, as long as its bytes begin a piece
        s = np.flatnonzero(flat[:self.nodes] != _END)
        h = np.zeros(len(s), np.uint64)
        src, dst, ids = [], [], []
        for m, (power, shift, top, known, of) in enumerate(pieces.levels):
            h = h + flat[s + m] * power
            at = top[(h >> shift).view(np.int64)].astype(np.int64)
            late = np.flatnonzero(known[at] < h)
            while len(late):
                at[late] += 1
                late = late[known[at[late]] < h[late]]
            on = np.flatnonzero(known[at] == h)
            s, h = s[on], h[on]
            if not len(s):
                break
            piece = of[at[on]]
            whole = np.flatnonzero(piece >= 0)
            src.append(number[s[whole]])
            dst.append(number[s[whole] + m + 1])
            ids.append(piece[whole])
        self.first, self._at = _dealt(self.nodes, dst)
        self._src, self._dst = src, dst
        self.src, self.piece = (_put(self._at, x) for x in (src, ids))

    @property
    def dst(self) -> np.ndarray:
        return np.repeat(np.arange(self.nodes), np.diff(self.first))

    def forward(self, q: np.ndarray) -> np.ndarray:
        """Sum over all ways to reach each node; ``q``: (edges, ...) probabilities."""
        out = np.ones((self.nodes, *q.shape[1:]))
        for a, z in zip(self.column[1:-1], self.column[2:], strict=True):
            first = self.first[a:z + 1]
            e = slice(first[0], first[-1])
            out[a:z] = np.add.reduceat(out[self.src[e]] * q[e], first[:-1] - first[0], axis=0)
        return out

    def backward(self, q: np.ndarray) -> np.ndarray:
        """Sum over all ways from each node to the end of its part."""
        start, at = _dealt(self.nodes, self._src)
        dst, edge = _put(at, self._dst), _put(at, self._at)
        out = np.ones((self.nodes, *q.shape[1:]))
        for a, n in zip(self.column[-3::-1], self.width[:0:-1], strict=True):
            first = start[a:a + n + 1]
            e = slice(first[0], first[-1])
            out[a:a + n] = np.add.reduceat(out[dst[e]] * q[edge[e]], first[:-1] - first[0], axis=0)
        return out


def _dealt(nodes: int, groups: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """(first place of each node, place of each entry) with entries sorted by node, then group; no group repeats a node."""
    count = np.bincount(np.concatenate(groups), minlength=nodes) if groups else np.zeros(nodes, np.int64)
    first = np.concatenate([[0], np.cumsum(count)])
    free, at = first[:-1].copy(), []
    for g in groups:
        at.append(free[g])
        free[g] += 1
    return first, at


def _put(at: list[np.ndarray], values: list[np.ndarray]) -> np.ndarray:
    out = np.empty(sum(map(len, at)), np.int64)
    for i, v in zip(at, values, strict=True):
        out[i] = v
    return out


def word_parts(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """(word, 1 where it begins the word, first byte, end) of parts of at most ``PART`` bytes."""
    count = np.maximum(1, -(-(end - start) // (PART - 3)))
    word = np.repeat(np.arange(len(start)), count)
    k = np.arange(len(word)) - np.repeat(np.cumsum(count) - count, count)
    a = start[word] + k * (PART - 3)
    for _ in range(3):  # back to the start of a character
        a -= (k > 0) & ((data[np.minimum(a, max(len(data) - 1, 0))] & 0xC0) == 0x80) if len(data) else 0
    z = np.where(np.append(word[1:] == word[:-1], False), np.append(a[1:], 0), end[word])
    return word, (k == 0).astype(np.int64), a, z


def training_words(docs: DataFrame) -> DataFrame:
    """(label, word, n): words of (label, text), counted per language."""

    def fn(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for b in blocks(batch, "text", BLOCK_BYTES):
            label = b.column("label").dictionary_encode()
            of = label.indices.to_numpy()
            w = Words(b.column("text"))
            order = np.lexsort((w.hash, of[w.row]))
            h, lang = w.hash[order], of[w.row][order]
            new = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (lang[1:] != lang[:-1]))) if len(h) else order
            first = order[new]
            yield pa.RecordBatch.from_arrays(
                [label.dictionary.take(pa.array(of[w.row[first]])), take_spans(w.data, w.start[first], w.end[first], pa.binary()),
                 pa.array(np.diff(np.append(new, len(h))))], ["label", "word", "n"])

    return arrow_map(docs, fn, "label string, word binary, n long").groupBy("label", "word").agg(F.sum("n").alias("n"))


def _chunks(size: np.ndarray, width: int) -> Iterator[slice]:
    """Slices of words whose nodes, times ``width``, stay near ``NODES``."""
    total, a = np.cumsum(size + 2), 0
    while a < len(size):
        z = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + NODES // width, side="right")))
        yield slice(a, z)
        a = z


def expected_pieces(pieces: Pieces, p: np.ndarray, words: pa.Array, lang: np.ndarray, n: np.ndarray, into: np.ndarray) -> None:
    """Add the expected piece counts of the words to ``into`` (languages, pieces)."""
    off = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2], np.uint8)
    tilted = p * TILT ** pieces.sizes
    for s in _chunks(np.diff(off), 4):
        lat = Lattice(pieces, data, off[:-1][s], off[1:][s])
        dst = lat.dst
        part = (np.arange(lat.nodes) - np.repeat(lat.column[:-1], lat.width))[dst]
        of = lat.word[part]
        row = lang[s][of]
        q = tilted[row, lat.piece]
        alpha, beta = lat.forward(q), lat.backward(q)
        share = alpha[lat.src] * q * beta[dst] / alpha[lat.stop][part] * n[s][of]
        into += np.bincount(row * into.shape[1] + lat.piece, weights=share, minlength=into.size).reshape(into.shape)


def log_probabilities(pieces: Pieces, p: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """ln probability of every word in every language: (words, languages)."""
    out = np.zeros((len(start), len(p)))
    tilted = np.ascontiguousarray((p * TILT ** pieces.sizes).T)
    for s in _chunks(end - start, len(p)):
        lat = Lattice(pieces, data, start[s], end[s])
        total = np.log(lat.forward(tilted[lat.piece])[lat.stop]) - (lat.size * np.log(TILT))[:, None]
        total[lat.by] = total.copy()
        word = np.empty_like(lat.word)
        word[lat.by] = lat.word
        out[s] = np.add.reduceat(total, np.flatnonzero(np.append(True, word[1:] != word[:-1])), axis=0)
    return out


def smoothed(counts: np.ndarray) -> np.ndarray:
    """Piece probabilities; ``FLOOR`` of them is even."""
    total = counts.sum(axis=1, keepdims=True)
    even = 1.0 / counts.shape[1]
    return np.where(total > 0, (1 - FLOOR) * counts / np.maximum(total, 1e-300) + FLOOR * even, even)


def train(words: DataFrame, labels: list[str], pieces: Pieces, rounds: int) -> np.ndarray:
    """(languages, pieces) probabilities from counted words."""
    number = {x: i for i, x in enumerate(labels)}
    p = smoothed(np.zeros((len(labels), len(pieces))))
    for _ in range(rounds if labels else 0):
        shared = words.sparkSession.sparkContext.broadcast((p, pieces))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            p, pieces = shared.value
            into = np.zeros(p.shape)
            for b in batches:
                if b.num_rows:
                    label = b.column("label").dictionary_encode()
                    lang = np.array([number[x] for x in label.dictionary.to_pylist()])[label.indices.to_numpy()]
                    expected_pieces(pieces, p, b.column("word"), lang, b.column("n").to_numpy(), into)
            whole = np.rint(into * FIXED).astype(np.int64)
            lang, piece = np.nonzero(whole)
            yield pa.RecordBatch.from_arrays([pa.array(lang.astype(np.int32)), pa.array(piece.astype(np.int32)), pa.array(whole[lang, piece])],
                                             ["lang", "piece", "c"])

        got = words.mapInArrow(run, "lang int, piece int, c long").groupBy("lang", "piece").agg(F.sum("c").alias("c")).toArrow()
        counts = np.zeros(p.shape)
        counts[got.column("lang").to_numpy(), got.column("piece").to_numpy()] = got.column("c").to_numpy() / FIXED
        p = smoothed(counts)
        shared.unpersist()
    return p


def predict(src: DataFrame, labels: list[str], prior: np.ndarray, p: np.ndarray, pieces: Pieces) -> DataFrame:
    """``src`` (id, held_out, lettered, text) with lang_pred and score, without the text."""
    kind = src.schema["id"].dataType.simpleString()
    shared = src.sparkSession.sparkContext.broadcast((p, pieces))

    def fn(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        p, pieces = shared.value
        for b in blocks(batch, "text", BLOCK_BYTES):
            n = b.num_rows
            lettered = b.column("lettered").to_numpy(zero_copy_only=False)
            pred, score = [UNKNOWN] * n, np.zeros(n)
            if len(labels) and lettered.any():
                w = Words(b.column("text"))
                _, first, inverse = np.unique(w.hash, return_index=True, return_inverse=True)
                of_word = log_probabilities(pieces, p, w.data, w.start[first], w.end[first])
                total = np.stack([np.bincount(w.row, weights=of_word[inverse, j], minlength=n) for j in range(len(labels))], axis=1) + prior
                best = total.argmax(axis=1)
                share = 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
                pred = [labels[j] if x else UNKNOWN for j, x in zip(best.tolist(), lettered.tolist(), strict=True)]
                score = np.where(lettered, share, 0.0)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("held_out"), pa.array(pred, pa.string()), pa.array(score)],
                                             ["id", "held_out", "lang_pred", "score"])

    return arrow_map(src, fn, f"id {kind}, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, held_out: Column, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
             rounds: int = ROUNDS) -> DataFrame:
    """(id, held_out, lang_pred, score) of every text, learning from the labelled ones that are not held out.

    The model takes 8 bytes per language and piece in the driver and each
    worker (0.25 MB a language with 32,000 pieces).
    """
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held_out"),
                      F.col(label_col).cast("string").alias("label"), F.col(text_col).cast("string").alias("text"))
    known = src.where(~F.col("held_out") & F.col("label").isNotNull())
    texts = sorted((r["label"], r["n"]) for r in known.groupBy("label").agg(F.count("*").alias("n")).collect())
    labels = [x for x, _ in texts]
    prior = np.log(np.array([n for _, n in texts], float)) - np.log(sum(n for _, n in texts)) if texts else np.zeros(0)
    pieces = Pieces(vocabulary(vocabulary_path))
    words = save(training_words(known.select("label", "text")), "words")
    p = train(words, labels, pieces, rounds)
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    out = predict(src.select("id", "held_out", lettered.alias("lettered"), "text"), labels, prior, p, pieces)
    return out.withColumnRenamed("id", id_col)
