"""Hidden Markov language model, trained by Baum-Welch over partitions.

Observations are symbols of a fixed alphabet: each of the ``own`` most
frequent training words has its own symbol, every other word shares one
of ``classes`` symbols by its hash, and the end of a text is a symbol.  A
word of a shared symbol is then drawn from that symbol's words by their
counts (add-one, with room for one unknown word), so the model spans the
whole vocabulary while its parameters stay at ``(own + classes) x states``
whatever the corpus.

1. *Counts*: word counts of all training texts (combined per task, then
   shuffled by word) give the alphabet, the class sizes and the base
   unigram score.  The most frequent words are cut off by histograms of
   the counts, not sorted in one task.
2. *Encoding*: texts become symbol sequences in one written table; all
   later passes read that.  Words beyond the ``known`` most frequent ones
   meet their counts in a join, so no unbounded table is broadcast.
3. *Baum-Welch*: each round, every task runs the scaled forward-backward
   recursion over its texts (all texts of a block advance one word at a
   time) and returns expected counts; they are summed per symbol as
   fixed-point integers, so the result does not depend on task order.
   The model (a few MB) goes back to the tasks as a broadcast.
4. *Scoring*: the scaled forward recursion gives the exact log10
   probability of every whole text, end included.

Defined cases: a null or empty text is the end token alone; repeated rows
and ids are scored each; a null id is not held out; an empty table gives
an empty result, and a table without training rows scores with uniform
counts; only id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierload.llm.common import arrow_map, save
from tierload.llm.text import Words, blocks, mix

OWN, CLASSES, KNOWN = 1 << 14, 1 << 12, 1 << 19
STATES, ROUNDS, PRIOR = 8, 5, 50.0
FIXED = float(1 << 20)
END = np.uint64(0x7E57E4D0F7E57E4D)  # hash of the end token
BLOCK_TOKENS = 1 << 20


def token_counts(src: DataFrame) -> DataFrame:
    """(word, c): counts of the word hashes of all texts, ends included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for b in blocks(batch, "text"):
                w = Words(b.column("text"), lower=True)
                held.append(np.unique(np.append(w.hash, np.full(b.num_rows, END)), return_counts=True))
                size += len(held[-1][0])
                if size > 2_000_000:
                    yield combined(held)
                    held, size = [], 0
        if held:
            yield combined(held)

    def combined(held: list) -> pa.RecordBatch:
        h, c = np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held])
        order = np.argsort(h)
        h, c = h[order], c[order]
        first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        return pa.RecordBatch.from_arrays([pa.array(h[first].view(np.int64)), pa.array(np.add.reduceat(c, first))], ["word", "c"])

    return src.select("text").mapInArrow(run, "word long, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Alphabet:
    """The most frequent words (sorted by hash) and the sizes of the shared symbols; bounded by its parameters."""

    words: np.ndarray       # uint64, sorted
    counts: np.ndarray
    symbols: np.ndarray     # own symbol, or -1: the word shares a class
    own: int
    room: np.ndarray        # per class: log10(tokens + types + 1)
    unigram: np.ndarray     # P(symbol), smoothed
    n: int                  # training tokens
    v: int                  # different ones
    ends: int               # training texts
    added: np.ndarray       # smoothing counts of each symbol

    @property
    def end(self) -> int:
        return self.own

    @property
    def size(self) -> int:
        return self.own + 1 + len(self.room)

    def class_of(self, h: np.ndarray) -> np.ndarray:
        return (mix(h ^ np.uint64(0xA5A5)) % np.uint64(len(self.room))).astype(np.int64)


#: counts below this have a level each; above, a level is a range within a thousandth
EXACT = 1 << 11


def frequent(counts: DataFrame, known: int) -> DataFrame:
    """The rows of ``counts`` with the highest counts, at most ``known``.

    Two histograms of bounded size find the cut: by level of the count, then
    by the top 16 bits of the word among the words of the level that is cut.
    No task and not the driver sees more than a partition's rows of either.
    """
    bits = "length(bin(c))"
    leveled = counts.withColumn("level", F.expr(f"if(c < {EXACT}, c, {EXACT} * {bits} + shiftright(c, {bits} - 11))"))
    level, before, fits = _cut(leveled.groupBy(F.col("level").alias("k")).count(), known, down=True)
    if fits:
        return counts
    leveled = leveled.withColumn("part", F.shiftright("word", 48))
    tied = leveled.where(F.col("level") == level)
    part, _, _ = _cut(tied.groupBy(F.col("part").alias("k")).count(), known - before, down=False)
    return leveled.where((F.col("level") > level) | ((F.col("level") == level) & (F.col("part") < part))).drop("level", "part")


def _cut(histogram: DataFrame, room: int, down: bool) -> tuple[int, int, bool]:
    """(first key that does not fit whole, rows before it, do all fit?)."""
    got = histogram.toArrow()
    key, n = got.column("k").to_numpy(), got.column("count").to_numpy()
    order = np.argsort(-key if down else key)
    total = np.cumsum(n[order])
    at = int(np.searchsorted(total, room, side="right"))
    if at == len(order):
        return 0, int(total[-1]) if at else 0, True
    return int(key[order][at]), int(total[at - 1]) if at else 0, False


def alphabet(counts: DataFrame, own: int, classes: int, known: int) -> Alphabet:
    total = counts.agg(F.count("*").alias("v"), F.sum("c").alias("n")).first()
    n, v = total["n"] or 0, total["v"]
    end = int(END.view(np.int64))
    top = frequent(counts.where(F.col("word") != end), known).toArrow()
    words, c = top.column("word").to_numpy(), top.column("c").to_numpy()
    order = np.lexsort((words, -c))
    words, c = words[order].view(np.uint64), c[order]
    end_count = counts.where(F.col("word") == end).agg(F.sum("c")).first()[0] or 0
    own = min(own, len(words))
    symbol = np.full(len(words), -1)
    symbol[:own] = np.arange(own)
    a = Alphabet(words, c, symbol, own, np.zeros(classes), np.zeros(0), n, v, end_count, np.zeros(0))
    # tokens and types of each shared symbol, over the whole vocabulary
    ranked = counts.where(F.col("word") != end)
    kind = _class_sums(ranked, a)
    got = kind.toArrow()
    tokens, types = np.zeros(classes), np.zeros(classes)
    tokens[got.column("g").to_numpy()] = got.column("n").to_numpy()
    types[got.column("g").to_numpy()] = got.column("t").to_numpy()
    mine = a.class_of(words[:own])
    tokens -= np.bincount(mine, weights=c[:own], minlength=classes)
    types -= np.bincount(mine, minlength=classes)
    a.room = np.log10(tokens + types + 1)
    # add-one smoothing: one for each word type, and one unknown word in each shared symbol
    a.added = np.concatenate([np.ones(own + 1), types + 1])
    mass = np.concatenate([c[:own], [end_count], tokens]) + a.added
    a.unigram = mass / mass.sum()
    order = np.argsort(words)
    a.words, a.counts, a.symbols = words[order], c[order], symbol[order]
    return a


def _class_sums(counts: DataFrame, a: Alphabet) -> DataFrame:
    classes = len(a.room)

    def fn(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        g = a.class_of(batch.column("word").to_numpy().view(np.uint64))
        n = np.bincount(g, weights=batch.column("c").to_numpy(), minlength=classes).astype(np.int64)
        t = np.bincount(g, minlength=classes)
        some = np.flatnonzero(t)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some]), pa.array(t[some].astype(np.int64))], ["g", "n", "t"])

    return arrow_map(counts, fn, "g long, n long, t long").groupBy("g").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))


def encode(src: DataFrame, a: Alphabet) -> DataFrame:
    """(id, held_out, n_tokens, symbols, known, logs, drawn, rest): one row per text.

    ``known`` tokens with counts at hand and the sum of their log10(c + 1) (``logs``); ``drawn``: the part of the
    score that draws words from shared symbols, as far as counts are at hand; ``rest``: hashes still to be looked up, each once a text.
    """
    shared = src.sparkSession.sparkContext.broadcast(a)
    kind = src.schema["id"].dataType.simpleString()

    def fn(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        a = shared.value
        end_log = np.log10(a.ends + 1.0)
        for b in blocks(batch, "text"):
            w = Words(b.column("text"), lower=True)
            u, inverse = np.unique(w.hash, return_inverse=True)
            at = np.minimum(np.searchsorted(a.words, u), max(len(a.words) - 1, 0))
            found = a.words[at] == u if len(a.words) else np.zeros(len(u), bool)
            c = np.where(found, a.counts[at] if len(a.words) else 0, 0)
            symbol = np.where(found, a.symbols[at] if len(a.words) else -1, -1)
            g = a.class_of(u)
            shares = symbol < 0
            symbol = np.where(shares, a.own + 1 + g, symbol)
            logs = np.log10(c + 1.0)
            drawn = np.where(shares, logs - a.room[g], 0.0)
            n = w.count + 1
            first = np.concatenate([[0], np.cumsum(n)])
            out = np.full(first[-1], a.end, np.uint16)
            out[np.arange(len(w.start)) + w.row] = symbol[inverse]
            blob = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer((first * 2).astype(np.int32)), pa.py_buffer(out)])

            def per_text(x: np.ndarray, w: Words = w) -> np.ndarray:
                return np.bincount(w.row, weights=x, minlength=len(w.count)).astype(float)

            # each text's missing words once, with how often they occur
            missing = np.flatnonzero(~found[inverse])
            pair, times = np.unique(w.row[missing].astype(np.int64) * max(len(u), 1) + inverse[missing], return_counts=True)
            row, which = np.divmod(pair, max(len(u), 1))
            cut = np.searchsorted(row, np.arange(len(n) + 1))
            rest = pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.StructArray.from_arrays(
                [pa.array(u[which].view(np.int64)), pa.array(times.astype(np.int64))], ["word", "times"]))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("held_out"), pa.array(n.astype(np.int64)), blob,
                 pa.array((per_text(found[inverse].astype(float)) + (a.ends > 0)).astype(np.int64)),
                 pa.array(per_text(logs[inverse]) + end_log), pa.array(per_text(drawn[inverse])), rest],
                ["id", "held_out", "n_tokens", "symbols", "known", "logs", "drawn", "rest"])

    return arrow_map(src, fn, f"id {kind}, held_out boolean, n_tokens long, symbols binary, known long, logs double, "
                              "drawn double, rest array<struct<word:long,times:long>>")


@dataclass
class Model:
    start: np.ndarray  # (K,)
    move: np.ndarray   # (K, K)
    emit: np.ndarray   # (symbols, K)


def first_model(a: Alphabet, states: int, seed: int = 11) -> Model:
    r = np.random.default_rng(seed)
    emit = a.unigram[:, None] * np.exp(r.normal(0.0, 1.0, (a.size, states)))
    move = np.full((states, states), 0.05 / max(states - 1, 1))
    np.fill_diagonal(move, 0.95)
    return Model(np.full(states, 1.0 / states), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def sequence_blocks(batch: pa.RecordBatch, limit: int = BLOCK_TOKENS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, lengths, symbols) of blocks of texts, longest first; symbols of row r at step t: symbols[base[r] + t]."""
    blob = batch.column("symbols")
    off = np.frombuffer(blob.buffers()[1], np.int32)[blob.offset:blob.offset + len(blob) + 1].astype(np.int64) // 2
    all_symbols = np.frombuffer(blob.buffers()[2], np.uint16)
    size = np.diff(off)
    order = np.argsort(-size, kind="stable")
    total, begin = np.cumsum(size[order]), 0
    while begin < len(order):
        base = total[begin - 1] if begin else 0
        stop = max(begin + 1, int(np.searchsorted(total, base + limit, side="right")))
        rows = order[begin:stop]
        yield rows, size[rows], all_symbols, off[rows]
        begin = stop


def forward(m: Model, size: np.ndarray, symbols: np.ndarray, base: np.ndarray, keep: bool = False):  # noqa: ANN201
    """log10 probability of each text (longest first), and with ``keep`` the scaled alphas by step."""
    live = len(size)
    score = np.zeros(live)
    steps, alphas, scales = int(size[0]), [], []
    alpha = None
    alive = np.searchsorted(-size, -np.arange(steps), side="left")  # texts longer than t
    for t in range(steps):
        live = alive[t]
        e = m.emit[symbols[base[:live] + t]]
        alpha = (m.start if t == 0 else alpha[:live] @ m.move) * e
        c = alpha.sum(1)
        alpha = alpha / c[:, None]
        score[:live] += np.log10(c)
        if keep:
            alphas.append(alpha)
            scales.append(c)
    return score, alphas, scales


def expected(m: Model, size: np.ndarray, symbols: np.ndarray, base: np.ndarray, into: np.ndarray) -> None:
    """Add the expected counts of the texts to ``into``: emissions, then moves, then starts."""
    k = len(m.start)
    _, alphas, scales = forward(m, size, symbols, base, keep=True)
    beta = np.zeros((0, k))
    gammas, seen = [], []
    moves = np.zeros((k, k))
    after = None
    for t in range(len(alphas) - 1, -1, -1):
        alpha = alphas[t]
        now = np.ones((len(alpha), k))
        if after is not None and len(after):
            now[:len(after)] = after @ m.move.T
            moves += alpha[:len(after)].T @ after
        beta = now
        gammas.append(alpha * beta)
        s = symbols[base[:len(alpha)] + t]
        seen.append(s)
        after = m.emit[s] * beta / scales[t][:, None]
    g, s = np.concatenate(gammas), np.concatenate(seen)
    n = len(into) - k - 1
    for j in range(k):
        into[:n, j] += np.bincount(s, weights=g[:, j], minlength=n)
    into[n:n + k] += moves * m.move
    into[n + k] += gammas[-1].sum(0)


def baum_welch(coded: DataFrame, a: Alphabet, states: int, rounds: int) -> Model:
    """Train on all rows of ``coded`` that are not held out."""
    m, k = first_model(a, states), states
    train = coded.where(~F.col("held_out")).select("symbols")
    names = [f"e{j}" for j in range(k)]
    schema = "i int, " + ", ".join(f"{x} long" for x in names)
    for _ in range(rounds):
        shared = coded.sparkSession.sparkContext.broadcast(m)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            into = np.zeros((a_size + k + 1, k))
            for batch in batches:
                if batch.num_rows:
                    for _, size, symbols, base in sequence_blocks(batch):
                        expected(shared.value, size, symbols, base, into)
            whole = np.rint(into * FIXED).astype(np.int64)
            some = np.flatnonzero(whole.any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), *[pa.array(whole[some, j]) for j in range(k)]], ["i", *names])

        a_size = a.size
        got = train.mapInArrow(run, schema).groupBy("i").agg(*[F.sum(x).alias(x) for x in names]).toArrow()
        total = np.zeros((a_size + k + 1, k))
        total[got.column("i").to_numpy()] = np.stack([got.column(x).to_numpy() for x in names], axis=1) / FIXED
        shared.unpersist()
        if not total.any():
            break
        share = total[:a_size].sum(0) / total[:a_size].sum()
        emit = total[:a_size] + a.added[:, None] * share + PRIOR * a.unigram[:, None]
        move = total[a_size:a_size + k] + 0.1
        start = total[a_size + k] + 0.1
        m = Model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))
    return m


def score_texts(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", states: int = STATES,
                rounds: int = ROUNDS, own: int = OWN, classes: int = CLASSES, known: int = KNOWN) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every text, whole."""
    if own + classes + 1 > 1 << 16:
        raise ValueError("own + classes must stay below 65536 symbols")
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    counts = save(token_counts(src.where(~F.col("held_out"))), "counts")
    a = alphabet(counts, own, classes, known)
    coded = save(encode(src, a).withColumn("row", F.monotonically_increasing_id()), "coded")
    m = baum_welch(coded, a, states, rounds)
    kind = src.schema["id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(m)

    def fn(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out = np.zeros(batch.num_rows)
        for rows, size, symbols, base in sequence_blocks(batch):
            out[rows] = forward(shared.value, size, symbols, base)[0]
        keep = [c for c in batch.schema.names if c != "symbols"]
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(out)], [*keep, "path"])

    scored = arrow_map(coded.drop("rest"), fn, f"id {kind}, held_out boolean, n_tokens long, known long, logs double, drawn double, row long, path double")
    # words beyond the frequent ones meet their counts; unknown ones add log10(0 + 1) = 0
    rare = (coded.where(F.size("rest") > 0).select("row", F.inline("rest")).join(counts, "word")
            .groupBy("row").agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("c") + 1.0)).alias("rare")))
    base = np.log10((a.n + 1.0 * (a.v + 1)))
    more, rare_logs = F.coalesce("more", F.lit(0)), F.coalesce("rare", F.lit(0.0))
    return scored.join(rare, "row", "left").select(
        F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("known") + more).cast("long").alias("n_known"),
        F.lit(a.n).cast("long").alias("train_tokens"),
        (F.col("logs") + rare_logs - F.col("n_tokens") * F.lit(float(base))).alias("base_score"),
        (F.col("path") + F.col("drawn") + rare_logs).alias("score"))

