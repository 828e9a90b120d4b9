"""Phrase collocations per language, from pair counts in tiles of frequency-ranked ids.

A phrase is 2 to ``longest`` consecutive words of one piece of a text
(pieces end at punctuation and line ends).  Counts grow one word at a
time: a phrase that occurs often enough begins and ends with a phrase, one
word shorter, that does too.

1. *Ids*: words are counted per language; the frequent ones are ranked by
   count, so that the ids of common words lie close together.
2. *Tiles*: a phrase is a pair (id of its first words, id of its last
   word).  The pair space is cut into square tiles.  A tile that a block of
   texts fills well has one counter per pair, addressed directly and
   counted with ``bincount`` for as long as the task runs; the pairs of all
   other tiles are sorted and run-length counted (COO), and merged when
   many are held.  Tasks send (pair, count), so a pair held by a third of
   all texts is one row a task.
3. *Recursion*: the frequent pairs are ranked again and become the left ids
   of the next length.
4. *Scores* use exact decimals.  Every cut of a phrase looks its two parts
   up by id; the most frequent parts, which many phrases share, are joined
   from a broadcast of at most ``HEAD`` rows, the others by shuffle.

Ids of at most ``RANKED`` phrases of one length are ranked and broadcast
(16 bytes each).  Beyond it the rest, which are the least frequent, keep
their 64-bit hash as id: they pass a Bloom filter of fixed size and are
counted in COO form, so no phrase is lost.  Words and phrases are told
apart by 64-bit hashes of language and words.

Defined cases: a null language is ``und``; null and empty texts hold no
words; rows are counted each, whatever their ids; a word that holds no
letter is a word; an empty table, or one without frequent phrases, gives an
empty result; only the language and text columns are read, so other
columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierload.llm.common import IdFilter, arrow_map, save
from tierload.llm.text import Words, blocks, hash_spans, mix, take_spans, utf8_buffers

LONGEST, MIN_COUNT, CONTAINED, TOP = 3, 10, 50, 2000
RANKED, HEAD = 1 << 20, 1 << 16
SIDE = 1 << 10            # a tile has SIDE x SIDE counters
FULL = SIDE * SIDE // 64  # pairs of one block that make a tile dense
TILES = 6                 # dense tiles of a task: 8 MB each
COO = 1_000_000           # entries held before they are merged
BLOCK_BYTES = 1 << 20
SALTS = 16

BREAK = np.zeros(256, dtype=bool)
BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
GAP = BREAK.copy()
GAP[[0x20, 0x09]] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)


def follow(left: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Id of a phrase from the id of its first words and its last word's."""
    return mix(left * _STEP + word)


class PieceWords:
    """Words of a block: ``id`` (language and word) and ``piece`` (number of the word's piece)."""

    def __init__(self, b: pa.RecordBatch) -> None:
        self.words = w = Words(b.column("text"), GAP, lower=True)
        off, data = utf8_buffers(b.column("lang"))
        self.lang = mix(hash_spans(data, off[:-1], off[1:]))
        self.id = mix(w.hash ^ self.lang[w.row])
        self.piece = np.cumsum(BREAK[w.data])[w.start] + w.row if len(w.data) else w.row


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, phrase, n) of every word."""

    def fn(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for b in blocks(batch, "text", BLOCK_BYTES):
            p = PieceWords(b)
            w = p.words
            _, first, n = np.unique(p.id, return_index=True, return_counts=True)
            text = take_spans(w.data, w.start[first], w.end[first], pa.string())
            yield pa.RecordBatch.from_arrays([b.column("lang").take(pa.array(w.row[first])), text, pa.array(n)], ["lang", "phrase", "n"])

    return arrow_map(docs, fn, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def with_word_ids(words: DataFrame) -> DataFrame:
    """(id, lang, phrase, n, s1) of counted words."""

    def fn(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        off, data = utf8_buffers(batch.column("phrase"))
        lang_off, lang = utf8_buffers(batch.column("lang"))
        ids = mix(hash_spans(data, off[:-1], off[1:]) ^ mix(hash_spans(lang, lang_off[:-1], lang_off[1:])))
        ids = pa.array(ids.view(np.int64))
        yield pa.RecordBatch.from_arrays([ids, batch.column("lang"), batch.column("phrase"), batch.column("n"), ids],
                                         ["id", "lang", "phrase", "n", "s1"])

    return arrow_map(words, fn, "id long, lang string, phrase string, n long, s1 long")


def _size_class() -> Column:
    return F.floor(F.log2(F.col("n")) * 64).cast("int")


def top_class(grams: DataFrame, limit: int) -> tuple[int, bool]:
    """(smallest size class, any below it): the classes from there up hold at most ``limit`` rows.

    One row per class of counts (64 per power of two) reaches the driver.
    """
    got = grams.groupBy(_size_class().alias("c")).agg(F.count("*").alias("m")).orderBy(F.desc("c")).collect()
    held = 0
    for i, r in enumerate(got):
        held += r["m"]
        if held > limit:
            return (got[i - 1]["c"] if i else r["c"] + 1), True
    return 0, False


@dataclass
class Ranks:
    """Ranked ids (sorted by id, with their rank) and a filter of the others that are frequent."""

    ids: np.ndarray
    rank: np.ndarray
    by_rank: np.ndarray
    others: IdFilter | None

    def find(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank or -1, may be frequent) of each id."""
        if len(self.ids):
            at = np.minimum(np.searchsorted(self.ids, ids), len(self.ids) - 1)
            rank = np.where(self.ids[at] == ids, self.rank[at], -1)
        else:
            rank = np.full(len(ids), -1)
        frequent = rank >= 0
        if self.others is not None:
            rest = np.flatnonzero(~frequent)
            frequent[rest] = self.others.contains(pa.array(ids[rest].view(np.int64)))
        return rank, frequent


def ranks(grams: DataFrame, limit: int) -> Ranks:
    """Ids ranked by language, count and id: the languages' ranks follow each other."""
    least, more = top_class(grams, limit)
    got = grams.where(_size_class() >= least).select("id", "n", F.xxhash64("lang").alias("lang")).toArrow()
    ids, n, lang = (got.column(c).to_numpy() for c in ("id", "n", "lang"))
    ids = ids.view(np.uint64)
    order = np.lexsort((ids, -n, lang))
    by_rank = ids[order]
    sort = np.argsort(by_rank)
    return Ranks(by_rank[sort], sort, by_rank, IdFilter(grams.where(_size_class() < least), "id") if more else None)


class TileCounter:
    """Pair counts of one task."""

    def __init__(self, left: Ranks, right: Ranks) -> None:
        self.left, self.right = left, right
        self.dense: dict[int, np.ndarray] = {}
        self.coo: list[tuple[np.ndarray, np.ndarray]] = []
        self.rare: list[tuple[np.ndarray, ...]] = []
        self.columns = len(right.by_rank) // SIDE + 1

    def add(self, left: np.ndarray, right: np.ndarray, left_rank: np.ndarray, right_rank: np.ndarray) -> Iterator[pa.RecordBatch]:
        ranked = (left_rank >= 0) & (right_rank >= 0)
        if not ranked.all():
            a, b = left[~ranked], right[~ranked]
            _, first, n = np.unique(follow(a, b), return_index=True, return_counts=True)
            self.rare.append((a[first], b[first], n))
        x, y = left_rank[ranked], right_rank[ranked]
        tile = x // SIDE * self.columns + y // SIDE
        place = x % SIDE * SIDE + y % SIDE
        numbers, of, filled = np.unique(tile, return_inverse=True, return_counts=True)
        direct = (filled >= FULL) | np.isin(numbers, list(self.dense))
        for t in np.flatnonzero(direct):
            number = int(numbers[t])
            if number not in self.dense and len(self.dense) == TILES:
                yield from self.flush_dense()
            counts = np.bincount(place[of == t], minlength=SIDE * SIDE)
            self.dense[number] = self.dense[number] + counts if number in self.dense else counts
        loose = ~direct[of]
        self.coo.append(np.unique(tile[loose] * (SIDE * SIDE) + place[loose], return_counts=True))
        if sum(len(k) for k, _ in self.coo) >= COO:
            yield from self.flush_coo()
        if sum(len(k[0]) for k in self.rare) >= COO:
            yield from self.flush_rare()

    def _pairs(self, key: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        tile, place = key // (SIDE * SIDE), key % (SIDE * SIDE)
        x = tile // self.columns * SIDE + place // SIDE
        y = tile % self.columns * SIDE + place % SIDE
        yield from _rows(self.left.by_rank[x], self.right.by_rank[y], n)

    def flush_dense(self) -> Iterator[pa.RecordBatch]:
        for number, counts in self.dense.items():
            place = np.flatnonzero(counts)
            yield from self._pairs(number * (SIDE * SIDE) + place, counts[place])
        self.dense = {}

    def flush_coo(self) -> Iterator[pa.RecordBatch]:
        if self.coo:
            key, n = (np.concatenate(x) for x in zip(*self.coo, strict=True))
            order = np.argsort(key, kind="stable")
            key, n = key[order], n[order]
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else key
            if len(key):
                yield from self._pairs(key[first], np.add.reduceat(n, first))
        self.coo = []

    def flush_rare(self) -> Iterator[pa.RecordBatch]:
        for part in self.rare:
            yield from _rows(*part)
        self.rare = []

    def rest(self) -> Iterator[pa.RecordBatch]:
        yield from self.flush_dense()
        yield from self.flush_coo()
        yield from self.flush_rare()


def _rows(left: np.ndarray, right: np.ndarray, n: np.ndarray, at_most: int = 200_000) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(n), at_most):
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(left[i:i + at_most]).view(np.int64)),
                                          pa.array(np.ascontiguousarray(right[i:i + at_most]).view(np.int64)),
                                          pa.array(n[i:i + at_most].astype(np.int64))], ["left", "right", "n"])


def pair_counts(docs: DataFrame, shorter: list[Ranks], min_count: int) -> DataFrame:
    """(left, right, n) of the frequent phrases one word longer than the last of ``shorter`` (ranks by length)."""
    shared = docs.sparkSession.sparkContext.broadcast(shorter)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = shared.value
        size = len(levels)
        counter = TileCounter(levels[-1], levels[0])
        for batch in batches:
            for b in blocks(batch, "text", BLOCK_BYTES):
                p = PieceWords(b)
                if len(p.id) <= size:
                    continue
                word_rank, ok = levels[0].find(p.id)
                gram, rank, at = p.id, word_rank, np.flatnonzero(ok)
                for k in range(1, size):  # frequent phrases of k + 1 words, by their first word
                    at = _both_ends(at, p.piece, k)
                    gram = _spread(at, follow(gram[at], p.id[at + k]), len(p.id))
                    found, ok = levels[k].find(gram[at])
                    rank = _spread(at, found, len(p.id))
                    at = at[ok]
                at = _both_ends(at, p.piece, size)
                yield from counter.add(gram[at], p.id[at + size], rank[at], word_rank[at + size])
        yield from counter.rest()

    # counted per task already: shuffled as they are, not combined once more before
    rows = docs.mapInArrow(run, "left long, right long, n long").repartition("left", "right")
    return rows.groupBy("left", "right").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _both_ends(at: np.ndarray, piece: np.ndarray, size: int) -> np.ndarray:
    """Places where a frequent phrase of ``size`` words and the one a word later begin, in one piece."""
    at = at[:-1][np.diff(at) == 1]
    at = at[at + size < len(piece)]
    return at[piece[at] == piece[at + size]]


def _spread(at: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, values.dtype)
    out[at] = values
    return out


def lookup(rows: DataFrame, key: str, grams: DataFrame) -> DataFrame:
    """Inner join of ``rows`` by id; the parts that many rows share are broadcast, at most ``HEAD`` of them."""
    grams = grams.withColumnRenamed("id", key)
    least, more = top_class(grams, HEAD)
    head = F.broadcast(grams.where(_size_class() >= least))
    joined = _renamed(rows, head, key)
    if not more:
        return joined
    tail = rows.join(F.broadcast(grams.where(_size_class() >= least).select(key)), key, "left_anti")
    return joined.unionByName(_renamed(tail, grams.where(_size_class() < least), key))


def _renamed(rows: DataFrame, grams: DataFrame, key: str) -> DataFrame:
    return rows.join(grams.select(key, *[F.col(c).alias(f"{key}_{c}") for c in grams.columns if c != key]), key)


def named(pairs: DataFrame, left: DataFrame, words: DataFrame, size: int) -> DataFrame:
    """(id, lang, phrase, n, s1 ... s<size>) of counted pairs."""
    rows = lookup(lookup(pairs, "left", left), "right", words.drop("s1", "lang"))

    def fn(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids = follow(*(batch.column(c).to_numpy().view(np.uint64) for c in ("left", "right")))
        yield pa.RecordBatch.from_arrays([pa.array(ids.view(np.int64)), *batch.columns[2:]], ["id", *batch.schema.names[2:]])

    parts = [f"s{i}" for i in range(1, size + 1)]
    rows = rows.select("left", "right", F.col("left_lang").alias("lang"), F.concat_ws(" ", "left_phrase", "right_phrase").alias("phrase"), "n",
                       *[F.col(f"left_{s}").alias(s) for s in parts[:-1]], F.col("right").alias(parts[-1]))
    return arrow_map(rows, fn, "id long, lang string, phrase string, n long, " + ", ".join(f"{s} long" for s in parts))


def with_part(rows: DataFrame, name: str, first: int, last: int) -> DataFrame:
    """Adds the id of the words ``first`` to ``last`` of each phrase."""
    schema = rows.schema

    def fn(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        s = [batch.column(f"s{i}").to_numpy().view(np.uint64) for i in range(first, last + 1)]
        ids = s[0]
        for word in s[1:]:
            ids = follow(ids, word)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids.view(np.int64))], [*batch.schema.names, name])

    return arrow_map(rows, fn, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + f", {name} long")


def scored(levels: list[DataFrame], size: int) -> DataFrame:
    """(id, lang, phrase, a, l, r, score): phrases of ``size`` words with their lowest-scoring cut."""
    cuts = []
    for k in range(1, size):
        rows = with_part(with_part(levels[size - 1], "pre", 1, k), "suf", k + 1, size)
        rows = lookup(lookup(rows, "pre", levels[k - 1].select("id", "n")), "suf", levels[size - k - 1].select("id", "n"))
        wide = [F.col(c).cast("decimal(15,0)") for c in ("n", "n", "pre_n", "suf_n")]
        score = F.call_function("div", wide[0] * wide[1] * F.lit(1_000_000).cast("decimal(7,0)"), wide[2] * wide[3])
        cuts.append(rows.select("id", "lang", "phrase", F.col("n").alias("a"),
                                F.struct(score.alias("score"), F.lit(k).alias("k"), F.col("pre_n").alias("l"), F.col("suf_n").alias("r")).alias("cut")))
    out = cuts[0]
    for more in cuts[1:]:
        out = out.unionAll(more)
    if size > 2:
        out = out.groupBy("id", "lang", "phrase", "a").agg(F.min("cut").alias("cut"))
    return out.select("id", "lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def contained(longer: DataFrame, size: int) -> DataFrame:
    """(id, within): the largest count of a phrase of ``size`` words that holds the phrase, one word shorter."""
    first = with_part(longer, "part", 1, size - 1).select("part", "n")
    last = with_part(longer, "part", 2, size).select("part", "n")
    return first.unionAll(last).groupBy(F.col("part").alias("id")).agg(F.max("n").alias("within"))


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", longest: int = LONGEST, min_count: int = MIN_COUNT,
                 percent: int = CONTAINED, top: int = TOP, ranked: int = RANKED) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language.

    A phrase is left out when a longer candidate holds it and has at least
    ``percent`` of its count.  Only the next length is looked at: between a
    phrase and a longer one around it lies a candidate of every length,
    which occurs at least as often as the longer one.
    """
    src = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    words = save(word_counts(src), "words")
    levels = [save(with_word_ids(words.where(F.col("n") >= min_count)), "phrases")]
    known = []
    for size in range(2, longest + 1):
        known.append(ranks(levels[-1], ranked))
        pairs = save(pair_counts(src, known, min_count), "pairs")
        levels.append(save(named(pairs, levels[-1], levels[0], size), "phrases"))
    out = None
    for size in range(2, longest + 1):
        rows = scored(levels, size)
        if size < longest:
            rows = rows.join(contained(levels[size], size + 1), "id", "left").where(
                ~F.coalesce(100 * F.col("within") >= percent * F.col("a"), F.lit(False))).drop("within")
        out = rows if out is None else out.unionByName(rows)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order)
    whole = Window.partitionBy("lang").orderBy(*order)
    best = (out.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= top)
            .withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= top))
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
