"""Benchmark decontamination with training suffix arrays.

Each block of training texts (a shard inside a task) gets a suffix array
over its words: the positions where a match can begin, sorted by the
words that follow.  Every benchmark suffix is binary-searched in it; the
range of equal prefixes gives all verbatim occurrences of its window, and
running on from them word by word gives the longest matches and their
places.  Texts never leave their task and are never shuffled.

The benchmark is a stated query set, sent to the tasks in blocks of at
most ``BLOCK_WORDS`` words (16 bytes a word), however large it is: blocks
are separate broadcasts, applied one after the other in one narrow pass.

Words are compared by 64-bit hashes mapped to the block's vocabulary.
A benchmark item with fewer words than the window is one window; an item
without words (or a null one) has none.

Defined cases: a null or empty text has no words and no hits; repeated
documents or items are judged alike, an item id that occurs twice counts
once; a null item id is an id of its own, written as ``null``; an empty
table on either side gives no hits; ``clean`` keeps all columns of its
input, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierload.llm.text import NOT_ALNUM, Words, blocks

WINDOW = 10
BLOCK_WORDS = 500_000


class QueryBlock:
    """Benchmark items as one word sequence, ready to be searched for."""

    def __init__(self, ids: list[str], texts: pa.Array, window: int = WINDOW) -> None:
        w = Words(texts, NOT_ALNUM, lower=True)
        self.ids, self.window = ids, window
        self.vocabulary, inverse = np.unique(w.hash, return_inverse=True)
        # a zero after each item, so no match runs into the next one
        at = np.arange(len(w.start)) + w.row
        self.seq = np.zeros(len(w.start) + len(ids) + window, np.uint32)
        self.seq[at] = inverse + 1
        size = np.minimum(w.count, window)[w.row]  # window length, by word
        left = w.first[w.row + 1] - np.arange(len(w.start))  # words to the item's end
        begins = left >= size
        self.start, self.size, self.item = at[begins], size[begins].astype(np.int64), w.row[begins]
        # windows with equal words are searched once
        self.key = prefixes(self.seq, self.start, self.size, window)
        self.distinct, self.which = np.unique(self.key, return_inverse=True)
        order = np.argsort(self.which, kind="stable")
        self.members = order  # windows, grouped by distinct window
        self.member_first = np.searchsorted(self.which[order], np.arange(len(self.distinct) + 1))
        one = order[self.member_first[:-1]] if len(order) else order
        self.distinct_size = self.size[one]
        self.lead = 1 if len(self.size) and self.size.min() == 1 else 2
        first = self.seq[self.start].astype(np.uint64)
        second = self.seq[self.start + 1].astype(np.uint64) if self.lead == 2 else 0
        self.leads = np.unique(first << np.uint64(32) | second)


def prefixes(seq: np.ndarray, start: np.ndarray, size: np.ndarray | int, depth: int, fill: int = 0) -> np.ndarray:
    """Fixed-width keys of the ``depth`` words from each start; words from ``size`` on are ``fill``.

    Big-endian, so byte order is word order.
    """
    out = np.full((len(start), depth), fill, ">u4")
    for j in range(depth):
        take = np.broadcast_to(np.asarray(size) > j, len(start))
        out[take, j] = seq[start[take] + j]
    return out.view(f"S{4 * depth}").ravel() if len(start) else np.zeros(0, f"S{4 * depth}")


class Shard:
    """Suffix array over the words of a block of training texts."""

    def __init__(self, texts: pa.Array, q: QueryBlock) -> None:
        w = Words(texts, NOT_ALNUM, lower=True)
        self.count, self.q = w.count, q
        self.first = w.first + np.arange(len(w.first))  # of each text in seq: a zero stands after each text
        at = np.arange(len(w.start)) + w.row
        found = np.searchsorted(q.vocabulary, w.hash)
        known = found < len(q.vocabulary)
        known[known] = q.vocabulary[found[known]] == w.hash[known]
        self.seq = np.zeros(len(w.start) + len(w.count) + q.window, np.uint32)
        self.seq[at[known]] = found[known] + 1
        # suffixes that begin as some benchmark suffix does
        begin = at[known]
        if q.lead == 2:
            begin = begin[self.seq[begin + 1] > 0]
            lead = self.seq[begin].astype(np.uint64) << np.uint64(32) | self.seq[begin + 1].astype(np.uint64)
        else:
            lead = self.seq[begin].astype(np.uint64) << np.uint64(32)
        place = np.searchsorted(q.leads, lead)
        ok = place < len(q.leads)
        ok[ok] = q.leads[place[ok]] == lead[ok]
        begin = begin[ok]
        keys = prefixes(self.seq, begin, q.window, q.window)
        order = np.argsort(keys, kind="stable")
        self.suffixes, self.keys = begin[order], keys[order]

    def occurrences(self) -> tuple[np.ndarray, np.ndarray]:
        """(place in seq, distinct window) of every verbatim occurrence of a benchmark window."""
        q = self.q
        if not len(self.keys) or not len(q.distinct):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        low = np.searchsorted(self.keys, q.distinct, "left")
        high = np.searchsorted(self.keys, q.distinct, "right")
        for i in np.flatnonzero(q.distinct_size < q.window):  # shorter windows match longer suffixes
            top = np.frombuffer(q.distinct[i].ljust(4 * q.window, b"\0"), ">u4").copy()
            top[q.distinct_size[i]:] = 0xFFFFFFFF
            high[i] = np.searchsorted(self.keys, top.view(f"S{4 * q.window}")[0], "right")
        n = high - low
        window = np.repeat(np.arange(len(n)), n)
        offset = np.arange(len(window)) - np.repeat(np.cumsum(n) - n, n)
        return self.suffixes[low[window] + offset], window

    def text_of(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, place, "right") - 1

    def hits(self) -> tuple[list[np.ndarray], list[list[int]]]:
        """Per text: mask of hit words, and the items with an occurring window."""
        place, window = self.occurrences()
        q = self.q
        step = np.zeros(len(self.seq) + 1, np.int64)
        np.add.at(step, place, 1)
        np.add.at(step, place + q.distinct_size[window], -1)
        hit = np.cumsum(step)[:-1] > 0
        masks = [hit[a:a + n] for a, n in zip(self.first[:-1], self.count, strict=True)]
        items: list[list[int]] = [[] for _ in self.count]
        pairs = np.unique(np.stack([self.text_of(place), window]), axis=1)
        for t, d in pairs.T:
            items[t].extend(q.item[q.members[q.member_first[d]:q.member_first[d + 1]]].tolist())
        return masks, [sorted(set(i)) for i in items]

    def longest(self) -> list[tuple[int, int, int, int, int]]:
        """(text, word, item, item word, words): the longest match of each item in each text."""
        place, window = self.occurrences()
        q = self.q
        n = q.member_first[window + 1] - q.member_first[window]
        each = np.repeat(np.arange(len(place)), n)
        offset = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
        mine = q.members[q.member_first[window[each]] + offset]
        place, start, words = place[each], q.start[mine], q.size[mine].copy()
        live = np.arange(len(place))
        while len(live):
            a, b = place[live] + words[live], start[live] + words[live]
            a, b = np.minimum(a, len(self.seq) - 1), np.minimum(b, len(q.seq) - 1)
            live = live[(self.seq[a] == q.seq[b]) & (q.seq[b] > 0)]
            words[live] += 1
        text, item = self.text_of(place), q.item[mine]
        order = np.lexsort((place, start, -words, item, text))
        text, item, place, start, words = (x[order] for x in (text, item, place, start, words))
        best = np.ones(len(text), bool)
        best[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1])
        item_start = np.full(len(q.ids), -1)
        item_start[q.item[::-1]] = q.start[::-1]
        return [(int(t), int(p - self.first[t]), int(i), int(s - item_start[i]), int(m))
                for t, p, i, s, m in zip(*(x[best] for x in (text, place, item, start, words)), strict=True)]


def query_blocks(items: DataFrame, id_col: str, text_col: str, window: int, block_words: int) -> Iterator[QueryBlock]:
    """The benchmark in blocks of at most ``block_words`` words (an item is never split)."""
    ids, texts, size = [], [], 0
    rows = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("i"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t")).orderBy("i", "t")
    for r in rows.toLocalIterator():
        n = len(r["t"]) // 2 + 1
        if ids and size + n > block_words:
            yield QueryBlock(ids, pa.array(texts, pa.string()), window)
            ids, texts, size = [], [], 0
        ids.append(r["i"]), texts.append(r["t"])
        size += n
    yield QueryBlock(ids, pa.array(texts, pa.string()), window)


def hits(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
         item_text_col: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS,
         keep: bool = False) -> DataFrame:
    """Per document: n_words, n_hit, item ids (distinct, sorted as strings) with occurring windows.

    ``keep``: all input columns come along, as one struct ``row`` instead of the id.
    """
    spark = docs.sparkSession
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]) if keep else F.struct(F.col(id_col).alias(id_col))
    table = docs.select(row.alias("row"), F.col(text_col).cast("string").alias("text"),
                        F.lit(None).cast("binary").alias("hit"), F.lit(None).cast("array<string>").alias("items"),
                        F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"))
    for q in query_blocks(items, item_id_col, item_text_col, window, block_words):
        table = table.mapInArrow(_search(spark.sparkContext.broadcast(q)), table.schema)
    return table.select("row" if keep else f"row.{id_col}", "n_words", "n_hit", "items")


def _search(shared):  # noqa: ANN001, ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = shared.value
        for batch in batches:
            for b in blocks(batch, "text"):
                shard = Shard(b.column("text"), q)
                masks, items = shard.hits()
                before, had = b.column("hit").to_pylist(), b.column("items").to_pylist()
                packed, names, n_hit = [], [], []
                for i, mask in enumerate(masks):
                    if before[i] is not None:
                        mask = mask | np.unpackbits(np.frombuffer(before[i], np.uint8), count=len(mask)).astype(bool)
                    some = mask.any()
                    n_hit.append(int(mask.sum()))
                    packed.append(np.packbits(mask).tobytes() if some else None)
                    names.append(sorted({q.ids[j] for j in items[i]} | set(had[i] or ())))
                yield pa.RecordBatch.from_arrays(
                    [b.column("row"), b.column("text"), pa.array(packed, pa.binary()),
                     pa.array(names, pa.list_(pa.string())), pa.array(shard.count.astype(np.int64)),
                     pa.array(n_hit, pa.int64())], ["row", "text", "hit", "items", "n_words", "n_hit"])
    return run


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
            block_words: int = BLOCK_WORDS) -> DataFrame:
    """Longest verbatim match of each item in each document that holds one of its windows, with both places (in words)."""
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    schema = f"id {kind}, doc_word long, item_id string, item_word long, n_words long"
    out = None

    def search(shared):  # noqa: ANN001, ANN202
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            q = shared.value
            for batch in batches:
                for b in blocks(batch, "text"):
                    found = Shard(b.column("text"), q).longest()
                    if found:
                        t, p, i, s, m = zip(*found, strict=True)
                        yield pa.RecordBatch.from_arrays(
                            [b.column("id").take(pa.array(t)), pa.array(p, pa.int64()),
                             pa.array([q.ids[k] for k in i], pa.string()), pa.array(s, pa.int64()),
                             pa.array(m, pa.int64())], ["id", "doc_word", "item_id", "item_word", "n_words"])
        return run

    for q in query_blocks(items, item_id_col, item_text_col, window, block_words):
        part = src.mapInArrow(search(spark.sparkContext.broadcast(q)), schema)
        out = part if out is None else out.unionAll(part)
    return out.withColumnRenamed("id", id_col)


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
          item_text_col: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents without any hit, with all their columns."""
    found = hits(docs, items, text_col, text_col, item_id_col, item_text_col, window, block_words, keep=True)
    return found.where(F.col("n_hit") == 0).select("row.*")
