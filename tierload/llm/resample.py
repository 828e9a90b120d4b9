"""Importance resampling towards a target distribution, over hashed word runs.

Features are all runs of 1 to ``max_run`` consecutive words, hashed by
CRC-32 into buckets.  A bucket's gain compares its smoothed share in the
target texts with its share in the documents; a document's weight is its
mean gain, and seeded Gumbel noise turns the top scores into a draw
without replacement.

1. *Dictionary*: the distinct words of a block of texts, each bounded by
   its delimiters (one space after normalising), enter an Aho-Corasick
   automaton.  A word's payload is its CRC-32 and its length in bytes, so
   a word's bytes are hashed once per block, however often it occurs.
2. *Scan*: the automaton runs over the normalised texts and emits one
   payload per word, in order.  The CRC of a run follows from its payloads
   alone: appending ``n`` bytes is a linear map of the CRC register, so
   adjacent payloads compose without looking at the text again.
3. The buckets are written once (two bytes a feature); counting and
   scoring read them, not the texts.
4. *Draw*: ranks come from a range sort by score: a row's place in its
   range plus the rows of the ranges before.  No task holds all scores.

Memory follows the block (``BLOCK_BYTES`` of text, or the longest text);
the driver receives one row per bucket and one per range.

Defined cases: a null or empty text, or one without words, has no
features, weight 0 and is never drawn; rows that repeat an id are scored
and ranked each; a null id draws its noise from the empty string and comes
last among ties; an empty table gives an empty result, an empty target
leaves only the smoothing; only the id and text columns are read, so
other columns cannot clash.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierload.llm.common import arrow_map, save
from tierload.llm.text import LOWER, NOT_ALNUM, blocks, utf8_buffers

BUCKETS = 10_000
MAX_RUN = 2
MIN_WORDS = 20
BLOCK_BYTES = 4 << 20

#: lower-cases A-Z and turns every delimiter into a space
NORMAL = np.where(NOT_ALNUM[LOWER], np.uint8(0x20), LOWER).astype(np.uint8)


def _append_zeros() -> np.ndarray:
    """(k, byte, value): what each byte of a CRC register becomes after ``2**k`` zero bytes."""
    one = np.zeros(256, np.uint32)
    for i in range(256):
        c = i
        for _ in range(8):
            c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
        one[i] = c
    value = np.arange(256, dtype=np.uint32)
    step = np.stack([(v := value << np.uint32(8 * k)) >> np.uint32(8) ^ one[v & np.uint32(255)] for k in range(4)])
    out = [step]
    for _ in range(31):
        out.append(np.stack([_apply(out[-1], out[-1][k]) for k in range(4)]))
    return np.stack(out)


def _apply(table: np.ndarray, c: np.ndarray) -> np.ndarray:
    b = np.uint32(255)
    return table[0][c & b] ^ table[1][(c >> np.uint32(8)) & b] ^ table[2][(c >> np.uint32(16)) & b] ^ table[3][c >> np.uint32(24)]


SHIFT = _append_zeros()


def compose(crc: np.ndarray, tail_crc: np.ndarray, tail_size: np.ndarray) -> np.ndarray:
    """CRC-32 of two byte strings put together, from their CRCs and the second one's size."""
    out = crc.copy()
    for k in range(int(tail_size.max(initial=0)).bit_length()):
        at = np.flatnonzero(tail_size >> k & 1)
        out[at] = _apply(SHIFT[k], out[at])
    return out ^ tail_crc


def automaton(words: set[str]) -> ahocorasick.Automaton:
    """Delimiter-bounded words; payload: CRC-32 in the low 32 bits, size in bytes above."""
    found = ahocorasick.Automaton()
    for word in words:
        raw = word.encode("utf-8", "surrogateescape")
        found.add_word(f" {word} ", len(raw) << 32 | zlib.crc32(raw))
    found.make_automaton()
    return found


def payloads(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, crc, size) of every word of a block, in order of the texts."""
    offsets, data = utf8_buffers(texts)
    raw = NORMAL[data].tobytes()
    padded = [f" {raw[a:z].decode('utf-8', 'surrogateescape')} " for a, z in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
    words: set[str] = set()
    for text in padded:
        words.update(text.split(" "))
    words.discard("")
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(0, np.int64)
    scan = automaton(words).iter
    held = [np.fromiter((p for _, p in scan(text)), np.int64) for text in padded]
    all_of = np.concatenate(held)
    row = np.repeat(np.arange(len(held)), [len(x) for x in held])
    return row, (all_of & 0xFFFFFFFF).astype(np.uint32), all_of >> 32


def run_buckets(row: np.ndarray, crc: np.ndarray, size: np.ndarray, max_run: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of all runs of 1 to ``max_run`` words, by row."""
    space, one = np.uint32(zlib.crc32(b" ")), np.ones(len(row), np.int64)
    rows, found, run = [row], [crc % np.uint32(buckets)], crc
    for k in range(1, max_run):
        n = len(row) - k
        if n <= 0:
            break
        run = compose(compose(run[:n], np.full(n, space, np.uint32), one[:n]), crc[k:], size[k:])
        same = row[:n] == row[k:]
        rows.append(row[:n][same])
        found.append(run[same] % np.uint32(buckets))
    rows_all, all_found = np.concatenate(rows), np.concatenate(found)
    order = np.argsort(rows_all, kind="stable")
    return rows_all[order], all_found[order]


def feature_buckets(docs: DataFrame, max_run: int = MAX_RUN, buckets: int = BUCKETS) -> DataFrame:
    """(id, n_words, n_features, buckets) of every row of (id, text); ``buckets`` packs two bytes a feature."""
    if not 0 < buckets <= 1 << 16:
        raise ValueError("buckets must lie between 1 and 65536")
    kind = docs.schema["id"].dataType.simpleString()

    def fn(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for b in blocks(batch, "text", BLOCK_BYTES):
            row, crc, size = payloads(b.column("text"))
            n_words = np.bincount(row, minlength=b.num_rows)
            rows, found = run_buckets(row, crc, size, max_run, buckets) if len(row) else (row, crc)
            n = np.bincount(rows, minlength=b.num_rows)
            off = np.concatenate([[0], np.cumsum(n)]) * 2
            blob = pa.Array.from_buffers(pa.large_binary(), b.num_rows,
                                         [None, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(found.astype("<u2"))])
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(n_words.astype(np.int64)), pa.array(n.astype(np.int64)),
                                              blob.cast(pa.binary())], ["id", "n_words", "n_features", "buckets"])

    return arrow_map(docs.select("id", "text"), fn, f"id {kind}, n_words long, n_features long, buckets binary")


def _unpack(column: pa.Array) -> np.ndarray:
    off = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, "<u2")[off[0] // 2:off[-1] // 2] if data is not None else np.zeros(0, "<u2")


def bucket_counts(coded: DataFrame, buckets: int) -> np.ndarray:
    """Features in each bucket (one row per bucket reaches the driver)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(buckets, np.int64)
        for batch in batches:
            if batch.num_rows:
                count += np.bincount(_unpack(batch.column("buckets")), minlength=buckets)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(count[some])], ["bucket", "n"])

    got = coded.select("buckets").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[got.column("bucket").to_numpy()] = got.column("n").to_numpy()
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the smoothed share in the target over the one in the source)."""
    s_all, t_all = float(source.sum()) + len(source), float(target.sum()) + len(target)
    return np.array([math.floor(1000 * math.log((float(t) + 1) * s_all / ((float(s) + 1) * t_all)))
                     for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def weights(coded: DataFrame, gains: np.ndarray) -> DataFrame:
    """(id, n_words, n_features, weight): the floored mean gain of each text's features."""
    shared = coded.sparkSession.sparkContext.broadcast(gains)
    kind = coded.schema["id"].dataType.simpleString()

    def fn(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        n = batch.column("n_features").to_numpy()
        total = np.concatenate([[0], np.cumsum(shared.value[_unpack(batch.column("buckets"))])])
        end = np.cumsum(n)
        weight = (total[end] - total[end - n]) // np.maximum(n, 1)
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n_words"), batch.column("n_features"), pa.array(weight)],
                                         ["id", "n_words", "n_features", "weight"])

    return arrow_map(coded, fn, f"id {kind}, n_words long, n_features long, weight long")


def gumbel(id_col: str, seed: int) -> Column:
    """Seeded noise of a row, from the SHA-256 of the seed and its id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def ranked(rows: DataFrame, order: list[Column], label: str) -> tuple[DataFrame, int]:
    """(``rows`` with ``rank`` from 1 in the given order, number of rows), by a range sort."""
    placed = save(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), label)
    part = F.shiftright("_at", 33)
    size = placed.groupBy(part.cast("int").alias("_part")).agg(F.count("*").alias("n")).orderBy("_part").collect()
    before, total = [], 0
    for r in size:  # one row per range
        before.append((r["_part"], total))
        total += r["n"]
    offsets = rows.sparkSession.createDataFrame(before, "_part int, _before long")
    out = placed.withColumn("_part", part.cast("int")).join(F.broadcast(offsets), "_part")
    return out.withColumn("rank", F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1).drop("_part", "_before", "_at"), total


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, seed: int = 7, id_col: str = "doc_id", text_col: str = "text",
             target_text_col: str = "text", min_words: int = MIN_WORDS, max_run: int = MAX_RUN, buckets: int = BUCKETS) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) of every document; rank is null where it was not drawn."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    aim = target.select(F.lit(0).alias("id"), F.col(target_text_col).cast("string").alias("text"))
    coded = save(feature_buckets(src, max_run, buckets), "buckets")
    gains = bucket_gains(bucket_counts(coded, buckets), bucket_counts(feature_buckets(aim, max_run, buckets), buckets))
    scored = save(weights(coded, gains).withColumn("score", F.col("weight") + gumbel("id", seed)), "scored")
    enough = F.col("n_words") >= min_words
    order = [F.desc("score"), F.asc_nulls_last("id"), F.asc("n_features"), F.asc("weight")]
    drawn, n = ranked(scored.where(enough), order, "drawn")
    cut = percent * n // 100
    out = drawn.withColumn("rank", F.when(F.col("rank") <= cut, F.col("rank"))).unionByName(
        scored.where(~enough).withColumn("rank", F.lit(None).cast("long")))
    return out.withColumnRenamed("id", id_col).select(id_col, "n_words", "n_features", "weight", "score", "rank")
