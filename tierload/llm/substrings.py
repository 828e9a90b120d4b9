"""Substring dedup with a count-min prefilter.

A window is ``window`` consecutive words of one document.  A word goes
when a window over it also starts in a document with a smaller id.

1. *Sketch*: each task hashes its windows (once per document) and sends
   the hit counters, packed per counter block; one reducer per block adds
   them up.  Counters only overestimate, so the bit "2 or more" is set for
   every window that two documents share.  The merged bits (a fixed number
   of counters per window up to ``max_bits``) are broadcast: their size is
   bounded by that parameter, whatever the input.
2. *Exact pass*: only windows whose counters are all 2 or more are
   grouped.  A task first settles its own batch (the smallest document of
   each window in the batch is the only one still in doubt), so a window
   held by a third of all documents sends one row per batch; the ids that
   a batch has settled are never shuffled by window.
3. Windows to remove come back per document and meet the whole texts of
   those documents only (others pass by a Bloom filter of fixed size);
   every window is judged on the input text.

False positives of either filter cost time, never results.

Defined cases: null or empty texts and texts shorter than a window lose
nothing; repeated windows inside one document are no repeats; a null id
neither removes nor loses words; rows that repeat an id are judged each,
against smaller ids only; an empty table gives an empty result; only id
and text are read by ``repeated_windows``, and ``digest`` returns no other
columns, so names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierload.llm.common import IdFilter, arrow_map, save, text_bytes
from tierload.llm.text import Words, blocks, mix

WINDOW = 13
DEPTH = 2
BLOCK = 1 << 20          # counters per block
BYTES_PER_WINDOW = 6.5   # of text, about: sizes the sketch, not the result
COUNTERS_PER_WINDOW = 3  # per row of the sketch


class Shape:
    """Rows of counters; a counter index is (row, block, place)."""

    def __init__(self, windows: float, depth: int, max_bits: int) -> None:
        blocks = int(windows * COUNTERS_PER_WINDOW) // BLOCK + 1
        self.depth, self.blocks = depth, max(1, min(blocks, max_bits // (BLOCK * depth)))
        self.width = self.blocks * BLOCK

    def places(self, h: np.ndarray, row: int) -> np.ndarray:
        """Counter of each window hash in one row (multiply-shift over the top 32 bits)."""
        if row:
            h = mix(h + np.uint64(row * 0x9E3779B97F4A7C15 % (1 << 64)))
        return ((h >> np.uint64(32)) * np.uint64(self.width)) >> np.uint64(32) if self.width < 1 << 31 else h % np.uint64(self.width)


def document_windows(b: pa.RecordBatch, window: int) -> tuple[Words, np.ndarray, np.ndarray]:
    """(words, row, hash) of the distinct windows of each text."""
    w = Words(b.column("text"))
    at, h = w.windows(window)
    row = w.row[at]
    key = h ^ mix(row.astype(np.uint64))
    _, first = np.unique(key, return_index=True)
    return w, row[first], h[first]


def pack(places: np.ndarray) -> bytes:
    """Sorted places inside a block, as compressed 16-bit steps (0xFFFF: so far on and no hit)."""
    step = np.diff(places, prepend=0)
    far = step // 0xFFFF
    if far.any():
        out = np.full(len(step) + int(far.sum()), 0xFFFF, np.uint16)
        out[np.arange(len(step)) + np.cumsum(far)] = step - far * 0xFFFF
        step = out
    raw = step.astype(np.uint16)
    # low bytes then high bytes: the high ones are nearly all zero
    planes = np.concatenate([raw.astype(np.uint8), (raw >> 8).astype(np.uint8)])
    return len(raw).to_bytes(4, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(blob: bytes) -> np.ndarray:
    n = int.from_bytes(blob[:4], "little")
    planes = np.frombuffer(pa.decompress(blob[4:], 2 * n, codec="zstd", asbytes=True), np.uint8)
    step = planes[:n].astype(np.int64) | planes[n:].astype(np.int64) << 8
    return np.cumsum(step)[step != 0xFFFF]


def sketch(src: DataFrame, shape: Shape, window: int) -> dict[int, bytes]:
    """Merged bits "counter is 2 or more", packed per block of counters."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for b in blocks(batch, "text"):
                _, _, h = document_windows(b, window)
                held.append(h)
                size += len(h)
                if size >= 3_000_000:
                    yield packed(np.concatenate(held))
                    held, size = [], 0
        if size:
            yield packed(np.concatenate(held))

    def packed(h: np.ndarray) -> pa.RecordBatch:
        keys, blobs = [], []
        for row in range(shape.depth):
            p = np.sort(shape.places(h, row).astype(np.uint64))
            # more than two hits of one counter say no more than two
            third = np.zeros(len(p), bool)
            third[2:] = p[2:] == p[:-2]
            p = p[~third].astype(np.int64)
            cut = np.searchsorted(p, np.arange(shape.blocks + 1) * BLOCK)
            for k in np.flatnonzero(np.diff(cut)):
                keys.append(row * shape.blocks + int(k))
                blobs.append(pack(p[cut[k]:cut[k + 1]] - int(k) * BLOCK))
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(blobs, pa.binary())], ["block", "hits"])

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        count = np.zeros(BLOCK, np.uint8)
        for blob in table.column("hits"):
            p = unpack(blob.as_py())
            count[p] = np.minimum(count[p] + 1, 2)
            again = p[1:][p[1:] == p[:-1]]
            count[again] = 2
        bits = np.packbits(count >= 2)
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()),
                         "bits": pa.array([pa.compress(bits.tobytes(), codec="zstd", asbytes=True)], pa.binary())})

    merged = (src.mapInArrow(partial, "block long, hits binary")
              .groupBy("block").applyInArrow(merge, "block long, bits binary"))
    # at most max_bits / 8 bytes in all
    got = merged.toArrow()
    return dict(zip(got.column("block").to_pylist(), got.column("bits").to_pylist(), strict=True))


def suspects(src: DataFrame, shape: Shape, merged: dict[int, bytes], window: int) -> DataFrame:
    """One row per batch and window that may be in two documents: hash, smallest id, all other ids of the batch."""
    shared = src.sparkSession.sparkContext.broadcast(merged)
    size = BLOCK // 8

    def bits() -> np.ndarray:
        out = np.zeros(shape.depth * shape.blocks * size, np.uint8)
        for k, blob in shared.value.items():
            out[k * size:(k + 1) * size] = np.frombuffer(pa.decompress(blob, size, codec="zstd", asbytes=True), np.uint8)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None
        for batch in batches:
            table = bits() if table is None else table
            hashes, ids = [], []
            for b in blocks(batch, "text"):
                _, row, h = document_windows(b, window)
                for r in range(shape.depth):
                    p = shape.places(h, r).astype(np.int64) + r * shape.width
                    hot = (table[p >> 3] >> (7 - (p & 7)).astype(np.uint8)) & 1 > 0
                    row, h = row[hot], h[hot]
                hashes.append(h)
                ids.append(b.column("id").to_numpy()[row])
            h, i = np.concatenate(hashes), np.concatenate(ids)
            order = np.lexsort((i, h))
            h, i = h[order], i[order]
            new = np.ones(len(h), bool)
            new[1:] = h[1:] != h[:-1]
            later = np.flatnonzero(~new & np.append(False, i[1:] != i[:-1]))  # an id may repeat in the batch
            first = np.flatnonzero(new)
            group = np.cumsum(new) - 1
            cut = np.searchsorted(group[later], np.arange(len(first) + 1))
            for a in range(0, len(first), 200_000):
                z = min(a + 200_000, len(first))
                rest = pa.ListArray.from_arrays(pa.array((cut[a:z + 1] - cut[a]).astype(np.int32)),
                                                pa.array(i[later[cut[a]:cut[z]]]))
                yield pa.RecordBatch.from_arrays([pa.array(h[first[a:z]].view(np.int64)), pa.array(i[first[a:z]]), rest],
                                                 ["window", "least", "rest"])

    return src.mapInArrow(run, "window long, least long, rest array<long>")


def removals(rows: DataFrame) -> DataFrame:
    """(id, window) of every window that goes, from the written suspects.

    The other ids of a batch are decided already and go straight on; only
    (window, smallest id of a batch) is shuffled by window.
    """
    decided = rows.where(F.size("rest") > 0).select(F.explode("rest").alias("id"), "window")
    # one row per batch and window: the smallest id of all batches keeps it
    first = rows.select("window", "least").withColumn("all", F.min("least").over(Window.partitionBy("window")))
    return first.where(F.col("least") > F.col("all")).select(F.col("least").alias("id"), "window").unionAll(decided)


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                     depth: int = DEPTH, max_bits: int = 1 << 31) -> DataFrame:
    """(id, windows): per document, the packed hashes of its windows that a smaller id holds too."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    src = src.where(F.col("id").isNotNull() & F.col("text").isNotNull())
    shape = Shape(text_bytes(src, "text") / BYTES_PER_WINDOW, depth, max_bits)
    rows = save(suspects(src, shape, sketch(src, shape, window), window), "suspects")
    gone = removals(rows).repartition("id")

    def by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            held.append((b.column("window").to_numpy(), b.column("id").to_numpy()))
            size += b.num_rows
            if size >= 2_000_000:
                yield grouped(held)
                held, size = [], 0
        if size:
            yield grouped(held)

    def grouped(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        h, i = np.concatenate([a for a, _ in held]), np.concatenate([a for _, a in held])
        order = np.argsort(i, kind="stable")
        h, i = np.ascontiguousarray(h[order]), i[order]
        first = np.flatnonzero(np.append(True, i[1:] != i[:-1]))
        off = np.append(first, len(i)).astype(np.int64) * 8
        blobs = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(off), pa.py_buffer(h)])
        return pa.RecordBatch.from_arrays([pa.array(i[first]), blobs.cast(pa.binary())], ["id", "windows"])

    return gone.mapInArrow(by_document, "id long, windows binary")


def removed_words(texts: pa.Array, windows: list[np.ndarray | None], window: int) -> tuple[Words, np.ndarray]:
    """(words, mask of words under one of their text's given windows)."""
    w = Words(texts)
    at, h = w.windows(window)
    key = h ^ mix(w.row[at].astype(np.uint64))
    wanted = [x.view(np.uint64) ^ mix(np.array([r], np.uint64)) for r, x in enumerate(windows) if x is not None]
    begin = at[np.isin(key, np.concatenate(wanted))] if wanted else at[:0]
    gone = np.zeros(len(w.start) + window, bool)
    for j in range(window):
        gone[begin + j] = True
    return w, gone[:len(w.start)]


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
           max_bits: int = 1 << 31, with_text: bool = False) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256[, kept_text]) of every document."""
    windows = save(repeated_windows(docs, id_col, text_col, window, max_bits=max_bits), "windows")
    ids = IdFilter(windows, "id")
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    per_doc = windows.groupBy("id").agg(F.collect_list("windows").alias("windows"))
    hit = arrow_map(src, lambda b: iter([b.filter(pa.array(ids.contains(b.column("id"))))]), src.schema).join(per_doc, "id", "left")
    schema = f"id {kind}, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for b in blocks(batch, "text"):
            lists = b.column("windows").to_pylist() if "windows" in b.schema.names else [None] * b.num_rows
            wanted = [np.frombuffer(b"".join(x), np.int64) if x else None for x in lists]
            w, gone = removed_words(b.column("text"), wanted, window)
            shas, texts = [], []
            raw = w.data.tobytes()
            for r in range(b.num_rows):
                a, z = w.first[r], w.first[r + 1]
                keep = np.flatnonzero(~gone[a:z]) + a
                kept = b" ".join([raw[s:e] for s, e in zip(w.start[keep].tolist(), w.end[keep].tolist(), strict=True)])
                shas.append(hashlib.sha256(kept).hexdigest())
                if with_text:
                    texts.append(kept.decode())
            total = np.concatenate([[0], np.cumsum(gone)])
            lost = total[w.first[1:]] - total[w.first[:-1]]
            cols = [b.column("id"), pa.array(w.count.astype(np.int64)), pa.array(lost), pa.array(shas)]
            names = ["id", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                cols.append(pa.array(texts, pa.string()))
                names.append("kept_text")
            yield pa.RecordBatch.from_arrays(cols, names)

    def untouched(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        return run(batch.filter(pa.array(~ids.contains(batch.column("id")))))

    out = arrow_map(hit, run, schema).unionAll(arrow_map(src, untouched, schema))
    return out.withColumnRenamed("id", id_col)
