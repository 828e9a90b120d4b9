"""Vectorised word helpers shared by the operators of this subpackage.

Everything works on whole Arrow string columns inside a task: a block of
texts is one byte buffer, and word boundaries, word hashes and window
hashes are numpy passes over it.  Blocks are cut by bytes (never inside
a text), so memory follows ``BLOCK_BYTES`` or the longest single text.

Words are runs of bytes outside a separator set.  UTF-8 continuation
bytes are all >= 0x80, so an ASCII separator set splits UTF-8 correctly.
Hashes are 64 bits wide and depend on the bytes only (same on every
machine, run and partitioning).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 2 << 20

#: separators of the word class [^\x20\x09-\x0D]+
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: separators of the word class [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ (after lower-casing)
NOT_ALNUM = np.zeros(256, dtype=bool)
for _a, _b in ((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)):
    NOT_ALNUM[_a:_b + 1] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_M1, _M2, _M3 = (np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_TAIL = np.array([0] + [(1 << (8 * i)) - 1 for i in range(1, 9)], dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * _M2
    h = (h ^ (h >> np.uint64(27))) * _M3
    return h ^ (h >> np.uint64(31))


class Words:
    """Words of a block of texts.

    ``data``: the bytes (lower-cased on request); ``offsets``: text
    boundaries in ``data``; ``start``/``end``: word boundaries; ``row``:
    the text of each word; ``first``: index of each text's first word
    (length texts + 1).
    """

    def __init__(self, texts: pa.Array, separators: np.ndarray = SPACE, lower: bool = False) -> None:
        offsets, data = utf8_buffers(texts)
        if lower:
            data = LOWER[data]
        self.data, self.offsets, n = data, offsets, len(data)
        word = ~separators[data]
        start, end = word.copy(), word.copy()
        start[1:] &= ~word[:-1]
        end[:-1] &= ~word[1:]
        cut = offsets[(offsets > 0) & (offsets < n)]
        start[cut], end[cut - 1] = word[cut], word[cut - 1]
        self.start, self.end = np.flatnonzero(start), np.flatnonzero(end) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)
        self.row = np.repeat(np.arange(len(offsets) - 1), self.count)
        self._hash: np.ndarray | None = None

    @property
    def hash(self) -> np.ndarray:
        if self._hash is None:
            self._hash = hash_spans(self.data, self.start, self.end)
        return self._hash

    def windows(self, q: int) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first word, hash) of every window of ``q`` consecutive words of one text."""
        return windows_of(self.hash, self.row, q)


def utf8_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column; null texts count as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "") if texts.null_count else texts
    texts = texts.cast(pa.large_string())
    _, off, data = texts.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], raw[offsets[0]:offsets[-1]]


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span, eight bytes a step."""
    size = (end - start).astype(np.int64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(shape=(len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    h = mix(size.astype(np.uint64) * _M1 + _M3)
    at, left, live = start, size, np.arange(len(start))
    while len(live):
        h[live] = mix((h[live] ^ (eight[at] & _TAIL[np.minimum(left, 8)])) * _M1)
        go = left > 8
        live, at, left = live[go], at[go] + 8, left[go] - 8
    return h


def take_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray, kind: pa.DataType) -> pa.Array:
    """The byte spans as an Arrow string or binary column."""
    size = end - start
    off = np.concatenate([[0], np.cumsum(size)])
    out = data[np.repeat(start - off[:-1], size) + np.arange(off[-1])]
    return pa.Array.from_buffers(kind, len(start), [None, pa.py_buffer(off.astype(np.int32)), pa.py_buffer(out)])


def windows_of(h: np.ndarray, row: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray]:
    n = len(h) - q + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(q):
        out *= _M1
        out += h[j:j + n]
    at = np.flatnonzero(row[:n] == row[q - 1:])
    return at, mix(out[at])


def blocks(batch: pa.RecordBatch, text: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Zero-copy slices of ``batch`` holding about ``limit`` text bytes each (one text at least)."""
    if not batch.num_rows:
        return
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
    begin = 0
    while begin < batch.num_rows:
        base = sizes[begin - 1] if begin else 0
        stop = max(begin + 1, int(np.searchsorted(sizes, base + limit, side="right")))
        yield batch.slice(begin, stop - begin)
        begin = stop

