"""Tables written between steps, and id filters of fixed size."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierload.llm.text import mix
from tierload.session import new_run_dir


def save(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage: whatever executor is lost later, the written step is
    not computed again.
    """
    spark = df.sparkSession
    path = new_run_dir(spark, f"llm-{label}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(docs: DataFrame, text_col: str) -> int:
    """Bytes of all texts (one aggregate row)."""
    return docs.select(F.sum(F.octet_length(text_col))).first()[0] or 0


class IdFilter:
    """Bloom filter of 64-bit ids with a fixed size, whatever the number of ids.

    The bits are set by a Spark aggregate (bit_or per 64-bit word), so the
    driver receives at most ``bits / 64`` rows (8 MB at the default size).
    False positives only let more rows through to the join that follows;
    no id is lost.  A null id is never contained.
    """

    def __init__(self, ids: DataFrame, id_col: str, bits: int = 1 << 26) -> None:
        def set_bits(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            at = _bit_places(batch.column(0).drop_null().to_numpy(), bits)
            word, bit = at >> 6, np.uint64(1) << (at & 63).astype(np.uint64)
            order = np.argsort(word)
            word, bit = word[order], bit[order]
            first = np.flatnonzero(np.diff(word, prepend=-1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(word[first]), pa.array(np.bitwise_or.reduceat(bit, first).view(np.int64))] if len(first)
                else [pa.array([], pa.int64())] * 2, ["w", "b"])

        rows = arrow_map(ids.select(F.col(id_col).cast("long")), set_bits, "w long, b long")
        got = rows.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
        words = np.zeros(bits // 64, np.int64)
        words[got.column("w").to_numpy()] = got.column("b").to_numpy()
        self.bits, self.words = bits, ids.sparkSession.sparkContext.broadcast(words)

    def contains(self, ids: pa.Array) -> np.ndarray:
        """Mask of ids that may be in the filter (inside a task)."""
        known = pc.is_valid(ids).to_numpy(zero_copy_only=False)
        at = _bit_places(pc.fill_null(ids.cast(pa.int64()), 0).to_numpy(zero_copy_only=False), self.bits)
        found = (self.words.value[at >> 6] >> (at & 63)) & 1 > 0
        return found.reshape(2, -1).all(axis=0) & known


def _bit_places(ids: np.ndarray, bits: int) -> np.ndarray:
    """Two bit places per id, one after the other."""
    h = mix(ids.astype(np.int64).view(np.uint64))
    return np.concatenate([h & np.uint64(bits - 1), (h >> np.uint64(32)) & np.uint64(bits - 1)]).astype(np.int64)


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` of a function over single record batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from fn(batch)

    return df.mapInArrow(run, schema)


def worker_state(key: object, make: Callable[[], object]) -> object:
    """A value kept for as long as the Python worker lives (vocabularies, caches), made once per key."""
    store = sys.modules.setdefault("_tierload_worker_state", types.ModuleType("_tierload_worker_state")).__dict__
    if key not in store:
        store[key] = make()
    return store[key]


def document_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")

