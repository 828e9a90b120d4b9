"""Silver -> Gold as DataFrame plans (no writes): watermark read,
mapped projection, upsert, watermark store update."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ConfigError, GoldTable
from ..functions.literals import ts_lit
from ..operators.columns import map_columns
from ..operators.incremental import watermark_filter, watermark_max
from ..operators.merge import upsert

WATERMARK_SCHEMA = "source_table string, last_watermark timestamp_ntz, updated_at timestamp_ntz"


def gold_source(silver: DataFrame, table: GoldTable, watermark=None,
                overlap_seconds: float | None = None) -> DataFrame:
    """Mapped, typed rows to upsert: the watermark filter is applied on
    the Silver column before projection so it reaches the scan."""
    src = silver
    if table.watermark_enabled and watermark is not None:
        src = watermark_filter(silver, table.watermark_column, watermark, overlap_seconds)
    absent = [c.source for c in table.columns if c.source not in silver.columns]
    if absent:
        raise ConfigError(f"{table.source_table}: mapped source columns do not exist: {', '.join(absent)}")
    return map_columns(src, table.columns)


def gold_upsert(target: DataFrame, source: DataFrame, table: GoldTable,
                duplicates: str = "error", partitions: int | None = None) -> DataFrame:
    return upsert(target, source, list(table.primary_keys), duplicates=duplicates,
                  cursor=table.watermark_target, partitions=partitions)


def watermark_rows(entries: DataFrame, run_ts=None) -> DataFrame:
    """``(source_table, last_watermark)`` rows stamped with ``updated_at``."""
    stamp = ts_lit(run_ts) if run_ts is not None else F.localtimestamp()
    return entries.select(F.col("source_table").cast("string"),
                          F.col("last_watermark").cast("timestamp_ntz"),
                          stamp.alias("updated_at"))


def save_watermarks(store: DataFrame, entries: DataFrame, run_ts=None,
                    partitions: int | None = None) -> DataFrame:
    """Upsert new high-water marks into the store (key ``source_table``)."""
    return upsert(store, watermark_rows(entries, run_ts), ["source_table"], duplicates="error",
                  partitions=partitions)
