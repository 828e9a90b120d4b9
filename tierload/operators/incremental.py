"""Incremental reads: batch state, batch filter, watermark filter/max.

The Silver state is derived from Silver itself (no state file): the
greatest ``(ingestion timestamp, batch_id)`` pair it holds.  The batch
filter on Bronze partition columns lands in ``PartitionFilters``, so
old partitions are never listed or read.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.literals import minus_seconds, ts_lit

STATE_DATE = "_source_ingestion_date"
STATE_BATCH = "_source_batch_id"
# A watermark read re-reads this many seconds before the
# stored high-water mark (late or clock-skewed rows).
DEFAULT_OVERLAP_SECONDS = 60


def state_metric(date_col: str = STATE_DATE, batch_col: str = STATE_BATCH) -> Column:
    """Aggregate giving ``struct(d, b)``: the max ingestion timestamp and
    the max batch id among rows at that timestamp (NULL when no row has a
    date).  Usable in ``agg`` and in ``observe``."""
    d = F.col(date_col).cast(T.TimestampNTZType())
    return F.max(F.when(d.isNotNull(), F.struct(d.alias("d"), F.col(batch_col).alias("b"))))


def batch_state(silver: DataFrame, date_col: str = STATE_DATE,
                batch_col: str = STATE_BATCH) -> DataFrame:
    """One row ``(ingestion_ts, batch_id)``: the max ingestion timestamp
    and the max batch id among rows at that timestamp; NULLs when
    ``silver`` is empty.  One aggregate instead of two queries."""
    return silver.agg(state_metric(date_col, batch_col).alias("s")).select(
        F.col("s.d").alias("ingestion_ts"), F.col("s.b").alias("batch_id"))


def read_state(silver: DataFrame, date_col: str = STATE_DATE,
               batch_col: str = STATE_BATCH) -> tuple | None:
    """The state as ``(date 'YYYY-MM-DD', batch_id)``, or ``None``."""
    row = batch_state(silver, date_col, batch_col).first()
    if row is None or row["ingestion_ts"] is None:
        return None
    return (row["ingestion_ts"].strftime("%Y-%m-%d"), row["batch_id"])


def _state_date(value) -> str:
    if isinstance(value, (_dt.date, _dt.datetime)):
        return value.strftime("%Y-%m-%d")
    return str(value)[:10]


def incremental_condition(state_date, state_batch, date_col: str = "ingestion_date",
                          batch_col: str = "batch_id") -> Column | None:
    """``date > d OR (date = d AND batch > b)``; ``None`` without state.

    A NULL batch id never compares true, so rows of the state date are
    skipped, as a textual ``'null'`` bound would do."""
    if state_date is None:
        return None
    d = F.lit(_state_date(state_date)).cast("date")
    day = F.col(date_col).cast("date")
    b = F.lit(state_batch).cast("string")
    return (day > d) | ((day == d) & (F.col(batch_col) > b))


def incremental_filter(df: DataFrame, state_date, state_batch,
                       date_col: str = "ingestion_date", batch_col: str = "batch_id") -> DataFrame:
    cond = incremental_condition(state_date, state_batch, date_col, batch_col)
    return df if cond is None else df.where(cond)


def watermark_filter(df: DataFrame, column: str, watermark,
                     overlap_seconds: float | None = DEFAULT_OVERLAP_SECONDS) -> DataFrame:
    """Rows with ``column >= watermark - overlap`` (inclusive).  No
    watermark means a full read.  ``overlap_seconds=None`` -> default 60;
    0 is honoured."""
    if watermark is None:
        return df
    overlap = DEFAULT_OVERLAP_SECONDS if overlap_seconds is None else overlap_seconds
    dtype = df.schema[column].dataType
    bound = minus_seconds(ts_lit(watermark, dtype), overlap)
    return df.where(F.col(column) >= bound)


def watermark_value(df: DataFrame, column: str) -> Column:
    """The column as a timestamp; text that is none counts as NULL."""
    c = F.col(column)
    if isinstance(df.schema[column].dataType, T.StringType):
        return c.try_cast(T.TimestampNTZType())
    return c.cast(T.TimestampNTZType())


def watermark_max(df: DataFrame, column: str, previous=None) -> DataFrame:
    """One row ``watermark``: max of the column (unparseable text and
    NULLs ignored), never below ``previous``."""
    c = F.col(column)
    if not isinstance(df.schema[column].dataType, (T.TimestampNTZType, T.TimestampType)):
        c = watermark_value(df, column)
    m = F.max(c)
    if previous is not None:
        m = F.greatest(m, ts_lit(previous, df.schema[column].dataType
                                 if isinstance(df.schema[column].dataType, T.TimestampType)
                                 else T.TimestampNTZType()))
    return df.agg(m.alias("watermark"))
