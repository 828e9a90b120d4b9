"""Typed literals and interval arithmetic used by the filters.

Timestamp literals take the type of the column they are compared
with (``timestamp_ntz`` vs ``timestamp``), so the comparison needs no
implicit cast and still reaches the Parquet scan as a pushed filter.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _text(value) -> str:
    if isinstance(value, _dt.datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, _dt.date):
        return value.isoformat()
    return str(value)


def ts_lit(value, dtype: T.DataType | None = None) -> Column:
    """A timestamp literal typed like ``dtype`` (default ``timestamp_ntz``)."""
    if isinstance(value, Column):
        return value
    target = dtype if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)) \
        else T.TimestampNTZType()
    return F.lit(_text(value)).cast(target)


def now_lit(as_of=None, dtype: T.DataType | None = None) -> Column:
    """``as_of`` as a literal, or the query's current time (folded once
    per query) when no fixed time is given."""
    if as_of is not None:
        return ts_lit(as_of, dtype)
    if isinstance(dtype, T.TimestampType):
        return F.current_timestamp()
    return F.localtimestamp()


def plus_years(ts: Column, years: int) -> Column:
    """``ts + n years`` keeping the time of day (29 Feb -> 28 Feb)."""
    return ts + F.make_ym_interval(F.lit(int(years)), F.lit(0))


def minus_seconds(ts: Column, seconds: int | float) -> Column:
    return ts - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(float(seconds)).cast("decimal(18,6)"))


def column_type(df, name: str) -> T.DataType:
    return df.schema[name].dataType
