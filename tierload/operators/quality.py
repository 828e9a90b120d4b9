"""Row-quality operators: date-anomaly filter, null profile, key check.

All are single-pass, built-in expressions: the anomaly filter is a
plain predicate that Catalyst rewrites into Parquet pushdown
(``IsNull OR (>= AND <=)``), the profile is one aggregate with
map-side partial counts, and the key check is one grouped count.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.literals import now_lit, plus_years, ts_lit
from ..functions.types import catalog_type, is_date_type

# Default validation window for date/timestamp columns.
DEFAULT_MIN_TIMESTAMP = "1950-01-01 00:00:00"
DEFAULT_MAX_YEARS_FROM_TODAY = 10


def date_columns(df: DataFrame) -> list[str]:
    """Names of every date/timestamp column (detected by type)."""
    return [f.name for f in df.schema.fields if is_date_type(f.dataType)]


def date_columns_frame(df: DataFrame) -> DataFrame:
    """``(column_name, data_type)`` of the date columns, as data."""
    rows = [(f.name, catalog_type(f.dataType)) for f in df.schema.fields
            if is_date_type(f.dataType)]
    spark = df.sparkSession
    return spark.createDataFrame(rows, "column_name string, data_type string")


def date_anomaly_condition(df: DataFrame, columns: list[str] | None = None,
                           min_timestamp: str = DEFAULT_MIN_TIMESTAMP,
                           max_years_from_today: int = DEFAULT_MAX_YEARS_FROM_TODAY,
                           as_of=None) -> Column | None:
    """Predicate that keeps a row when every listed date column is NULL
    or inside ``[min_timestamp, as_of + max_years]`` (both inclusive).

    ``columns`` defaults to every date column of ``df``; callers pass the
    full Bronze list even when some of those columns are later excluded
    from the output.  Returns ``None`` when there is no date column.
    """
    cols = date_columns(df) if columns is None else list(columns)
    if not cols:
        return None
    conds = []
    for name in cols:
        dtype = df.schema[name].dataType
        c = F.col(name)
        lo = ts_lit(min_timestamp, dtype)
        hi = plus_years(now_lit(as_of, dtype), max_years_from_today)
        conds.append(c.isNull() | ((c >= lo) & (c <= hi)))
    return reduce(lambda a, b: a & b, conds)


def date_anomaly_filter(df: DataFrame, columns: list[str] | None = None,
                        min_timestamp: str = DEFAULT_MIN_TIMESTAMP,
                        max_years_from_today: int = DEFAULT_MAX_YEARS_FROM_TODAY,
                        as_of=None) -> DataFrame:
    """Drop rows where ANY non-null date column is out of range."""
    cond = date_anomaly_condition(df, columns, min_timestamp, max_years_from_today, as_of)
    return df if cond is None else df.where(cond)


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: ``total_rows`` and ``<col>__nonnull`` for every column,
    all from a single scan."""
    cols = df.columns if columns is None else list(columns)
    return df.agg(F.count(F.lit(1)).alias("total_rows"),
                  *[F.count(F.col(c)).alias(f"{c}__nonnull") for c in cols])


def prune_null_columns(df: DataFrame, profile: dict | None = None,
                       keep: list[str] | tuple = ()) -> DataFrame:
    """Drop columns with no non-null value.

    ``profile`` maps column -> non-null count (as returned by
    :func:`null_counts`); it is computed with one aggregate when not
    given.  Columns in ``keep`` are never dropped.
    """
    counts = null_counts(df) if profile is None else profile
    return df.select([c for c in df.columns if c in keep or counts.get(c, 0) > 0])


def null_counts(df: DataFrame, columns: list[str] | None = None) -> dict:
    """Column -> non-null count (one single-row action)."""
    cols = df.columns if columns is None else list(columns)
    row = null_profile(df, cols).first()
    return {c: int(row[f"{c}__nonnull"]) for c in cols}


def key_violations(df: DataFrame, pk: list[str]) -> DataFrame:
    """Keys that break a primary-key constraint: any key column NULL
    (``null_key``) or more than one row per key (``duplicate``).

    One grouped count; partial aggregation runs map-side so a hot key
    is reduced before the shuffle.
    """
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in pk])
    counted = df.groupBy(*pk).agg(F.count(F.lit(1)).alias("n_rows"))
    return (counted
            .withColumn("kind", F.when(any_null, F.lit("null_key"))
                        .when(F.col("n_rows") > 1, F.lit("duplicate")))
            .where(F.col("kind").isNotNull()))


def key_is_bad(pk: list[str]) -> Column:
    """The row's key has a NULL or occurs more than once.  A window over the
    key: in front of a join on that key it shares the join's shuffle and sort."""
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in pk])
    return any_null | (F.count(F.lit(1)).over(Window.partitionBy(*pk)) > 1)


def assert_unique_keys(df: DataFrame, pk: list[str], what: str = "source") -> None:
    """Raise when ``df`` has NULL or duplicate keys (one action)."""
    bad = key_violations(df, pk).limit(5).collect()
    if bad:
        sample = ", ".join(str({k: r[k] for k in pk}) + f" x{r['n_rows']} ({r['kind']})"
                           for r in bad)
        raise ValueError(f"{what} has NULL or duplicate primary keys {pk}: {sample}")
