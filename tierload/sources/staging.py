"""Staging CSV lines for a bulk COPY into a relational target.

Every value is quoted with ``"`` doubled inside; NULL is a bare ``\\N``
(so it is distinct from the empty string ``""``).  Spark's CSV writer
with ``quoteAll`` would quote the NULL marker too, so the line is
built as a column and written with the text source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Staging CSV format.
NULL_MARKER = "\\N"
QUOTE = '"'


def csv_value(c: Column) -> Column:
    text = c.cast("string")
    quoted = F.concat(F.lit(QUOTE), F.replace(text, F.lit(QUOTE), F.lit(QUOTE * 2)), F.lit(QUOTE))
    return F.coalesce(quoted, F.lit(NULL_MARKER))


def staging_line(df: DataFrame, columns: list[str] | None = None) -> Column:
    cols = df.columns if columns is None else columns
    return F.concat_ws(",", *[csv_value(F.col(f"`{c}`")) for c in cols])


def staging_csv(df: DataFrame, columns: list[str] | None = None, keep: list[str] | tuple = ()) -> DataFrame:
    """``keep`` columns plus ``line``: one CSV record per row."""
    return df.select(*keep, staging_line(df, columns).alias("line"))


def write_staging(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """Write the staging records as text files (one record per row;
    quoted values may contain newlines, as CSV allows)."""
    df.select(staging_line(df, columns).alias("value")).write.mode("errorifexists").text(path)
