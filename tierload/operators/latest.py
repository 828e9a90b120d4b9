"""Latest row per key (top-1 per group).

``row_number()`` over the key, ordered by cursor DESC NULLS LAST and
then by Bronze lineage, filtered to ``rn = 1``.  Spark inserts a
partial ``WindowGroupLimit`` before the shuffle, so every map task
sends at most one row per key: a key that holds a third of all rows
costs one row per input split in the exchange, not a third of the
data in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LINEAGE_DATE = "ingestion_date"
LINEAGE_BATCH = "batch_id"


def _order_col(c: Column | str) -> Column:
    # bare names are tie-breakers: highest first
    return F.col(c).desc() if isinstance(c, str) else c


def latest_order(df: DataFrame, cursor: str,
                 tie_breakers: list[Column | str] | tuple = ()) -> list[Column]:
    """Ordering for the latest-row rule.

    cursor DESC NULLS LAST, then ``cast(ingestion_date as date)`` DESC and
    ``batch_id`` DESC when those Bronze lineage columns are present,
    then the caller's tie-breakers (bare names sort DESC)."""
    order = [F.col(cursor).desc_nulls_last()]
    if LINEAGE_DATE in df.columns:
        order.append(F.col(LINEAGE_DATE).cast("date").desc())
    if LINEAGE_BATCH in df.columns:
        order.append(F.col(LINEAGE_BATCH).desc())
    order.extend(_order_col(c) for c in tie_breakers)
    return order


def latest_per_key(df: DataFrame, pk: list[str], cursor: str,
                   tie_breakers: list[Column | str] | tuple = ()) -> DataFrame:
    """Keep one row per ``pk``: the one first in :func:`latest_order`."""
    w = Window.partitionBy(*[F.col(k) for k in pk]).orderBy(*latest_order(df, cursor, tie_breakers))
    return (df.withColumn("__rn", F.row_number().over(w))
              .where(F.col("__rn") == 1)
              .drop("__rn"))
