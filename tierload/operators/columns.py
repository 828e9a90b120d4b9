"""Projections: column exclusion, lineage columns, mapped/typed select."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.literals import ts_lit
from ..functions.types import parse_type

LINEAGE_COLUMNS = ("_source_ingestion_date", "_source_batch_id", "_silver_loaded_at")
BRONZE_PARTITIONS = ("ingestion_date", "batch_id")


@dataclass(frozen=True)
class Exclusion:
    retained: list
    found: list
    not_found: list


def plan_exclusion(columns: list[str], exclude: list[str] | tuple) -> Exclusion:
    """Case-insensitive split of ``columns`` by an exclusion list;
    configured names matching nothing are reported, not fatal."""
    excluded = {e.lower() for e in exclude}
    lower_cols = {c.lower() for c in columns}
    return Exclusion(
        retained=[c for c in columns if c.lower() not in excluded],
        found=[c for c in columns if c.lower() in excluded],
        not_found=[e for e in exclude if e.lower() not in lower_cols],
    )


def exclude_columns(df: DataFrame, exclude: list[str] | tuple) -> DataFrame:
    """``df`` without the excluded columns (case-insensitive)."""
    plan = plan_exclusion(df.columns, exclude)
    return df.select(*[F.col(f"`{c}`") for c in plan.retained])


def lineage_columns(df: DataFrame, columns: list[str] | None = None, run_ts=None,
                    date_col: str = "ingestion_date", batch_col: str = "batch_id") -> DataFrame:
    """Business columns plus ``_source_ingestion_date``,
    ``_source_batch_id`` (copied from the Bronze partition columns) and
    ``_silver_loaded_at`` (the run's timestamp, one literal per run)."""
    business = [c for c in (columns if columns is not None else df.columns)
                if c not in BRONZE_PARTITIONS]
    loaded = ts_lit(run_ts) if run_ts is not None else F.localtimestamp()
    return df.select(*[F.col(f"`{c}`") for c in business],
                     F.col(date_col).alias("_source_ingestion_date"),
                     F.col(batch_col).alias("_source_batch_id"),
                     loaded.alias("_silver_loaded_at"))


@dataclass(frozen=True)
class ColumnMap:
    source: str
    target: str
    type: str

    @property
    def data_type(self) -> T.DataType:
        return parse_type(self.type)


def as_column_maps(mapping) -> list[ColumnMap]:
    return [m if isinstance(m, ColumnMap) else
            ColumnMap(**m) if isinstance(m, dict) else ColumnMap(*m) for m in mapping]


def map_columns(df: DataFrame, mapping) -> DataFrame:
    """Select each ``source`` cast to its declared type as ``target``.

    A source column that does not exist becomes a typed NULL; ``0``,
    ``false`` and ``''`` are values, only NULL stays NULL.  The cast is
    ANSI: text that does not convert raises, as the target database
    would on insert."""
    present = set(df.columns)
    out = []
    for m in as_column_maps(mapping):
        src = F.col(f"`{m.source}`") if m.source in present else F.lit(None)
        out.append(src.cast(m.data_type).alias(m.target))
    return df.select(*out)
