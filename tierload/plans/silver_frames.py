"""Bronze -> Silver as DataFrame plans (no writes).

These are the four load shapes; ``plans.silver`` decides which one
runs and writes the result through ``plans.tables``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DateValidation, SilverDataset
from ..operators.columns import BRONZE_PARTITIONS, lineage_columns, plan_exclusion
from ..operators.incremental import incremental_filter
from ..operators.latest import latest_per_key
from ..operators.merge import merge_latest
from ..operators.quality import date_anomaly_filter, date_columns


def retained_columns(bronze: DataFrame, ds: SilverDataset) -> list[str]:
    business = [c for c in bronze.columns if c not in BRONZE_PARTITIONS]
    return plan_exclusion(business, ds.exclude_columns).retained


def clean(bronze: DataFrame, validation: DateValidation, as_of=None) -> DataFrame:
    """Date-anomaly filter over every date column of Bronze (excluded
    ones included)."""
    return date_anomaly_filter(bronze, date_columns(bronze), validation.min_timestamp,
                               validation.max_years_from_today, as_of)


def initial_load(bronze: DataFrame, ds: SilverDataset, validation: DateValidation = DateValidation(),
                 as_of=None, run_ts=None) -> DataFrame:
    """Dedupe mode, first load: clean -> latest per key -> project -> lineage."""
    latest = latest_per_key(clean(bronze, validation, as_of), list(ds.pk), ds.cursor,
                            list(ds.tie_breakers))
    return lineage_columns(latest, retained_columns(bronze, ds), run_ts)


def append_load(bronze: DataFrame, ds: SilverDataset, validation: DateValidation = DateValidation(),
                state=None, as_of=None, run_ts=None) -> DataFrame:
    """Append mode: batch filter (when there is a state) -> clean ->
    project -> lineage; no dedupe."""
    src = bronze if state is None else incremental_filter(bronze, state[0], state[1])
    return lineage_columns(clean(src, validation, as_of), retained_columns(bronze, ds), run_ts)


def merge_source(bronze: DataFrame, ds: SilverDataset, validation: DateValidation = DateValidation(),
                 state=None, as_of=None) -> DataFrame:
    """The MERGE source: new batches, cleaned, one latest row per key,
    projected to the retained columns plus the Bronze lineage."""
    src = bronze if state is None else incremental_filter(bronze, state[0], state[1])
    latest = latest_per_key(clean(src, validation, as_of), list(ds.pk), ds.cursor,
                            list(ds.tie_breakers))
    return latest.select(*[F.col(f"`{c}`") for c in retained_columns(bronze, ds)],
                         "ingestion_date", "batch_id")


def merge_keys(bronze: DataFrame, ds: SilverDataset, validation: DateValidation = DateValidation(),
               state=None, as_of=None) -> DataFrame:
    """The keys of the MERGE source, not yet deduplicated: a narrow scan
    that tells which buckets the MERGE touches."""
    src = bronze if state is None else incremental_filter(bronze, state[0], state[1])
    return clean(src, validation, as_of).select(*ds.pk)


def merge_load(silver: DataFrame, bronze: DataFrame, ds: SilverDataset,
               validation: DateValidation = DateValidation(), state=None, as_of=None,
               run_ts=None, partitions: int | None = None) -> DataFrame:
    """Incremental MERGE: the next full version of ``silver``
    (``partitions``: Silver's bucket count, see ``merge_latest``)."""
    src = merge_source(bronze, ds, validation, state, as_of)
    return merge_latest(silver, src, list(ds.pk), ds.cursor, run_ts, source_is_latest=True,
                        partitions=partitions)
