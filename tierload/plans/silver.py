"""Bronze -> Silver loader: choose the load shape per dataset, evolve
the schema, write a new table version, report a summary.

Per dataset: confirmation gate -> table exists? (rebuild = treat as
absent; the new version replaces the old one atomically, nothing is
deleted first) -> initial load, or schema evolution + state + MERGE /
append.  A failing dataset is reported and the others still run.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import ConfigError, DateValidation, SilverDataset
from ..operators.columns import BRONZE_PARTITIONS, plan_exclusion
from ..operators.schema_ops import find_missing_columns
from . import silver_frames as sf
from .tables import COMMIT_ATTEMPTS, ConcurrentCommit, SnapshotTable

log = logging.getLogger(__name__)

SUMMARY_SCHEMA = ("dataset string, mode string, operation string, status string, "
                  "rows_written bigint, state_date string, state_batch string")


@dataclass
class SilverLoad:
    spark: SparkSession
    bronze: Callable[[str], DataFrame]          # dataset name -> Bronze DataFrame
    validation: DateValidation = DateValidation()
    table_prefix: str = "silver_"
    buckets: int | None = None
    as_of: object = None
    run_ts: object = None
    keep_versions: int | None = None            # registered versions left after a load

    def table(self, ds: SilverDataset) -> SnapshotTable:
        key = list(ds.pk) if ds.mode == "dedupe_latest" else None
        return SnapshotTable(self.spark, f"{self.table_prefix}{ds.name}", key=key,
                             buckets=self.buckets)

    def plan(self, ds: SilverDataset, rebuild: bool = False):
        """``(operation, frame, table, state, missing_columns)`` without
        writing anything (state is read: it is needed for the plan)."""
        bronze = self.bronze(ds.name)
        missing_lineage = [c for c in BRONZE_PARTITIONS if c not in bronze.columns]
        if missing_lineage:
            raise ConfigError(f"{ds.name}: Bronze has no {', '.join(missing_lineage)} column(s); "
                              f"Bronze tables are partitioned by {', '.join(BRONZE_PARTITIONS)}")
        excl = plan_exclusion([c for c in bronze.columns if c not in BRONZE_PARTITIONS],
                              ds.exclude_columns)
        if excl.not_found:
            log.warning("%s: excluded columns not in the Bronze schema: %s", ds.name,
                        ", ".join(excl.not_found))
        table = self.table(ds)
        exists = table.exists() and not rebuild
        if not exists:
            frame = (sf.initial_load(bronze, ds, self.validation, self.as_of, self.run_ts)
                     if ds.mode == "dedupe_latest" else
                     sf.append_load(bronze, ds, self.validation, None, self.as_of, self.run_ts))
            return "INITIAL LOAD", frame, table, None, []
        retained = bronze.select(*[F.col(f"`{c}`") for c in sf.retained_columns(bronze, ds)]).schema
        missing = find_missing_columns(retained, table.schema)
        current = table.read()
        state = table.state()          # stored with the version: no Silver scan
        if ds.mode == "dedupe_latest":
            frame = sf.merge_load(current, bronze, ds, self.validation, state, self.as_of,
                                  self.run_ts, partitions=table.join_partitions())
        else:
            frame = sf.append_load(bronze, ds, self.validation, state, self.as_of, self.run_ts)
        return "INCREMENTAL UPDATE", frame, table, state, missing

    def run_one(self, ds: SilverDataset, plan_only: bool = False, rebuild: bool = False) -> tuple:
        op, frame, table, state, missing = self.plan(ds, rebuild)
        st = (state or (None, None))
        if plan_only:
            return (ds.name, ds.mode, op, f"PLAN ({op})", None, st[0], st[1])
        if missing:
            table.add_columns(missing)
            if ds.mode == "dedupe_latest":      # re-plan against the evolved table
                op, frame, table, state, _ = self.plan(ds, rebuild)
        if op == "INCREMENTAL UPDATE" and ds.mode == "dedupe_latest":
            bronze = self.bronze(ds.name)
            rows = table.merge(
                sf.merge_keys(bronze, ds, self.validation, state, self.as_of),
                lambda current: sf.merge_load(current, bronze, ds, self.validation, state, self.as_of, self.run_ts,
                                              partitions=table.join_partitions())).rows
        elif op == "INCREMENTAL UPDATE":
            rows = self._append(ds, table)
        else:
            obs = Observation(f"silver_{ds.name}")
            table.write(frame.observe(obs, F.count(F.lit(1)).alias("rows")), aligned=self._aligned(ds, table))
            rows = obs.get.get("rows", 0)
        if self.keep_versions is not None:
            table.drop_old_versions(self.keep_versions)
        return (ds.name, ds.mode, op, f"OK ({op})", rows, st[0], st[1])

    def _append(self, ds: SilverDataset, table: SnapshotTable) -> int:
        """Append the batches after the table's state; computed again when
        another run committed meanwhile, as it may have loaded the same."""
        for attempt in range(1, COMMIT_ATTEMPTS + 1):
            base = table.current_version()
            frame = sf.append_load(self.bronze(ds.name), ds, self.validation, table.state(base), self.as_of, self.run_ts)
            obs = Observation(f"silver_{ds.name}")
            try:
                table.append(frame.observe(obs, F.count(F.lit(1)).alias("rows")), base=base)
                return obs.get.get("rows", 0)
            except ConcurrentCommit as e:
                if attempt == COMMIT_ATTEMPTS:
                    raise
                log.warning("%s; loading again", e)
        raise AssertionError

    def _aligned(self, ds: SilverDataset, table: SnapshotTable) -> bool:
        """Does the initial load's plan already hold one bucket per task?

        A dedupe initial load comes out of the latest-row window, whose
        exchange hash-partitions by the key into
        ``spark.sql.shuffle.partitions`` -- the bucket layout itself when
        the counts are equal (AQE only merges whole partitions).  Only the
        number of files depends on this, never the result."""
        shuffle = int(self.spark.conf.get("spark.sql.shuffle.partitions", "200"))
        return ds.mode == "dedupe_latest" and table.effective_buckets() == shuffle

    def run(self, datasets: list[SilverDataset], plan_only: bool = False, rebuild: bool = False,
            confirm: bool = False) -> DataFrame:
        """Load every dataset; one summary row each (errors isolated)."""
        out = []
        for ds in datasets:
            if ds.requires_confirmation and not confirm:
                note = f": {ds.note}" if ds.note else ""
                out.append((ds.name, ds.mode, None, f"SKIPPED (requires confirmation){note}",
                            None, None, None))
                continue
            try:
                out.append(self.run_one(ds, plan_only, rebuild))
            except Exception as e:  # isolate the failure, keep loading others
                log.exception("dataset %s failed", ds.name)
                out.append((ds.name, ds.mode, None, f"ERROR: {type(e).__name__}: {e}",
                            None, None, None))
        return self.spark.createDataFrame(out, SUMMARY_SCHEMA)


def load_silver(spark: SparkSession, bronze: Callable[[str], DataFrame],
                datasets: list[SilverDataset], validation: DateValidation = DateValidation(),
                plan_only: bool = False, rebuild: bool = False, confirm: bool = False,
                as_of=None, run_ts=None, table_prefix: str = "silver_",
                buckets: int | None = None, only: str | None = None,
                keep_versions: int | None = None) -> DataFrame:
    """Run the Bronze -> Silver load; ``only`` restricts it to one
    configured dataset (an unknown name is an error).  After a load,
    ``keep_versions`` unregisters all but a table's newest ones (default:
    all stay)."""
    if only is not None:
        datasets = [d for d in datasets if d.name == only]
        if not datasets:
            raise ConfigError(f"no dataset named {only!r} is configured")
    loader = SilverLoad(spark, bronze, validation, table_prefix, buckets, as_of, run_ts, keep_versions)
    return loader.run(datasets, plan_only, rebuild, confirm)


def any_failed(summary: DataFrame) -> bool:
    """True when a dataset failed (for a non-zero exit status)."""
    return summary.where(F.col("status").startswith("ERROR")).limit(1).count() > 0
