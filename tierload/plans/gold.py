"""Silver -> Gold loader: guarded schema, watermark-incremental read,
typed mapping, keyed upsert, watermark saved last.

With a ``jdbc`` target, each run's slice is also upserted into the
relational table (staging + one MERGE) before the watermark moves.
The watermark store is itself a small keyed table upserted after the
data version is published, so a failure before that point re-reads
the same slice next time (the upsert is idempotent).  The new
high-water mark and the number of NULL or repeated keys are observed while
the data is written; only the slice's keys are read once more, to tell
which buckets the upsert rewrites.  A version with such keys is dropped
before it is published, and the table's load fails.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import (ConfigError, GoldSettings, GoldTable, safe_batch_size,
                      validate_gold_config)
from ..functions.types import catalog_type
from ..operators.incremental import watermark_value
from ..operators.quality import assert_unique_keys, key_is_bad
from ..operators.schema_ops import guard, schema_diff
from .gold_frames import WATERMARK_SCHEMA, gold_source, gold_upsert, save_watermarks
from .tables import SnapshotTable

log = logging.getLogger(__name__)

SUMMARY_SCHEMA = ("source_table string, target_table string, status string, rows_upserted bigint, "
                  "previous_watermark timestamp_ntz, new_watermark timestamp_ntz, batch_size int")


BAD_KEY = "__bad_key"


def checked_source(src: DataFrame, pk: list[str], partitions: int | None) -> DataFrame:
    """``src`` dealt by key for the merge, each row marked when its key is
    NULL or repeated: the check needs no scan or shuffle of its own."""
    if partitions:
        src = src.repartition(partitions, *[F.col(k) for k in pk])
    return src.withColumn(BAD_KEY, key_is_bad(pk))


def empty_frame(spark: SparkSession, table: GoldTable) -> DataFrame:
    schema = T.StructType([T.StructField(c.target, c.data_type) for c in table.columns])
    return spark.createDataFrame([], schema)


@dataclass
class GoldLoad:
    spark: SparkSession
    silver: Callable[[str], DataFrame]           # source table name -> Silver DataFrame
    settings: GoldSettings = GoldSettings()
    table_prefix: str = "gold_"
    watermark_table: str = "gold_watermarks"
    buckets: int | None = None
    run_ts: object = None
    jdbc: object = None                          # optional sources.jdbc.JdbcTarget
    run_id: str | None = None                    # names this run there: a retry is skipped
    keep_versions: int | None = None             # registered versions left after a load

    def target(self, t: GoldTable) -> SnapshotTable:
        return SnapshotTable(self.spark, f"{self.table_prefix}{t.target_table}",
                             key=list(t.primary_keys), buckets=self.buckets)

    def store(self) -> SnapshotTable:
        return SnapshotTable(self.spark, self.watermark_table, key=["source_table"], buckets=1)

    def ensure_store(self) -> SnapshotTable:
        s = self.store()
        if not s.exists():
            s.write(self.spark.createDataFrame([], WATERMARK_SCHEMA))
        return s

    def previous_watermark(self, t: GoldTable):
        if not t.watermark_enabled:
            return None
        row = (self.ensure_store().read().where(F.col("source_table") == t.source_table)
               .select("last_watermark").first())
        return row["last_watermark"] if row else None

    def ensure_table(self, t: GoldTable) -> SnapshotTable:
        """Create when absent; refuse key/type changes; add new columns."""
        target = self.target(t)
        if not target.exists():
            target.write(empty_frame(self.spark, t))
            return target
        existing = [(f.name, catalog_type(f.dataType)) for f in target.schema.fields]
        configured = [(c.target, catalog_type(c.data_type)) for c in t.columns]
        diff = schema_diff(configured, list(t.primary_keys), existing, target.stored_key())
        to_add = guard(diff, target.name, list(t.primary_keys), target.stored_key())
        types = {c.target: c.data_type for c in t.columns}
        target.add_columns([T.StructField(n, types[n]) for n, _ in to_add])
        return target

    def run_one(self, t: GoldTable) -> tuple:
        target = self.ensure_table(t)
        batch = safe_batch_size(self.settings.batch_size, len(t.columns))
        prev = self.previous_watermark(t)
        silver = self.silver(t.source_table)
        src = gold_source(silver, t, prev, self.settings.watermark_overlap_seconds)
        pk = list(t.primary_keys)
        obs = Observation(f"gold_{t.target_table}")
        metrics = [F.count(F.lit(1)).alias("rows"), F.count_if(BAD_KEY).alias("bad")]
        if t.watermark_enabled:
            metrics.append(F.max(watermark_value(src, t.watermark_target)).alias("wm"))
        checked = checked_source(src, pk, target.join_partitions()).observe(obs, *metrics).drop(BAD_KEY)

        def check() -> None:
            if obs.get["bad"]:                   # only then the slice is read again, for the message
                assert_unique_keys(src, pk, f"{t.source_table} slice")

        target.merge(src.select(*pk), lambda current: gold_upsert(current, checked, t, duplicates="trust"), check=check)
        m = obs.get
        if self.jdbc is not None:                # relational copy: staging + one MERGE
            self.jdbc.upsert(src, t.target_table, list(t.primary_keys),
                             batch_size=self.settings.batch_size,
                             run_id=self.run_id and f"{self.run_id}:{t.target_table}")
        new_wm = prev
        if t.watermark_enabled and m.get("wm") is not None:
            new_wm = m["wm"] if prev is None or m["wm"] > prev else prev
            store = self.store()
            entry = self.spark.createDataFrame([(t.source_table, new_wm)],
                                               "source_table string, last_watermark timestamp_ntz")
            store.merge(entry.select("source_table"), lambda current: save_watermarks(
                current, entry, self.run_ts, partitions=store.join_partitions()))
        if self.keep_versions is not None:
            target.drop_old_versions(self.keep_versions)
        return (t.source_table, t.target_table, "OK", m.get("rows"), prev, new_wm, batch)

    def run(self, tables: list[GoldTable]) -> DataFrame:
        validate_gold_config(self.settings, tables)
        out = []
        for t in tables:
            try:
                out.append(self.run_one(t))
            except Exception as e:
                log.exception("table %s failed", t.target_table)
                out.append((t.source_table, t.target_table,
                            f"ERROR: {type(e).__name__}: {e}", None, None, None, None))
        return self.spark.createDataFrame(out, SUMMARY_SCHEMA)


def load_gold(spark: SparkSession, silver: Callable[[str], DataFrame], tables: list[GoldTable],
              settings: GoldSettings = GoldSettings(), table_prefix: str = "gold_",
              watermark_table: str = "gold_watermarks", buckets: int | None = None,
              run_ts=None, jdbc=None, only: str | None = None, run_id: str | None = None,
              keep_versions: int | None = None) -> DataFrame:
    """Run the Silver -> Gold load; ``only`` selects one configured table
    by source or target name (an unknown name is an error).  After a load,
    ``keep_versions`` unregisters all but a table's newest ones (default:
    all stay)."""
    if only is not None:
        tables = [t for t in tables if only in (t.source_table, t.target_table)]
        if not tables:
            raise ConfigError(f"no table named {only!r} is configured")
    return GoldLoad(spark, silver, settings, table_prefix, watermark_table, buckets,
                    run_ts, jdbc, run_id, keep_versions).run(tables)
