"""Soft delete in a keyed table by digest reconciliation.

The digest of a bucket's live keys is kept per bucket folder.  Folders
never change once written and are shared by the versions, so a run
digests only the buckets that were rewritten since the last one, compares
them with the source's digests and reads only the buckets that differ.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.merge import reconcile_missing_keys, upsert_overwrite
from ..operators.reconcile import BUCKET, DIGEST, any_null, differing_buckets, key_digests, same_key_types
from ..session import new_run_dir
from .tables import SnapshotTable

log = logging.getLogger(__name__)


def _live(rows: DataFrame, flag: str) -> DataFrame:
    return rows.where(~F.coalesce(F.col(flag), F.lit(False)))


def bucket_digests(table: SnapshotTable, flag: str, version: str) -> DataFrame:
    """``key_digests`` of the live keys of every bucket of a version, kept
    in ``<table>__digests`` by folder; only new folders are read."""
    spark = table.spark
    folders = table.bucket_folders(version)          # one per bucket
    now = spark.createDataFrame([(b, f, flag) for b, f in folders.items()],
                                f"{BUCKET} int, folder string, flag string")
    kept = SnapshotTable(spark, f"{table.name}__digests")
    known = set()
    if kept.exists():
        known = {r["folder"] for r in kept.read().join(now, ["folder", "flag"], "left_semi").select("folder").collect()}
    todo = [b for b, f in folders.items() if f not in known]
    log.info("%s: %d of %d buckets are digested", table.name, len(todo), len(folders))
    if todo:
        got = key_digests(_live(table.read(todo, version), flag), table.key, table.stored_buckets())
        # a bucket without live keys has an empty digest of its own
        fresh = now.where(F.col(BUCKET).isin(todo)).join(got, BUCKET, "left").na.fill(0, [*DIGEST, "n_null"]).select(
            "folder", "flag", *DIGEST, "n_null")
        if kept.exists():
            kept.append(fresh)
        else:
            kept.write(fresh)
    # a run that was cut off may have left a folder's digest twice
    return kept.read().join(now, ["folder", "flag"]).select(BUCKET, *DIGEST, "n_null").distinct()


def reconcile_table(table: SnapshotTable, source_keys: DataFrame, flag: str = "is_deleted") -> list[int] | None:
    """Flag the rows of a keyed table whose key is not among
    ``source_keys`` (all keys upstream), and unflag those that came back.

    Buckets with equal digests are not read; of the others only those in
    which a flag changes are rewritten, and without a change no version is
    written.  Returns the buckets that were compared key by key (``None``:
    all of them, as the buckets could not be told).  A row whose key has a
    NULL matches nothing and is flagged."""
    pk = list(table.key)
    if flag not in table.read().columns:
        table.add_columns([T.StructField(flag, T.BooleanType())])
    version, buckets = table.current_version(), table.stored_buckets()
    rows = table.read(version=version)
    compared = None
    if buckets and same_key_types(rows, source_keys, pk) and table.touched_buckets(rows.select(*pk).limit(0)) is not None:
        source = key_digests(source_keys, pk, buckets)
        compared = sorted(r[BUCKET] for r in differing_buckets(bucket_digests(table, flag, version), source).collect())
        if not compared:
            return compared
        source_keys = source_keys.where(table._bucket(buckets).isin(compared))
        rows = table.read(compared, version)
    checked = reconcile_missing_keys(rows.select(*pk, F.coalesce(F.col(flag), F.lit(False)).alias("__before")),
                                     source_keys, pk, flag)
    path = new_run_dir(table.spark, "reconcile")
    checked.where(F.col(flag) != F.col("__before")).select(*pk, flag).write.parquet(path)
    changes = table.spark.read.schema(checked.select(*pk, flag).schema).parquet(path)
    if changes.isEmpty():
        return compared
    keyed = changes.where(~any_null(pk))

    def merged(current: DataFrame) -> DataFrame:
        out = upsert_overwrite(current, keyed, pk, table.join_partitions())
        return out.withColumn(flag, F.coalesce(F.when(any_null(pk), True), F.col(flag), F.lit(False)))

    table.merge(changes.select(*pk), merged)
    return compared
