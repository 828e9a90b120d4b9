"""Crawl: list files -> datasets and partitions -> schema from one
sample file per dataset -> register tables and new partitions.

Listing, parsing and the per-dataset summary are distributed
DataFrame work; only the per-dataset summary rows (one per dataset)
come to the driver, where schema reads and DDL happen.  ``plan_only``
reports what would be registered and writes nothing.
"""

from __future__ import annotations

import json
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.identifiers import normalize_prefix_str
from ..session import new_run_dir
from ..sources.catalog import register_partitions, register_table, settle, settled, split_columns
from ..sources.footers import file_schemas
from ..sources.inventory import (FOLDER_KEY, INVENTORY_KEY, changed_files, changed_folders, folder_digests, folder_of,
                                 inventory_upsert, stamped)
from ..sources.ledger import LEDGER_KEY, LEDGER_SCHEMA, PartitionLedger
from ..sources.listing import list_files
from ..sources.paths import dataset_summary, distinct_partitions, parse_folders, parse_keys
from .tables import SnapshotTable

log = logging.getLogger(__name__)

SUMMARY_SCHEMA = ("dataset string, table_name string, n_files bigint, sample_file string, "
                  "n_columns int, partition_columns string, n_partitions bigint, action string, "
                  "partitions_created bigint, partitions_failed bigint, schema_source string")
LEDGER_TABLE = "partition_ledger"         # default name, in the tables' database


class NameCollision(ValueError):
    pass


def crawl(spark: SparkSession, root: str, prefix: str = "", database: str | None = None,
          plan_only: bool = False, inventory: str | None = None, run_ts=None,
          inventory_buckets: int | None = None, ledger: str | None = None) -> DataFrame:
    """Discover and register every dataset below ``root/prefix``; the file
    inventory (if named) is a keyed table on ``(dataset, key)`` with
    ``inventory_buckets`` buckets (default: the shuffle parallelism).
    ``ledger`` names the partition ledger (default: ``partition_ledger``
    in ``database``)."""
    base = root.rstrip("/")
    p = normalize_prefix_str(prefix)
    listing = list_files(spark, base, p).cache()
    folders = parse_folders(listing, "key", p).cache()   # reused by summary and partitions
    try:
        return _crawl(spark, base, folders, parse_keys(listing, "key", p), database, plan_only, inventory, run_ts, inventory_buckets,
                      PartitionLedger(spark, ledger or (f"{database}.{LEDGER_TABLE}" if database else LEDGER_TABLE)))
    finally:
        folders.unpersist()
        listing.unpersist()


def _crawl(spark, base, folders, parsed, database, plan_only, inventory, run_ts,
           inventory_buckets, ledger: PartitionLedger) -> DataFrame:
    summary = dataset_summary(folders).collect()       # one row per dataset
    names: dict[str, str] = {}
    for r in summary:
        other = names.setdefault(r["table_name"], r["dataset"])
        if other != r["dataset"]:
            raise NameCollision(f"datasets {other!r} and {r['dataset']!r} both map to table "
                                f"{r['table_name']!r}")
    inv = (SnapshotTable(spark, inventory, key=INVENTORY_KEY, buckets=inventory_buckets)
           if inventory else None)
    cache = _schema_cache(inv, parsed) if inv is not None and inv.exists() else {}
    partitions = distinct_partitions(folders).withColumn(
        "location", F.concat(F.lit(base + "/"), F.col("location")))
    known = ledger.read()
    # the sample footers that are not cached, in one job
    read = file_schemas(spark, {r["dataset"]: f"{base}/{r['sample_file']}" for r in summary
                                if (r["dataset"], r["sample_file"]) not in cache})
    out, schemas, tables = [], {}, {}
    for r in summary:
        dataset, table = r["dataset"], r["table_name"]
        qualified = f"{database}.{table}" if database else table
        layout = r["layout"].split(",") if r["layout"] else []
        sample = r["sample_file"]
        cached = cache.get((dataset, sample))
        schema = T.StructType.fromJson(json.loads(cached)) if cached else read[dataset]
        schemas[(dataset, sample)] = schema.json()
        columns = split_columns(schema, layout)
        row = dict(dataset=dataset, table_name=qualified, n_files=r["n_files"], sample_file=sample,
                   n_columns=len(columns.fields), partition_columns=",".join(layout),
                   n_partitions=r["n_partitions"], partitions_created=None,
                   partitions_failed=None, schema_source="cache" if cached else "file")
        if plan_only:
            row["action"] = "PLAN"
        else:
            location = f"{base}/{dataset}/"
            row["action"] = register_table(spark, qualified, location, columns, layout,
                                           known.where(F.col("dataset") == dataset))
            if layout:
                tables[dataset] = qualified, layout
        out.append(row)
    if tables:
        created, failed = _register_partitions(spark, ledger, partitions, tables)
        for row in out:
            if row["dataset"] in tables:
                row["partitions_created"] = created.get(row["dataset"], 0)
                row["partitions_failed"] = sum(d == row["dataset"] for d, _ in failed)
    out = [tuple(row[k.split()[0]] for k in SUMMARY_SCHEMA.split(", ")) for row in out]
    if inv is not None and not plan_only:
        _update_inventory(spark, inv, parsed, schemas, set(cache), run_ts)
    return spark.createDataFrame(out, SUMMARY_SCHEMA)


def _register_partitions(spark, ledger: PartitionLedger, partitions: DataFrame,
                         tables: dict[str, tuple[str, list[str]]]) -> tuple[dict, list]:
    """Register what the ledger does not have, of all datasets at once.

    A table that was just created, or whose registration was cut off,
    gets the ledger's partitions as well."""
    fresh = [d for d, (table, _) in tables.items() if not settled(spark, table)]
    path = new_run_dir(spark, "partitions")
    # written, so that what is registered is what the ledger gets
    ledger.missing(partitions).write.parquet(path)
    todo = new = spark.read.schema(LEDGER_SCHEMA).parquet(path)
    restored = bool(fresh) and ledger.table.exists()
    if restored:
        todo = new.unionByName(ledger.of(fresh))
    created, failed = register_partitions(spark, todo, tables)
    if not new.isEmpty():
        if failed:
            bad = spark.createDataFrame([(d, "/".join(v)) for d, v in failed], "dataset string, values_key string")
            new = new.join(bad, LEDGER_KEY, "left_anti")
        ledger.add(new)
    # a new partition that failed is missing from the ledger and tried again anyway
    bad = {d for d, _ in failed} if restored else set()
    for d in fresh:
        if d not in bad:
            settle(spark, tables[d][0])
    return created, failed


def _schema_cache(inv: SnapshotTable, parsed: DataFrame) -> dict:
    """Cached schemas of unchanged sample files (same length and mtime)."""
    current = parsed.select("dataset", "key", "length", "modification_time")
    hits = (inv.read().where(F.col("schema_json").isNotNull())
            .join(current, ["dataset", "key", "length", "modification_time"], "left_semi")
            .select("dataset", "key", "schema_json"))
    return {(r["dataset"], r["key"]): r["schema_json"] for r in hits.toLocalIterator()}


def _update_inventory(spark, inv: SnapshotTable, parsed: DataFrame, schemas: dict, known: set, run_ts) -> None:
    """Upsert the files of changed folders, and sample schemas that were
    read from a file; nothing is written when there are none."""
    entries = parsed.select("dataset", "key", "length", "modification_time")
    samples = spark.createDataFrame([(d, k, s) for (d, k), s in schemas.items()],
                                    "dataset string, key string, schema_json string")
    marks = SnapshotTable(spark, f"{inv.name}_folders")
    if not inv.exists():
        inv.write(stamped(entries.join(samples, INVENTORY_KEY, "left"), run_ts))
        marks.write(folder_digests(entries))
        return
    digests = folder_digests(entries)
    if marks.exists():
        path = new_run_dir(spark, "folders")
        changed_folders(digests, marks.read()).write.parquet(path)
        moved = spark.read.schema("dataset string, folder string").parquet(path)
    else:
        moved = digests.select(*FOLDER_KEY)
    same = moved.isEmpty()
    read = [(d, k) for d, k in schemas if (d, k) not in known]
    if same and not read:
        return
    suspects = entries.withColumn("folder", folder_of()).join(moved, FOLDER_KEY, "left_semi").drop("folder")
    current = inv.read(inv.touched_buckets(suspects.select(*INVENTORY_KEY)))
    changed = changed_files(suspects, current).join(samples, INVENTORY_KEY, "left")
    # sample files whose schema was read from the file get it recorded, changed or not
    fresh = entries.join(samples.join(spark.createDataFrame(read, "dataset string, key string"), INVENTORY_KEY), INVENTORY_KEY)
    upd = changed.unionByName(fresh).dropDuplicates(INVENTORY_KEY)
    # the upsert joins the bucketed inventory on its key: bucket-aligned output
    inv.merge(upd.select(*INVENTORY_KEY),
              lambda rows: inventory_upsert(rows, upd, run_ts, inv.join_partitions()))
    if not same:
        marks.write(digests)
