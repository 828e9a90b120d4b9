"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of the survey inventory, each reading the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixtures as fx
from .config import DateValidation, GoldSettings, GoldTable, SilverDataset
from .functions import (catalog_type, normalize_prefix, sanitize_identifier, strip_prefix, ts_lit,
                        type_compatible)
from .operators import (ColumnMap, add_missing_columns, batch_state, date_anomaly_filter,
                        date_columns_frame, exclude_columns, incremental_filter, key_violations,
                        latest_per_key, lineage_columns, map_columns, merge_outcome, null_profile,
                        prune_null_columns, read_state, reconcile_by_digest,
                        reconcile_missing_keys, schema_diff,
                        schema_diff_frame, schema_pairs, upsert, watermark_filter, watermark_max)
from .plans import silver_frames as sf
from .plans.crawl import crawl
from .plans.flagship import flagship
from .plans.gold import GoldLoad
from .plans.gold_frames import gold_source, gold_upsert, save_watermarks, watermark_rows
from .plans.reconcile import reconcile_table
from .plans.silver import load_silver
from .plans.tables import SnapshotTable
from .session import new_run_dir
from .sources.catalog import show_partitions
from .sources.footers import footer_null_profile
from .sources.inventory import changed_files, changed_folders, folder_digests, inventory_upsert
from .sources.listing import bronze_scan, list_files
from .sources.paths import (dataset_summary, distinct_partitions, flatten, new_partitions,
                            parse_folders, parse_keys, partition_layout_check)
from .sources.schema import infer_schema, table_columns
from .sources.staging import staging_csv
from .streaming.bronze_stream import stream_silver

EVENTS_DATASET = SilverDataset(
    name="events", pk=fx.EVENTS_PK, cursor=fx.EVENTS_CURSOR, mode="dedupe_latest",
    exclude_columns=("Valid_TS", "not_a_column"), tie_breakers=fx.EVENTS_TIE)
EVENTS_APPEND = SilverDataset(
    name="events_log", pk=fx.EVENTS_PK, cursor=fx.EVENTS_CURSOR, mode="append_only",
    exclude_columns=("Valid_TS",))
VALIDATION = DateValidation(fx.MIN_TS, fx.MAX_YEARS)
# Bucket count of the keyed tables the writer queries create: sized for
# the fixtures (the library default follows spark.sql.shuffle.partitions).
FIXTURE_BUCKETS = 8

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _bronze(spark, sf_dir):
    return fx.bronze_events(spark, sf_dir)


def _split_target(spark, sf_dir, ds=EVENTS_DATASET):
    """Silver after loading Bronze up to the split date."""
    b = _bronze(spark, sf_dir).where(F.col("ingestion_date") <= fx.SPLIT_DATE)
    return sf.initial_load(b, ds, VALIDATION, fx.AS_OF, fx.RUN_TS_1)


# --------------------------------------------------------------- filters

@query("date_anomaly_filter")
def q_date_anomaly_filter(spark, sf_dir):
    return date_anomaly_filter(_bronze(spark, sf_dir), None, fx.MIN_TS, fx.MAX_YEARS, fx.AS_OF)


@query("date_columns")
def q_date_columns(spark, sf_dir):
    return date_columns_frame(_bronze(spark, sf_dir))


@query("incremental_filter")
def q_incremental_filter(spark, sf_dir):
    return incremental_filter(_bronze(spark, sf_dir), *fx.MID_STATE)


@query("exclude_columns")
def q_exclude_columns(spark, sf_dir):
    return exclude_columns(_bronze(spark, sf_dir), ["VALUE", "Legacy_Col", "no_such_column"])


@query("lineage_columns")
def q_lineage_columns(spark, sf_dir):
    return lineage_columns(_bronze(spark, sf_dir), run_ts=fx.RUN_TS_1)


# ---------------------------------------------------------- aggregations

@query("null_profile")
def q_null_profile(spark, sf_dir):
    return null_profile(_bronze(spark, sf_dir))


@query("prune_null_columns")
def q_prune_null_columns(spark, sf_dir):
    return prune_null_columns(_bronze(spark, sf_dir))


@query("key_violations")
def q_key_violations(spark, sf_dir):
    return key_violations(fx.table(spark, sf_dir, "lineitem"), fx.LINEITEM_PK)


@query("batch_state")
def q_batch_state(spark, sf_dir):
    return batch_state(_split_target(spark, sf_dir))


# --------------------------------------------------------------- windows

@query("latest_per_key")
def q_latest_per_key(spark, sf_dir):
    b = date_anomaly_filter(_bronze(spark, sf_dir), None, fx.MIN_TS, fx.MAX_YEARS, fx.AS_OF)
    return latest_per_key(b, fx.EVENTS_PK, fx.EVENTS_CURSOR, fx.EVENTS_TIE)


@query("latest_per_key_composite")
def q_latest_per_key_composite(spark, sf_dir):
    return latest_per_key(fx.table(spark, sf_dir, "lineitem"), fx.LINEITEM_PK,
                          fx.LINEITEM_CURSOR, fx.LINEITEM_TIE)


# ------------------------------------------------------------ Silver loads

@query("silver_initial_load")
def q_silver_initial_load(spark, sf_dir):
    return sf.initial_load(_bronze(spark, sf_dir), EVENTS_DATASET, VALIDATION, fx.AS_OF, fx.RUN_TS_1)


@query("merge_latest")
def q_merge_latest(spark, sf_dir):
    target = _split_target(spark, sf_dir)
    state = read_state(target)
    return sf.merge_load(target, _bronze(spark, sf_dir), EVENTS_DATASET, VALIDATION, state,
                         fx.AS_OF, fx.RUN_TS_2)


@query("merge_outcome")
def q_merge_outcome(spark, sf_dir):
    target = _split_target(spark, sf_dir)
    src = sf.merge_source(_bronze(spark, sf_dir), EVENTS_DATASET, VALIDATION, read_state(target),
                          fx.AS_OF)
    return merge_outcome(target, src, fx.EVENTS_PK, fx.EVENTS_CURSOR)


@query("append_initial_load")
def q_append_initial_load(spark, sf_dir):
    b = _bronze(spark, sf_dir).where(F.col("ingestion_date") <= fx.SPLIT_DATE)
    return sf.append_load(b, EVENTS_APPEND, VALIDATION, None, fx.AS_OF, fx.RUN_TS_1)


@query("append_incremental")
def q_append_incremental(spark, sf_dir):
    first = q_append_initial_load(spark, sf_dir)
    state = read_state(first)
    added = sf.append_load(_bronze(spark, sf_dir), EVENTS_APPEND, VALIDATION, state,
                           fx.AS_OF, fx.RUN_TS_2)
    return first.unionByName(added)


# ------------------------------------------------------------------ Gold

ORDERS_GOLD = GoldTable(source_table="orders", target_table="dim_orders",
                        primary_keys=fx.ORDERS_PK, columns=fx.ORDERS_MAPPING,
                        watermark_column=fx.ORDERS_WATERMARK_COL, watermark_enabled=True)


@query("watermark_filter")
def q_watermark_filter(spark, sf_dir):
    return watermark_filter(fx.table(spark, sf_dir, "orders"), fx.ORDERS_WATERMARK_COL,
                            fx.GOLD_PREV_WATERMARK, fx.GOLD_OVERLAP_SECONDS)


@query("map_columns")
def q_map_columns(spark, sf_dir):
    mapping = list(fx.ORDERS_MAPPING) + [ColumnMap("o_comment", "comment", "string")]
    return map_columns(fx.table(spark, sf_dir, "orders"), mapping)


@query("watermark_max")
def q_watermark_max(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders")
    text = F.when(F.col("o_orderstatus") == "P", F.lit("not a timestamp")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    return watermark_max(o.select(text.alias("modified_text")), "modified_text",
                         previous=fx.GOLD_PREV_WATERMARK)


def _gold_source(spark, sf_dir):
    return gold_source(fx.silver_orders(spark, sf_dir), ORDERS_GOLD, fx.GOLD_PREV_WATERMARK,
                       fx.GOLD_OVERLAP_SECONDS)


@query("upsert_overwrite")
def q_upsert_overwrite(spark, sf_dir):
    return gold_upsert(fx.gold_target(spark, sf_dir), _gold_source(spark, sf_dir), ORDERS_GOLD)


@query("upsert_do_nothing")
def q_upsert_do_nothing(spark, sf_dir):
    li = fx.table(spark, sf_dir, "lineitem")
    cut = ts_lit(fx.LINK_CUTOFF)
    target = li.where(F.col("l_shipdate") <= cut).select("l_orderkey", "l_partkey").distinct()
    source = li.where(F.col("l_shipdate") > cut).select("l_orderkey", "l_partkey").distinct()
    return upsert(target, source, ["l_orderkey", "l_partkey"])


@query("watermark_upsert")
def q_watermark_upsert(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders")
    e = fx.table(spark, sf_dir, "events")
    li = fx.table(spark, sf_dir, "lineitem")
    old = (o.where(F.col("o_orderdate") <= ts_lit(fx.GOLD_TARGET_CUTOFF))
            .agg(F.lit("orders").alias("source_table"), F.max("o_orderdate").alias("last_watermark"))
           .unionByName(e.where(F.col("ts") < ts_lit(fx.SPLIT_DATE))
                        .agg(F.lit("events").alias("source_table"), F.max("ts").alias("last_watermark"))))
    store = watermark_rows(old, fx.RUN_TS_1)
    new = (o.agg(F.lit("orders").alias("source_table"), F.max("o_orderdate").alias("last_watermark"))
            .unionByName(li.agg(F.lit("lineitem").alias("source_table"),
                                F.max("l_shipdate").alias("last_watermark"))))
    return save_watermarks(store, new, fx.RUN_TS_2)


@query("reconcile_missing_keys")
def q_reconcile_missing_keys(spark, sf_dir):
    # every source key, not a slice of them; the keys of one entity in seventeen have vanished upstream
    target = _split_target(spark, sf_dir)
    src = _bronze(spark, sf_dir).where(F.col("entity_id") % 17 != 3)
    return reconcile_missing_keys(target, src, fx.EVENTS_PK)


@query("reconcile_by_digest")
def q_reconcile_by_digest(spark, sf_dir):
    target = _split_target(spark, sf_dir)
    src = _bronze(spark, sf_dir).where(F.col("entity_id") % 17 != 3)
    return reconcile_by_digest(target, src, fx.EVENTS_PK)


@query("reconcile_table")
def q_reconcile_table(spark, sf_dir):
    """A Silver table that is flagged in place: all keys first vanish for one
    entity in five, then those come back and one in seventeen vanishes."""
    table = SnapshotTable(spark, f"reconcile_{_run_tag(spark)}", key=fx.EVENTS_PK, buckets=FIXTURE_BUCKETS)
    table.write(_split_target(spark, sf_dir))
    src = _bronze(spark, sf_dir).select(*fx.EVENTS_PK).distinct()
    reconcile_table(table, src.where(F.col("entity_id") % 5 != 2))
    reconcile_table(table, src.where(F.col("entity_id") % 17 != 3))
    return table.read()


@query("staging_csv")
def q_staging_csv(spark, sf_dir):
    d = fx.table(spark, sf_dir, "documents").withColumn("lang", F.expr("nullif(lang, 'de')"))
    return staging_csv(d, keep=["doc_id"])


# ------------------------------------------------------------ identifiers

@query("sanitize_identifier")
def q_sanitize_identifier(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders")
    return o.select("o_orderkey", "o_orderpriority",
                    sanitize_identifier("o_orderpriority").alias("table_name"))


@query("normalize_prefix")
def q_normalize_prefix(spark, sf_dir):
    e = fx.table(spark, sf_dir, "events")
    raw = F.when(F.col("event_type") == "error", F.lit("/")).otherwise(
        F.concat(F.lit("//lake/"), F.col("event_type"), F.lit("//")))
    p = e.select("event_id", raw.alias("raw_prefix"),
                 F.concat(F.lit("part-"), F.col("event_id").cast("string"), F.lit(".parquet")).alias("name"))
    p = p.withColumn("prefix", normalize_prefix("raw_prefix"))
    full = F.concat(F.col("prefix"), F.lit("EVENTS/"), F.col("name"))
    return p.select("event_id", "raw_prefix", "prefix",
                    strip_prefix(full, F.col("prefix")).alias("relative_key"))


# ----------------------------------------------------------------- schema

SCHEMA_TABLES = ("region nation customer supplier part orders lineitem events documents "
                 "embeddings pages benchmark labels conversations").split()


@query("infer_schema")
def q_infer_schema(spark, sf_dir):
    return infer_schema(spark, {t: f"{sf_dir.rstrip('/')}/{t}.parquet" for t in SCHEMA_TABLES})


@query("type_compat")
def q_type_compat(spark, sf_dir):
    s = q_infer_schema(spark, sf_dir)
    existing = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in _EXISTING_STYLE.items()
                                                      for x in kv]), F.col("column_type")),
                          F.col("column_type"))
    configured = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in _DECLARED_STYLE.items()
                                                        for x in kv]), F.col("column_type")),
                            F.upper(F.col("column_type")))
    return s.select("table_name", "column_name", existing.alias("existing_type"),
                    configured.alias("configured_type"),
                    type_compatible(existing, configured).alias("compatible"))


# How a relational catalog reports each catalog type, and
# how a mapping file typically declares it.
_EXISTING_STYLE = {"bigint": "bigint", "int": "integer", "double": "double precision",
                   "float": "real", "timestamp": "timestamp without time zone",
                   "string": "character varying", "boolean": "boolean", "date": "date"}
_DECLARED_STYLE = {"bigint": "BIGINT", "int": "INT", "double": "DOUBLE PRECISION", "float": "REAL",
                   "timestamp": "TIMESTAMP", "string": "TEXT", "boolean": "BOOLEAN", "date": "DATE"}


def _legacy_gold(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("order_id"),
                    F.col("o_custkey").cast("string").alias("customer_id"),
                    F.col("o_orderstatus").alias("status"),
                    F.col("o_totalprice").alias("total"),
                    F.lit("x").alias("legacy_column"))


@query("schema_diff")
def q_schema_diff(spark, sf_dir):
    existing = _legacy_gold(spark, sf_dir)
    configured = [(m.target, catalog_type(m.data_type)) for m in ORDERS_GOLD.columns]
    existing_pk = ["order_id", "status"]
    diff = schema_diff(configured, list(ORDERS_GOLD.primary_keys), schema_pairs(existing.schema),
                       existing_pk)
    return schema_diff_frame(spark, diff, existing_pk, list(ORDERS_GOLD.primary_keys))


@query("add_missing_columns")
def q_add_missing_columns(spark, sf_dir):
    """Silver created while ``value`` was excluded; the config now keeps
    it: the column is added (old rows NULL) and the next MERGE fills it."""
    old_cfg = SilverDataset(name="events", pk=fx.EVENTS_PK, cursor=fx.EVENTS_CURSOR,
                            exclude_columns=("valid_ts", "value"), tie_breakers=fx.EVENTS_TIE)
    target = _split_target(spark, sf_dir, old_cfg)
    bronze = _bronze(spark, sf_dir)
    retained = bronze.select(*sf.retained_columns(bronze, EVENTS_DATASET)).schema
    evolved = add_missing_columns(target, retained)
    return sf.merge_load(evolved, bronze, EVENTS_DATASET, VALIDATION, read_state(target),
                         fx.AS_OF, fx.RUN_TS_2)


# -------------------------------------------------------------- discovery

def _parsed(spark, sf_dir):
    return parse_keys(fx.bronze_paths(spark, sf_dir), "key")


@query("parse_partition_path")
def q_parse_partition_path(spark, sf_dir):
    p = _parsed(spark, sf_dir)
    return flatten(p.select("event_id", "key", "dataset", "raw_names", "values", "location"))


@query("dataset_summary")
def q_dataset_summary(spark, sf_dir):
    return dataset_summary(parse_folders(fx.bronze_paths(spark, sf_dir)))


@query("partition_layout_check")
def q_partition_layout_check(spark, sf_dir):
    return partition_layout_check(fx.bronze_paths(spark, sf_dir))


@query("distinct_partitions")
def q_distinct_partitions(spark, sf_dir):
    return flatten(distinct_partitions(parse_folders(fx.bronze_paths(spark, sf_dir))))


@query("new_partitions")
def q_new_partitions(spark, sf_dir):
    listing = fx.bronze_paths(spark, sf_dir)
    before = listing.where(F.col("last_modified") < ts_lit(fx.CRAWL_CUTOFF))
    return flatten(new_partitions(distinct_partitions(parse_folders(listing)),
                                  distinct_partitions(parse_folders(before))))


@query("list_partitions")
def q_list_partitions(spark, sf_dir):
    return _bronze(spark, sf_dir).select("ingestion_date", "batch_id").distinct()


def _listing_now(spark, sf_dir):
    p = _parsed(spark, sf_dir)
    rewritten = F.to_date("last_modified") == F.lit(fx.REWRITE_DAY).cast("date")
    return p.select("dataset", "key",
                    (F.col("size") + F.when(rewritten, 1).otherwise(0)).alias("length"),
                    F.col("last_modified").alias("modification_time"))


def _inventory_before(spark, sf_dir):
    p = _parsed(spark, sf_dir).where(F.col("last_modified") < ts_lit(fx.CRAWL_CUTOFF))
    return p.select("dataset", "key", F.col("size").alias("length"),
                    F.col("last_modified").alias("modification_time"),
                    ts_lit(fx.RUN_TS_1).alias("processed_at"))


@query("changed_files")
def q_changed_files(spark, sf_dir):
    return changed_files(_listing_now(spark, sf_dir), _inventory_before(spark, sf_dir))


@query("changed_folders")
def q_changed_folders(spark, sf_dir):
    return changed_folders(folder_digests(_listing_now(spark, sf_dir)), folder_digests(_inventory_before(spark, sf_dir)))


@query("file_inventory_upsert")
def q_file_inventory_upsert(spark, sf_dir):
    inv = _inventory_before(spark, sf_dir)
    return inventory_upsert(inv, changed_files(_listing_now(spark, sf_dir), inv), fx.RUN_TS_2)


# ------------------------------------------------------- written tables

def _run_tag(spark) -> str:
    return new_run_dir(spark, "q").rsplit("-", 1)[-1]


@query("silver_rebuild")
def q_silver_rebuild(spark, sf_dir):
    """Load the first part, then rebuild from all of Bronze: the result
    must equal an initial load over everything."""
    prefix = f"silver_{_run_tag(spark)}_"
    bronze = _bronze(spark, sf_dir)
    first = bronze.where(F.col("ingestion_date") <= fx.SPLIT_DATE)
    load_silver(spark, lambda _: first, [EVENTS_DATASET], VALIDATION, as_of=fx.AS_OF,
                run_ts=fx.RUN_TS_2, table_prefix=prefix, buckets=FIXTURE_BUCKETS).collect()
    load_silver(spark, lambda _: bronze, [EVENTS_DATASET], VALIDATION, rebuild=True,
                as_of=fx.AS_OF, run_ts=fx.RUN_TS_1, table_prefix=prefix,
                buckets=FIXTURE_BUCKETS).collect()
    return spark.table(f"{prefix}{EVENTS_DATASET.name}")


@query("run_summary")
def q_run_summary(spark, sf_dir):
    """Silver loader summary over three datasets and two runs: initial
    loads, then incremental MERGE / append; one dataset gated."""
    prefix = f"silver_{_run_tag(spark)}_"
    bronze = _bronze(spark, sf_dir)
    first = bronze.where(F.col("ingestion_date") <= fx.SPLIT_DATE)
    gated = SilverDataset(name="events_gated", pk=fx.EVENTS_PK, cursor=fx.EVENTS_CURSOR,
                          mode="append_only", requires_confirmation=True, note="needs review")
    datasets = [EVENTS_DATASET, EVENTS_APPEND, gated]
    s1 = load_silver(spark, lambda _: first, datasets, VALIDATION, as_of=fx.AS_OF,
                     run_ts=fx.RUN_TS_1, table_prefix=prefix, buckets=FIXTURE_BUCKETS)
    s1 = spark.createDataFrame(s1.collect(), s1.schema).withColumn("run", F.lit(1))
    s2 = load_silver(spark, lambda _: bronze, datasets, VALIDATION, as_of=fx.AS_OF,
                     run_ts=fx.RUN_TS_2, table_prefix=prefix, buckets=FIXTURE_BUCKETS)
    return s1.unionByName(s2.withColumn("run", F.lit(2)))


@query("gold_load")
def q_gold_load(spark, sf_dir):
    """Existing Gold table + stored watermark, then one Gold run over
    Silver orders: overlap read, typed mapping, upsert, watermark."""
    tag = _run_tag(spark)
    gold_prefix, wm_table = f"gold_{tag}_", f"gold_{tag}_watermarks"
    loader = GoldLoad(spark, lambda _: fx.silver_orders(spark, sf_dir), GoldSettings(
        watermark_overlap_seconds=fx.GOLD_OVERLAP_SECONDS), gold_prefix, wm_table,
        buckets=FIXTURE_BUCKETS, run_ts=fx.RUN_TS_2)
    loader.target(ORDERS_GOLD).write(fx.gold_target(spark, sf_dir))
    store = loader.ensure_store()
    store.write(save_watermarks(store.read(), spark.createDataFrame(
        [("orders", None)], "source_table string, last_watermark string")
        .withColumn("last_watermark", ts_lit(fx.GOLD_PREV_WATERMARK)), fx.RUN_TS_1))
    loader.run([ORDERS_GOLD]).collect()
    return spark.table(f"{gold_prefix}{ORDERS_GOLD.target_table}")


@query("gold_watermark_store")
def q_gold_watermark_store(spark, sf_dir):
    """The watermark store after a first (full) Gold run of orders."""
    tag = _run_tag(spark)
    loader = GoldLoad(spark, lambda _: fx.silver_orders(spark, sf_dir), GoldSettings(),
                      f"gold_{tag}_", f"gold_{tag}_watermarks", buckets=FIXTURE_BUCKETS,
                      run_ts=fx.RUN_TS_1)
    loader.run([ORDERS_GOLD]).collect()
    return spark.table(f"gold_{tag}_watermarks")


@query("entry")
def q_entry(spark, sf_dir):
    return flagship(spark, sf_dir)


# ------------------------------------------------------ files and catalog

@query("file_listing")
def q_file_listing(spark, sf_dir):
    """One row per listed Parquet file: its dataset and partition values
    (byte sizes depend on the Parquet writer, so only ``length > 0``)."""
    root = fx.write_bronze_files(spark, sf_dir)
    parsed = parse_keys(list_files(spark, root), "key")
    return parsed.select("dataset", F.array_join("values", "/").alias("values"),
                         (F.col("length") > 0).alias("non_empty"))


@query("footer_null_profile")
def q_footer_null_profile(spark, sf_dir):
    root = fx.write_bronze_files(spark, sf_dir)
    return footer_null_profile(spark, root, _bronze(spark, sf_dir).schema, ["ingestion_date", "batch_id"], "EVENTS/")


@query("bronze_scan")
def q_bronze_scan(spark, sf_dir):
    root = fx.write_bronze_files(spark, sf_dir)
    return bronze_scan(spark, f"{root}/EVENTS", ["ingestion_date", "batch_id"])


_CRAWLED: dict = {}


def _crawled(spark, sf_dir, plan_only=False):
    """Crawl the written Bronze files into a new database.  Queries that
    only read the registered tables reuse one crawl per session
    (``plan_only`` and ``register_table`` always crawl afresh)."""
    root = fx.write_bronze_files(spark, sf_dir)
    db = f"bronze_{_run_tag(spark)}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    summary = crawl(spark, root, "", db, plan_only=plan_only, inventory=f"{db}.file_inventory",
                    inventory_buckets=FIXTURE_BUCKETS)
    return db, summary


def _registered_db(spark, sf_dir) -> str:
    key = (spark.sparkContext.applicationId, sf_dir)
    db = _CRAWLED.get(key)
    if db is None or not spark.catalog.tableExists(f"{db}.events"):
        db, summary = _crawled(spark, sf_dir)
        summary.collect()
        _CRAWLED[key] = db
    return db


def _crawl_report(summary):
    """The crawl summary without run-specific text: the table's name
    without the run's database, the sample file's folder instead of its
    (writer-generated) file name."""
    return summary.select(
        "dataset", F.substring_index("table_name", ".", -1).alias("table_name"), "n_files",
        F.regexp_extract("sample_file", r"^(.*/)[^/]*$", 1).alias("sample_dir"), "n_columns",
        "partition_columns", "n_partitions", "action", "partitions_created", "partitions_failed",
        "schema_source")


@query("crawl_plan")
def q_crawl_plan(spark, sf_dir):
    return _crawl_report(_crawled(spark, sf_dir, plan_only=True)[1])


@query("register_table")
def q_register_table(spark, sf_dir):
    db, first = _crawled(spark, sf_dir)
    root = fx.write_bronze_files(spark, sf_dir)
    again = crawl(spark, root, "", db, inventory=f"{db}.file_inventory",   # re-crawl: nothing new
                  inventory_buckets=FIXTURE_BUCKETS)
    first = spark.createDataFrame(first.collect(), first.schema)
    return (_crawl_report(first).withColumn("run", F.lit(1))
            .unionByName(_crawl_report(again).withColumn("run", F.lit(2))))


@query("table_columns")
def q_table_columns(spark, sf_dir):
    return table_columns(spark, f"{_registered_db(spark, sf_dir)}.events")


@query("catalog_partitions")
def q_catalog_partitions(spark, sf_dir):
    return show_partitions(spark, f"{_registered_db(spark, sf_dir)}.events")


@query("bronze_table_scan")
def q_bronze_table_scan(spark, sf_dir):
    """The registered Bronze table read back through the catalog."""
    return spark.table(f"{_registered_db(spark, sf_dir)}.events")


# ------------------------------------------------------ external sinks

@query("stream_merge")
def q_stream_merge(spark, sf_dir):
    """Bronze files drained by an availableNow stream, several files per
    micro-batch, each batch merged into Silver (distinct cursors: the
    order of files does not matter)."""
    loc = fx.write_stream_files(spark, sf_dir)
    data_schema = spark.read.parquet(loc).schema
    tag = _run_tag(spark)
    table = SnapshotTable(spark, f"silver_stream_{tag}", key=fx.EVENTS_PK, buckets=FIXTURE_BUCKETS)
    q = stream_silver(spark, loc, data_schema, ["ingestion_date", "batch_id"], table,
                      EVENTS_DATASET, new_run_dir(spark, "stream-cp"), VALIDATION, fx.AS_OF,
                      fx.RUN_TS_1, max_files_per_trigger=250)
    q.awaitTermination()
    return spark.table(table.name)
