"""The physical-plan properties the design relies on at scale."""

import contextlib
import io
import uuid

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tierload import fixtures as fx
from tierload import registry as R
from tierload.operators import key_violations, latest_per_key, upsert_overwrite
from tierload.plans import silver_frames as sf
from tierload.plans.tables import SnapshotTable


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_latest_row_is_limited_before_the_shuffle(spark):
    p = plan(latest_per_key(fx.table(spark, SF_SMALL, "lineitem"), fx.LINEITEM_PK,
                            fx.LINEITEM_CURSOR, fx.LINEITEM_TIE))
    partial = p.index("Partial")
    assert "WindowGroupLimit" in p and p.rfind("Exchange hashpartitioning") < partial
    assert p.count("WindowGroupLimit") == 2


def test_key_check_aggregates_map_side(spark):
    p = plan(key_violations(fx.table(spark, SF_SMALL, "lineitem"), fx.LINEITEM_PK))
    assert p.count("HashAggregate") == 2 and "partial_count" in p


def test_bronze_batch_filter_prunes_partitions_and_pushes_dates(spark):
    db = R._registered_db(spark, SF_SMALL)
    src = sf.merge_source(spark.table(f"{db}.events"), R.EVENTS_DATASET, R.VALIDATION,
                          ("2024-01-28", "20240128120000000_20240128125959999"), fx.AS_OF)
    p = plan(src)
    assert "PartitionFilters: [((cast(ingestion_date" in p
    assert "PushedFilters: [Or(IsNull(valid_ts)" in p


def test_merge_shuffles_only_the_source(spark):
    t = SnapshotTable(spark, f"plan_{uuid.uuid4().hex[:8]}", key=fx.EVENTS_PK, buckets=4)
    bronze = fx.bronze_events(spark, SF_SMALL)
    t.write(sf.initial_load(bronze.where(F.col("ingestion_date") <= fx.SPLIT_DATE),
                            R.EVENTS_DATASET, R.VALIDATION, fx.AS_OF, fx.RUN_TS_1))
    assert t.join_partitions() == 4                           # session has 8 partitions
    p = plan(sf.merge_load(t.read(), bronze, R.EVENTS_DATASET, R.VALIDATION, t.state(),
                           fx.AS_OF, fx.RUN_TS_2, partitions=t.join_partitions()))
    assert "SortMergeJoin" in p and "FullOuter" in p
    # window exchange + the small source re-partitioned to 4; an exchange on
    # the table side would hash the t__-prefixed key columns
    exchanges = [ln for ln in p.splitlines() if "Exchange hashpartitioning" in ln]
    assert len(exchanges) == 2 and not any("t__" in ln for ln in exchanges)
    assert any(", 4), REPARTITION_BY_NUM" in ln for ln in exchanges)


def test_upsert_keeps_sorted_buckets_unsorted(spark):
    t = SnapshotTable(spark, f"plan_{uuid.uuid4().hex[:8]}", key=["id"])
    t.write(spark.range(1000).select("id", (F.col("id") * 2).alias("v")))
    assert t.join_partitions() is None                        # buckets == shuffle partitions
    src = spark.range(990, 1010).select("id", F.lit(-1).cast("bigint").alias("v"))
    p = plan(upsert_overwrite(t.read(), src, ["id"]))
    exchanges = [ln for ln in p.splitlines() if "Exchange hashpartitioning" in ln]
    assert len(exchanges) == 1 and "t__" not in exchanges[0]
    assert p.count("Sort [") == 1                              # only the shuffled source


def test_gold_key_check_rides_on_the_merge(spark):
    from tierload.plans.gold import BAD_KEY, checked_source
    for buckets in (None, 4):
        t = SnapshotTable(spark, f"plan_{uuid.uuid4().hex[:8]}", key=["id"], buckets=buckets)
        t.write(spark.range(1000).select("id", (F.col("id") * 2).alias("v")))
        src = spark.range(990, 1010).select("id", F.lit(-1).cast("bigint").alias("v"))
        checked = checked_source(src, ["id"], t.join_partitions())
        p = plan(upsert_overwrite(t.read(), checked.where(~F.col(BAD_KEY)).drop(BAD_KEY), ["id"]))
        assert "Window" in p
        exchanges = [ln for ln in p.splitlines() if "Exchange hashpartitioning" in ln]
        assert len(exchanges) == 1 and "t__" not in exchanges[0]


def test_discovery_reads_a_listing_once_and_shuffles_no_files_by_dataset(spark):
    from tierload.sources.paths import (dataset_summary, distinct_partitions, parse_folders,
                                        partition_layout_check)
    listing = fx.bronze_paths(spark, SF_SMALL)
    folders = parse_folders(listing)
    for df, by in ((dataset_summary(folders), "_groupingexpression"), (distinct_partitions(folders), "_groupingexpression"),
                   (partition_layout_check(listing), "folder")):
        df.collect()                                          # reuse is decided while it runs
        final = plan(df).split("== Initial Plan ==")[0].splitlines()
        scans = [i for i, ln in enumerate(final) if "FileScan" in ln]
        assert len(scans) == 1
        exchange = next(ln for ln in reversed(final[:scans[0]]) if "Exchange" in ln)
        assert f"hashpartitioning({by}" in exchange and "dataset" not in exchange


def test_layout_check_packs_folders_of_many_files(spark, monkeypatch):
    from tierload.sources import paths
    monkeypatch.setattr(paths, "FILES_PER_ROW", 7)
    keys = [f"raw/DS/{f}/p{i:03d}.parquet" for f in ("a=1", "a=2/b=3", "c=4", "plain") for i in range(50)]
    df = spark.createDataFrame([(k,) for k in [*keys, "raw/DS/c=5/x.txt", "raw/top.parquet", None]], "key string")
    got = sorted(tuple(r) for r in paths.partition_layout_check(df.repartition(3), "key", "raw").collect())
    want = sorted(("DS", k, {"a=2/b=3": "a,b", "c=4": "c"}[k[7:].rsplit("/", 1)[0]], "a")
                  for k in keys if "/b=3/" in k or "/c=4/" in k)
    assert got == want
