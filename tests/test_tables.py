"""Versioned tables, append by name after evolution, rebuild, crawl."""

import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMALL, rows
from tierload import fixtures as fx
from tierload.plans.crawl import NameCollision, crawl
from tierload.plans.tables import SnapshotTable
from tierload.sources.listing import list_files
from tierload.sources.paths import dataset_summary, parse_folders, parse_keys


def _name(label):
    return f"{label}_{uuid.uuid4().hex[:8]}"


def test_versions_swap_and_old_version_stays_readable(spark):
    t = SnapshotTable(spark, _name("snap"), key=["id"], buckets=4)
    v1 = t.write(spark.createDataFrame([(1, "a")], "id int, v string"))
    v2 = t.write(spark.createDataFrame([(1, "b"), (2, "c")], "id int, v string"))
    assert t.current_version() == v2 and v1 != v2
    assert rows(spark.table(t.name)) == [(1, "b"), (2, "c")]
    assert rows(t.read(version=v1)) == [(1, "a")]
    assert t.stored_key() == ["id"]
    assert t.drop_old_versions(keep=1) == [v1]


def test_merge_join_does_not_shuffle_bucketed_side(spark):
    from tierload.operators import upsert_overwrite
    t = SnapshotTable(spark, _name("bkt"), key=["id"], buckets=8)
    t.write(spark.range(1000).select(F.col("id"), (F.col("id") * 2).alias("v")))
    src = spark.range(990, 1010).select(F.col("id"), F.lit(-1).cast("bigint").alias("v"))
    plan = upsert_overwrite(t.read(), src, ["id"])._jdf.queryExecution().executedPlan().toString()
    # one exchange: the small source side only
    assert plan.count("Exchange hashpartitioning") <= 1


def test_append_after_evolution_matches_by_name(spark):
    """D-24: appended rows land by column name, also after ADD COLUMNS."""
    t = SnapshotTable(spark, _name("app"))
    t.write(spark.createDataFrame([(1, "a")], "id int, v string"))
    t.add_columns([T.StructField("extra", T.StringType())])
    t.append(spark.createDataFrame([("x", "b", 2)], "extra string, v string, id int"))
    assert rows(spark.table(t.name)) == [(1, "a", None), (2, "b", "x")]


def test_rebuild_equals_initial_load(spark):
    from tierload.registry import q_silver_initial_load, q_silver_rebuild
    assert rows(q_silver_rebuild(spark, SF_SMALL)) == rows(q_silver_initial_load(spark, SF_SMALL))


def test_crawl_registers_then_nothing_new(spark):
    root = fx.write_bronze_files(spark, SF_SMALL)
    db = _name("crawl")
    spark.sql(f"CREATE DATABASE {db}")
    first = {r["dataset"]: r for r in crawl(spark, root, "", db, inventory=f"{db}.files").collect()}
    assert first["EVENTS"]["action"] == "created"
    assert first["EVENTS"]["partitions_created"] == first["EVENTS"]["n_partitions"]
    assert first["Orders.v1"]["table_name"] == f"{db}.orders_v1"
    second = {r["dataset"]: r for r in crawl(spark, root, "", db, inventory=f"{db}.files").collect()}
    assert second["EVENTS"]["partitions_created"] == 0
    assert second["EVENTS"]["schema_source"] == "cache"
    ev = spark.table(f"{db}.events")
    assert dict(ev.dtypes)["ingestion_date"] == "string"
    assert ev.count() == fx.bronze_events(spark, SF_SMALL).count()


def test_plan_only_writes_nothing(spark):
    root = fx.write_bronze_files(spark, SF_SMALL)
    db = _name("plan")
    spark.sql(f"CREATE DATABASE {db}")
    out = crawl(spark, root, "", db, plan_only=True).collect()
    assert {r["action"] for r in out} == {"PLAN"}
    assert spark.catalog.listTables(db) == []


def test_name_collision_raises(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "a int")
    df.write.parquet(str(tmp_path / "Sales.v1" / "x=1"))
    df.write.parquet(str(tmp_path / "sales_v1" / "x=1"))
    with pytest.raises(NameCollision):
        crawl(spark, str(tmp_path), "", None, plan_only=True)


def test_listing_and_parse_cases(spark):
    keys = spark.createDataFrame([
        ("raw/DS/a=1/b=/x.parquet",), ("raw/DS/a=1/plain/b=q=r/y.PARQUET",), ("raw/DS/=v/z.parquet",),
        ("raw/top.parquet",), ("raw/DS/_SUCCESS",), ("raw/DS/f.parquet",)], "key string")
    p = {r["key"]: r for r in parse_keys(keys, "key", "/raw/").collect()}
    assert set(p) == {"raw/DS/a=1/b=/x.parquet", "raw/DS/a=1/plain/b=q=r/y.PARQUET",
                      "raw/DS/=v/z.parquet", "raw/DS/f.parquet"}
    r = p["raw/DS/a=1/plain/b=q=r/y.PARQUET"]
    assert (r["raw_names"], r["values"]) == (["a", "b"], ["1", "q=r"])
    assert r["location"] == "raw/DS/a=1/plain/b=q=r/"
    assert p["raw/DS/a=1/b=/x.parquet"]["values"] == ["1", ""]
    assert p["raw/DS/=v/z.parquet"]["raw_names"] == []
    s = dataset_summary(parse_folders(keys, "key", "raw")).first()
    assert (s["n_files"], s["layout"], s["n_partitions"], s["n_incompatible"]) == (4, "a,b", 2, 0)


def test_list_files_relative_keys(spark, tmp_path):
    spark.createDataFrame([(1,)], "a int").write.parquet(str(tmp_path / "DS" / "d=1"))
    keys = [r["key"] for r in list_files(spark, str(tmp_path)).collect()]
    assert keys and all(k.startswith("DS/d=1/part-") for k in keys)


def _files(spark, table):
    return spark.table(table).select(F.input_file_name().alias("f")).distinct().count()


def test_one_file_per_bucket_on_create_and_merge(spark):
    from tierload.operators import merge_latest
    t = SnapshotTable(spark, _name("files"), key=["id"], buckets=4)
    base = spark.range(200).select(F.col("id"), F.lit("a").alias("v"),
                                   F.lit(1).alias("cur"),
                                   F.lit("2024-01-01").alias("_source_ingestion_date"),
                                   F.lit("b1").alias("_source_batch_id"),
                                   F.lit(None).cast("timestamp_ntz").alias("_silver_loaded_at"))
    v1 = t.write(base.repartition(7))              # arbitrary input partitioning
    assert _files(spark, v1) == 4 and t.stored_buckets() == 4
    src = spark.range(150, 260).select(F.col("id"), F.lit("b").alias("v"), F.lit(2).alias("cur"),
                                       F.lit("2024-01-02").alias("ingestion_date"),
                                       F.lit("b2").alias("batch_id"))
    merged = merge_latest(t.read(), src, ["id"], "cur", "2026-01-01 00:00:00")
    v2 = t.write(merged, aligned=True)
    assert _files(spark, v2) == 4
    assert spark.table(t.name).count() == 260
    assert spark.table(t.name).where("v = 'b'").count() == 110


def test_state_is_stored_with_each_version(spark):
    from tierload.operators import read_state
    t = SnapshotTable(spark, _name("state"), key=["id"], buckets=2)
    df = spark.createDataFrame(
        [(1, "2024-01-02", "b2"), (2, "2024-01-03", "b1"), (3, "2024-01-03", "b0"), (4, None, "zz")],
        "id int, _source_ingestion_date string, _source_batch_id string")
    t.write(df)
    assert t.state() == read_state(df) == ("2024-01-03", "b1")
    t.append(spark.createDataFrame([(5, "2024-01-01", "b9")], df.schema))
    assert t.state() == ("2024-01-03", "b1")              # older rows never lower the state
    t.append(spark.createDataFrame([(6, "2024-01-04", "a0")], df.schema))
    assert t.state() == ("2024-01-04", "a0")
    e = SnapshotTable(spark, _name("empty"), key=["id"], buckets=2)
    e.write(df.limit(0))
    assert e.state() is None


def test_only_selects_one_dataset(spark):
    from tierload.config import ConfigError, GoldSettings
    from tierload.plans.gold import load_gold
    from tierload.plans.silver import load_silver
    from tierload import registry as R
    bronze = fx.bronze_events(spark, SF_SMALL)
    out = load_silver(spark, lambda _: bronze, [R.EVENTS_DATASET, R.EVENTS_APPEND], R.VALIDATION,
                      plan_only=True, only="events_log").collect()
    assert [r["dataset"] for r in out] == ["events_log"]
    with pytest.raises(ConfigError):
        load_silver(spark, lambda _: bronze, [R.EVENTS_DATASET], only="missing")
    with pytest.raises(ConfigError):
        load_gold(spark, lambda _: bronze, [R.ORDERS_GOLD], GoldSettings(), only="missing")


def test_initial_load_one_file_per_bucket_without_extra_shuffle(spark):
    from tierload import registry as R
    from tierload.plans.silver import load_silver
    prefix = f"{_name('init')}_"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    load_silver(spark, lambda _: fx.bronze_events(spark, SF_SMALL), [R.EVENTS_DATASET],
                R.VALIDATION, table_prefix=prefix).collect()
    t = SnapshotTable(spark, f"{prefix}events", key=fx.EVENTS_PK)
    assert t.stored_buckets() == buckets
    assert 0 < _files(spark, t.current_version()) <= buckets


def test_versions_of_a_qualified_table(spark):
    db = _name("vdb")
    spark.sql(f"CREATE DATABASE {db}")
    t = SnapshotTable(spark, f"{db}.snap", key=["id"], buckets=2)
    first = t.write(spark.createDataFrame([(1,)], "id int"))
    t.write(spark.createDataFrame([(2,)], "id int"))
    third = t.write(spark.createDataFrame([(3,)], "id int"))
    assert len(t.versions()) == 3 and all(v.startswith(f"{db}.") for v in t.versions())
    assert t.drop_old_versions(keep=2) == [first]
    assert t.current_version() == third and [r[0] for r in spark.table(t.name).collect()] == [3]


def _append_frame(spark, ids, batch):
    from pyspark.sql import functions as F
    return spark.createDataFrame([(i,) for i in ids], "id int").select(
        "id", F.lit("2024-01-01").cast("timestamp_ntz").alias("_source_ingestion_date"), F.lit(batch).alias("_source_batch_id"))


def test_state_after_an_interrupted_append_comes_from_the_rows(spark, monkeypatch):
    t = SnapshotTable(spark, "pending_append")
    t.append(_append_frame(spark, [1], "b1"))
    monkeypatch.setattr(SnapshotTable, "_save_state", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost driver")))
    try:
        t.append(_append_frame(spark, [2], "b2"))
    except RuntimeError:
        pass
    monkeypatch.undo()
    assert t.state() == ("2024-01-01", "b2")          # the rows are in: the batch is not loaded again
    t.append(_append_frame(spark, [3], "b3"))
    assert t.state() == ("2024-01-01", "b3") and t.read().count() == 3


def test_quote_in_a_batch_id(spark):
    t = SnapshotTable(spark, "quoted_batch")
    t.append(_append_frame(spark, [1], "b'1"))
    assert t.state() == ("2024-01-01", "b'1")


def test_column_names_differing_in_case_are_the_same_column():
    from pyspark.sql import types as T
    from tierload.operators.schema_ops import find_missing_columns
    one, two = (T.StructType([T.StructField(n, T.IntegerType())]) for n in ("Value", "value"))
    assert find_missing_columns(one, two) == []


def _buckets_of(spark, t):
    return {b: sorted(f.rsplit("/", 1)[0] for f in spark.table(t.current_version()).inputFiles()
                      if f"tierload_bucket={b}/" in f) for b in t.bucket_folders()}


def test_merge_leaves_untouched_buckets_where_they_are(spark):
    from tierload.operators import upsert_overwrite
    t = SnapshotTable(spark, _name("touch"), key=["id"], buckets=8)
    v1 = t.write(spark.range(1000).select("id", (F.col("id") * 2).alias("v")))
    before = t.bucket_folders()
    src = spark.createDataFrame([(7, -1)], "id long, v long")
    done = t.merge(src, lambda cur: upsert_overwrite(cur, src, ["id"], t.join_partitions()))
    after = t.bucket_folders()
    assert len(done.touched) == 1 and len(done.carried) == 7
    assert {b for b in after if after[b] != before[b]} == set(done.touched)
    assert "tierload_bucket" not in t.read().columns + spark.table(t.name).columns
    assert spark.table(t.name).count() == 1000
    assert [r["id"] for r in spark.table(t.name).where("v = -1").collect()] == [7]
    assert spark.table(v1).where("v = -1").count() == 0 and spark.table(v1).count() == 1000
    assert _files(spark, done.version) == 8                       # still one file per bucket
    # a further merge reads carried buckets too; new keys and NULL keys are inserted
    more = spark.createDataFrame([(8, -2), (5000, -3), (None, -4)], "id long, v long")
    t.merge(more, lambda cur: upsert_overwrite(cur, more, ["id"], t.join_partitions()))
    assert spark.table(t.name).count() == 1002
    assert sorted(r["v"] for r in spark.table(t.name).where("v < 0").collect()) == [-4, -3, -2, -1]


def test_merge_reads_only_touched_buckets_and_keeps_the_join_in_place(spark):
    from tierload.operators import upsert_overwrite
    t = SnapshotTable(spark, _name("touchplan"), key=["id"])
    t.write(spark.range(1000).select("id", (F.col("id") * 2).alias("v")))
    src = spark.createDataFrame([(7, -1)], "id long, v long")
    p = upsert_overwrite(t.read(t.touched_buckets(src)), src, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert p.count("Exchange hashpartitioning") == 1 and "PartitionFilters: [isnotnull(tierload_bucket" in p


def test_failed_merge_keeps_the_version(spark):
    from tierload.operators import upsert_overwrite
    t = SnapshotTable(spark, _name("fail"), key=["id"], buckets=4)
    v1 = t.write(spark.range(100).select("id", (F.col("id") * 2).alias("v")))
    src = spark.createDataFrame([(7, -1)], "id long, v long")

    def check():
        raise ValueError("bad key")
    with pytest.raises(ValueError):
        t.merge(src, lambda cur: upsert_overwrite(cur, src, ["id"], t.join_partitions()), check=check)
    assert t.current_version() == v1 and t.versions() == [v1]
    assert spark.table(t.name).count() == 100 and spark.table(t.name).where("v = -1").count() == 0


def test_merge_keeps_the_state_and_evolved_columns_of_untouched_buckets(spark):
    from tierload.operators import upsert_overwrite
    t = SnapshotTable(spark, _name("touchstate"), key=["id"], buckets=8)
    t.write(spark.range(100).select("id", F.lit("2024-01-05").alias("_source_ingestion_date"), F.lit("b5").alias("_source_batch_id")))
    t.add_columns([T.StructField("extra", T.StringType())])
    src = spark.createDataFrame([(7, "2024-01-02", "b2", "x")], "id long, _source_ingestion_date string, _source_batch_id string, extra string")
    t.merge(src, lambda cur: upsert_overwrite(cur, src, ["id"], t.join_partitions()))
    assert t.state() == ("2024-01-05", "b5")
    assert spark.table(t.name).where("extra = 'x'").count() == 1 and spark.table(t.name).where("extra IS NULL").count() == 99


def test_merge_with_another_key_type_rewrites_all(spark):
    from tierload.operators import upsert_overwrite
    t = SnapshotTable(spark, _name("keytype"), key=["id"], buckets=4)
    t.write(spark.createDataFrame([(i, i) for i in range(50)], "id int, v int"))
    src = spark.createDataFrame([(7, -1), (60, -2)], "id long, v int")
    done = t.merge(src, lambda cur: upsert_overwrite(cur, src, ["id"], t.join_partitions()))
    assert done.touched is None and done.carried == []
    assert spark.table(t.name).count() == 51 and spark.table(t.name).where("v < 0").count() == 2


def test_loaders_keep_as_many_versions_as_they_are_told(spark):
    from tierload.config import DateValidation, GoldTable, SilverDataset
    from tierload.operators import ColumnMap
    from tierload.plans.gold import load_gold
    from tierload.plans.silver import load_silver
    tag = _name("keep")
    ds = SilverDataset(name="d", pk=["id"], cursor="cur")

    def bronze(n):
        return spark.range(n).select("id", F.expr("timestamp_ntz'2024-01-01 00:00:00'").alias("cur"),
                                     F.lit(f"2024-01-0{n}").alias("ingestion_date"), F.lit(f"b{n}").alias("batch_id"))

    silver = SnapshotTable(spark, f"{tag}_d", key=["id"])
    for n in (1, 2, 3):
        load_silver(spark, lambda _, n=n: bronze(n), [ds], DateValidation(), table_prefix=f"{tag}_", buckets=2)
    assert len(silver.versions()) == 3                         # all stay unless told otherwise
    load_silver(spark, lambda _: bronze(4), [ds], DateValidation(), table_prefix=f"{tag}_", buckets=2, keep_versions=2)
    assert len(silver.versions()) == 2 and spark.table(silver.name).count() == 4
    gold = GoldTable("d", "g", ["id"], [ColumnMap("id", "id", "bigint")])
    for _ in range(2):
        out = load_gold(spark, lambda _: spark.table(silver.name), [gold], table_prefix=f"{tag}_", buckets=2,
                        watermark_table=f"{tag}_wm", keep_versions=1).first()
        assert out["status"] == "OK"
    target = SnapshotTable(spark, f"{tag}_g", key=["id"])
    assert len(target.versions()) == 1 and spark.table(target.name).count() == 4
