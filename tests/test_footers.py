"""Footers read in tasks: schemas and null profiles equal Spark's own."""

import datetime
import decimal
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMALL, rows
from tierload.operators import null_profile
from tierload.plans import crawl as crawl_module
from tierload.plans.crawl import crawl
from tierload.sources import footers
from tierload.sources.footers import file_schemas, footer_counts, footer_null_profile
from tierload.sources.listing import bronze_scan

TYPES = pa.table({
    "b": pa.array([True, None]), "i8": pa.array([1, None], pa.int8()), "i16": pa.array([1, None], pa.int16()),
    "i32": pa.array([1, None], pa.int32()), "i64": pa.array([1, None], pa.int64()), "f": pa.array([1.0, None], pa.float32()),
    "d": pa.array([1.0, None]), "s": pa.array(["x", None]), "y": pa.array([b"x", None]),
    "day": pa.array([datetime.date(2024, 1, 1), None]), "dec": pa.array([decimal.Decimal("1.50"), None], pa.decimal128(9, 2)),
    "ntz": pa.array([datetime.datetime(2024, 1, 1), None], pa.timestamp("us")),
    "ltz": pa.array([datetime.datetime(2024, 1, 1), None], pa.timestamp("ms", "Europe/Berlin")),
    "list": pa.array([[1, None], None]), "rec": pa.array([{"p": 1, "q": ["x"]}, None]),
    "cat": pa.array(["x", None]).dictionary_encode()})


def _write(path, table, **kw):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    pq.write_table(table, path, **kw)
    return path


def _spark_reads(monkeypatch):
    """Count schemas that are left to Spark's reader."""
    seen = []
    info = footers.log.info
    monkeypatch.setattr(footers.log, "info", lambda m, *a: (seen.append(a[0]), info(m, *a)))
    return seen


def test_schemas_are_those_of_sparks_reader(spark, tmp_path, monkeypatch):
    left = _spark_reads(monkeypatch)
    own = str(tmp_path / "own")
    (spark.range(2).select("id", F.lit("x").alias("s"), F.create_map(F.lit("k"), F.lit(1)).alias("m"),
                           F.expr("timestamp'2024-01-01 00:00:00'").alias("t"))
     .coalesce(1).write.parquet(own))
    files = {"arrow": _write(str(tmp_path / "a" / "t.parquet"), TYPES),
             "no_arrow": _write(str(tmp_path / "b" / "t.parquet"), TYPES, store_schema=False),
             "own": next(os.path.join(own, f) for f in os.listdir(own) if f.endswith(".parquet"))}
    for name in os.listdir(SF_SMALL):
        files[name] = f"{SF_SMALL}/{name}"
    got = file_schemas(spark, files)
    assert got == {k: spark.read.parquet(p).schema for k, p in files.items()}
    assert left == []


def test_types_that_spark_decides_are_left_to_it(spark, tmp_path, monkeypatch):
    left = _spark_reads(monkeypatch)
    files = {"int96": _write(str(tmp_path / "a" / "t.parquet"), TYPES.select(["i64", "ntz"]), use_deprecated_int96_timestamps=True),
             "unsigned": _write(str(tmp_path / "b" / "t.parquet"), pa.table({"u": pa.array([1], pa.uint32())})),
             "map": _write(str(tmp_path / "c" / "t.parquet"),
                           pa.table({"m": pa.array([[("a", 1)]], pa.map_(pa.string(), pa.int64()))}))}
    got = file_schemas(spark, files)
    assert got == {k: spark.read.parquet(p).schema for k, p in files.items()}
    assert sorted(left) == sorted(files.values())


def test_settings_that_change_schemas_are_kept(spark, tmp_path):
    path = _write(str(tmp_path / "a" / "t.parquet"), TYPES.select(["y", "ntz"]))
    spark.conf.set("spark.sql.parquet.binaryAsString", "true")
    try:
        assert file_schemas(spark, {"a": path})["a"]["y"].dataType == T.StringType()
    finally:
        spark.conf.set("spark.sql.parquet.binaryAsString", "false")


def test_a_file_that_is_no_parquet_raises(spark, tmp_path):
    bad = tmp_path / "bad.parquet"
    bad.write_bytes(b"not a file of this kind")
    with pytest.raises(Exception):
        file_schemas(spark, {"bad": str(bad)})
    assert file_schemas(spark, {}) == {}


def test_a_crawl_reads_all_footers_at_once(spark, tmp_path, monkeypatch):
    for d in "abc":
        _write(str(tmp_path / d / "day=1" / "t.parquet"), pa.table({"x": [1]}))
    calls = []
    monkeypatch.setattr(crawl_module, "file_schemas", lambda s, f: (calls.append(sorted(f)), file_schemas(s, f))[1])
    out = crawl(spark, str(tmp_path), plan_only=True)
    assert calls == [["a", "b", "c"]] and [r["n_columns"] for r in out.collect()] == [1, 1, 1]


# ------------------------------------------------------------ null profile

PART = T.StructType([T.StructField("id", T.LongType()), T.StructField("s", T.StringType()),
                     T.StructField("l", T.ArrayType(T.LongType())), T.StructField("late", T.StringType())])


def _tree(tmp_path):
    def table(a, b, **more):
        n = b - a
        return pa.table({"id": pa.array([i if i % 3 else None for i in range(a, b)], pa.int64()),
                         "s": pa.array([None if i % 2 else "x" for i in range(n)]),
                         "l": pa.array([None if i % 5 == 0 else [] if i % 5 == 1 else [None, i] for i in range(n)], pa.list_(pa.int64())),
                         **more})
    root = str(tmp_path / "t")
    _write(f"{root}/day=1/a.parquet", table(0, 100), row_group_size=30)
    _write(f"{root}/day=2/b.parquet", table(100, 250, late=pa.array(["y"] * 150)), write_statistics=False, row_group_size=40)
    _write(f"{root}/day=__HIVE_DEFAULT_PARTITION__/c.parquet", table(0, 10), write_statistics=["id"])
    _write(f"{root}/day=2/empty.parquet", table(0, 0))
    _write(f"{root}/day=2/_hidden.parquet", table(0, 7))
    return root


def test_profile_equals_the_scan_with_and_without_statistics(spark, tmp_path):
    root = _tree(tmp_path)
    _write(f"{root}/day=a%3Ab/d.parquet", pa.table({"id": [1, 2], "s": pa.array([None, "x"])}))
    want = null_profile(bronze_scan(spark, root, ["day"], PART))
    for at in (root, f"file://{root}"):
        got = footer_null_profile(spark, at, PART, ["day"])
        assert got.columns == want.columns and rows(got) == rows(want)


def test_only_columns_without_a_null_count_are_read(spark, tmp_path, monkeypatch):
    root = _tree(tmp_path)
    files = spark.createDataFrame([(f"{root}/day=1/a.parquet",), (f"{root}/day=2/b.parquet",)], "path string")
    got = footer_counts(files, ["id", "s", "l", "late"], ["day"])
    left = {(r["path"].rsplit("/", 1)[1], r["name"], r["row_group"]) for r in got.where("path IS NOT NULL").collect()}
    assert left == ({("a.parquet", "l", g) for g in range(4)}
                    | {("b.parquet", c, g) for c in ("id", "s", "l", "late") for g in range(4)})
    read = []
    real = pq.ParquetFile.iter_batches
    monkeypatch.setattr(pq.ParquetFile, "iter_batches", lambda self, *a, **k: (
        read.append((k["row_groups"], k["columns"])), real(self, *a, **k))[1])
    assert footers._read_counts([("id", f"{root}/day=2/b.parquet", 1)]) == {"id": 27}
    assert read == [([1], ["id"])]


def test_files_with_statistics_give_nothing_to_read(spark, tmp_path):
    out = str(tmp_path / "own")
    spark.range(1000).select("id", F.when(F.col("id") % 7 == 0, "x").alias("s")).repartition(3).write.parquet(out)
    files = spark.createDataFrame([(os.path.join(out, f),) for f in os.listdir(out) if f.endswith(".parquet")], "path string")
    assert footer_counts(files, ["id", "s"], []).where("path IS NOT NULL").isEmpty()
    got = footer_null_profile(spark, out, spark.read.parquet(out).schema)
    assert rows(got) == [(1000, 1000, 143)]


def test_empty_folder(spark, tmp_path):
    os.makedirs(tmp_path / "none")
    assert rows(footer_null_profile(spark, str(tmp_path / "none"), PART, ["day"])) == [(0, 0, 0, 0, 0, 0)]
