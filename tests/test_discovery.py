"""Task-side listing and the partition ledger."""

import os
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import rows
from tierload.cli import run
from tierload.plans import crawl as crawl_module
from tierload.plans.crawl import crawl
from tierload.plans.tables import SnapshotTable
from tierload.sources import catalog
from tierload.sources.ledger import PartitionLedger
from tierload.sources.listing import index_files, list_files, walk


def _db(spark, label):
    db = f"{label}_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db}")
    return db


def _tree(root):
    """Hidden and underscored names, an empty folder, a deep branch and a wide one."""
    names = ["top.parquet", "DS/_x/a.parquet", "DS/.y/b.PARQUET", "DS/_SUCCESS", "DS/d=1/.hidden.parquet", "DS/d=a b%20ü/c.parquet",
             "/".join(["deep"] * 12) + "/z.parquet"] + [f"wide/w={i}/f{i}.parquet" for i in range(60)]
    for i, n in enumerate(names):
        path = root / n
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"x" * i)
    (root / "empty" / "folder").mkdir(parents=True)


def _walked(root, below=""):
    out = []
    for folder, _, files in os.walk(os.path.join(root, below)):
        for f in files:
            path = os.path.join(folder, f)
            out.append((os.path.relpath(path, root), os.path.getsize(path), os.stat(path).st_mtime_ns // 1_000_000))
    return sorted(out)


@pytest.mark.parametrize("folders", [1, 7, 256])
def test_listing_equals_a_directory_walk(spark, tmp_path, folders):
    _tree(tmp_path)
    got = sorted(tuple(r) for r in walk(spark, str(tmp_path), "", folders).select("key", "length", "modified").collect())
    assert got == _walked(tmp_path)


def test_listing_of_a_prefix_by_path_and_uri(spark, tmp_path):
    _tree(tmp_path)
    want = [k for k, _, _ in _walked(tmp_path, "DS") if k.lower().endswith(".parquet")]
    for root in (str(tmp_path), f"file:{tmp_path}", f"file://{tmp_path}/"):
        assert sorted(r["key"] for r in list_files(spark, root, "/DS/").collect()) == want
    assert list_files(spark, str(tmp_path), "empty").count() == 0
    assert list_files(spark, str(tmp_path), "DS", parquet_only=False).count() == len(_walked(tmp_path, "DS"))
    with pytest.raises(Exception):
        list_files(spark, str(tmp_path), "missing").count()


def test_listing_agrees_with_the_file_index(spark, tmp_path):
    _tree(tmp_path)
    seen = rows(index_files(spark, str(tmp_path)))
    mine = {r[0]: r for r in rows(list_files(spark, str(tmp_path), parquet_only=False))}
    assert seen and all(mine[r[0]] == r for r in seen)


def test_links_to_folders_are_not_followed(spark, tmp_path):
    (tmp_path / "DS").mkdir()
    (tmp_path / "DS" / "a.parquet").write_bytes(b"x")
    os.symlink(tmp_path, tmp_path / "DS" / "up")
    assert [r["key"] for r in list_files(spark, str(tmp_path)).collect()] == ["DS/a.parquet"]


def _day(root, day, kind, n=5):
    folder = root / "DS" / f"Day={day}"
    folder.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.table({"v": pa.array(range(n), kind)}), folder / "part-0.parquet")


def _retype(root, days):
    for d in days:
        _day(root, d, pa.int64())


def test_a_type_change_keeps_every_row(spark, tmp_path):
    """Folder names that are not lower case: only the stored location finds them."""
    db = _db(spark, "retype")
    for d in (1, 2):
        _day(tmp_path, d, pa.int32())
    first = crawl(spark, str(tmp_path), "", db).first()
    assert (first["action"], first["partitions_created"], spark.table(f"{db}.ds").count()) == ("created", 2, 10)
    _retype(tmp_path, (1, 2))
    for _ in range(2):
        again = crawl(spark, str(tmp_path), "", db).first()
        assert (again["action"], again["partitions_created"], again["partitions_failed"]) == ("updated", 0, 0)
        assert dict(spark.table(f"{db}.ds").dtypes)["v"] == "bigint" and spark.table(f"{db}.ds").count() == 10
    _day(tmp_path, 3, pa.int64())
    assert crawl(spark, str(tmp_path), "", db).first()["partitions_created"] == 1
    assert spark.table(f"{db}.ds").count() == 15
    assert sorted(rows(PartitionLedger(spark, f"{db}.partition_ledger").read().select("dataset", "values_key"))) == [
        ("DS", "1"), ("DS", "2"), ("DS", "3")]


def test_a_type_change_without_a_ledger_asks_the_catalog(spark, tmp_path):
    db = _db(spark, "noledger")
    for d in (1, 2):
        _day(tmp_path, d, pa.int32())
    crawl(spark, str(tmp_path), "", db).collect()
    spark.sql(f"ALTER TABLE {db}.ds UNSET TBLPROPERTIES ('{catalog.SETTLED_PROP}')")     # as an earlier release left it
    _retype(tmp_path, (1, 2))
    schema = spark.read.parquet(str(tmp_path / "DS" / "Day=1")).schema
    assert catalog.register_table(spark, f"{db}.ds", f"{tmp_path}/DS/", schema, ["day"]) == "updated"
    assert spark.table(f"{db}.ds").count() == 10


def test_a_vanished_partition_is_kept(spark, tmp_path):
    db = _db(spark, "vanish")
    for d in (1, 2):
        _day(tmp_path, d, pa.int32())
    crawl(spark, str(tmp_path), "", db).collect()
    (tmp_path / "DS" / "Day=2" / "part-0.parquet").unlink()
    _retype(tmp_path, (1,))
    crawl(spark, str(tmp_path), "", db).collect()
    assert [r[0] for r in rows(catalog.show_partitions(spark, f"{db}.ds"))] == ["1", "2"]


def test_a_cut_off_registration_is_taken_up_again(spark, tmp_path, monkeypatch):
    """A crash before the catalog has them, or before the ledger has them; also for a table that was dropped."""
    class Crash(BaseException):
        pass

    def crash(*a, **k):
        raise Crash

    db = _db(spark, "cut")
    for d in (1, 2):
        _day(tmp_path, d, pa.int32())
    for where in (lambda m: m.setattr(catalog, "_add_chunk", crash), lambda m: m.setattr(PartitionLedger, "add", crash),
                  lambda m: m.setattr(crawl_module, "settle", crash)):
        for drop in (False, True):
            if drop:
                spark.sql(f"DROP TABLE {db}.ds")
            with monkeypatch.context() as m:
                where(m)
                try:
                    crawl(spark, str(tmp_path), "", db).collect()
                except Crash:
                    pass
    crawl(spark, str(tmp_path), "", db).collect()
    assert spark.table(f"{db}.ds").count() == 10
    assert PartitionLedger(spark, f"{db}.partition_ledger").read().count() == 2


def test_nothing_new_writes_no_segment(spark, tmp_path):
    db = _db(spark, "idle")
    _day(tmp_path, 1, pa.int32())
    crawl(spark, str(tmp_path), "", db).collect()
    ledger = SnapshotTable(spark, f"{db}.partition_ledger")
    v = ledger.current_version()
    assert crawl(spark, str(tmp_path), "", db).first()["partitions_created"] == 0
    assert ledger.current_version() == v


def test_two_crawls_add_a_partition_once(spark):
    name = f"ledger_{uuid.uuid4().hex[:8]}"
    a = PartitionLedger(spark, name)
    found = spark.createDataFrame([("DS", ["1"], "/x/1"), ("DS", ["2"], "/x/2")], "dataset string, values array<string>, location string")
    late = spark.createDataFrame(a.missing(found).collect(), a.read().schema)
    PartitionLedger(spark, name).add(a.missing(found.where("location = '/x/1'")))
    a.add(late)
    assert sorted(r["location"] for r in a.read().collect()) == ["/x/1", "/x/2"] and a.missing(found).count() == 0


def test_failed_partitions_are_counted_and_the_exit_status_says_so(spark, tmp_path, monkeypatch):
    db = _db(spark, "failed")
    for d in (1, 2, 3):
        _day(tmp_path, d, pa.int32())
    sql = type(spark).sql

    def refuse(session, statement, *a, **k):
        if "ADD IF NOT EXISTS" in statement and "`day` = '2'" in statement:
            raise RuntimeError("refused")
        return sql(session, statement, *a, **k)
    with monkeypatch.context() as m:
        m.setattr(type(spark), "sql", refuse)
        assert run(spark, ["crawl", "--root", str(tmp_path), "--database", db]) == 1
    assert spark.table(f"{db}.ds").count() == 10
    again = crawl(spark, str(tmp_path), "", db).first()                  # tried again, as the ledger does not have it
    assert (again["partitions_created"], again["partitions_failed"]) == (1, 0)
    assert spark.table(f"{db}.ds").count() == 15
    assert run(spark, ["crawl", "--root", str(tmp_path), "--database", db]) == 0


def test_new_partitions_pass_no_partition_list(spark, tmp_path, monkeypatch):
    db = _db(spark, "nolist")
    _day(tmp_path, 1, pa.int32())
    crawl(spark, str(tmp_path), "", db).collect()
    _day(tmp_path, 2, pa.int32())
    asked, sql = [], type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda s, q, *a, **k: asked.append(q) or sql(s, q, *a, **k))
    assert crawl(spark, str(tmp_path), "", db).first()["partitions_created"] == 1
    assert asked and not any(q.startswith("SHOW PARTITIONS") for q in asked)


def test_folder_digests_see_every_change(spark):
    from tierload.sources.inventory import changed_folders, folder_digests
    base = [("DS", f"DS/d={d}/{f}.parquet", 10 * f, f"2024-01-0{f + 1} 00:00:00") for d in range(6) for f in range(3)]

    def digests(files):
        df = spark.createDataFrame(files, "dataset string, key string, length long, t string")
        return folder_digests(df.select("dataset", "key", "length", F.col("t").cast("timestamp_ntz").alias("modification_time")))
    now = [r for r in base if r[1] != "DS/d=1/0.parquet"]                                        # one vanished
    now = [(d, k, n + 1 if k == "DS/d=2/2.parquet" else n, t) for d, k, n, t in now]              # one grew
    now = [(d, k, n, "2025-01-01 00:00:00" if k == "DS/d=3/0.parquet" else t) for d, k, n, t in now]
    now += [("DS", "DS/d=4/9.parquet", 1, "2024-01-01 00:00:00"), ("DS", "DS/d=7/0.parquet", 1, "2024-01-01 00:00:00")]
    got = changed_folders(digests(now[::-1]), digests(base))
    assert [r[1] for r in rows(got)] == ["DS/d=1/", "DS/d=2/", "DS/d=3/", "DS/d=4/", "DS/d=7/"]
    assert changed_folders(digests(base[::-1]), digests(base)).count() == 0


def test_an_unchanged_tree_compares_no_file(spark, tmp_path, monkeypatch):
    db = _db(spark, "digest")
    for d in (1, 2, 3):
        _day(tmp_path, d, pa.int32())
    inventory = SnapshotTable(spark, f"{db}.files", key=["dataset", "key"], buckets=4)

    def again():
        return crawl(spark, str(tmp_path), "", db, inventory=f"{db}.files", inventory_buckets=4).first()
    assert again()["schema_source"] == "file" and inventory.read().count() == 3
    v = inventory.current_version()
    compared, files = [], crawl_module.changed_files
    monkeypatch.setattr(crawl_module, "changed_files", lambda listing, inv: compared.append(
        sorted(r["key"] for r in listing.collect())) or files(listing, inv))
    assert again()["schema_source"] == "cache" and compared == [] and inventory.current_version() == v
    _day(tmp_path, 2, pa.int32(), 50)
    _day(tmp_path, 4, pa.int32())
    again()
    assert compared == [["DS/Day=2/part-0.parquet", "DS/Day=4/part-0.parquet"]]
    sizes = {r["key"]: r["length"] for r in inventory.read().collect()}
    assert len(sizes) == 4 and sizes["DS/Day=2/part-0.parquet"] == (tmp_path / "DS/Day=2/part-0.parquet").stat().st_size
    _day(tmp_path, 1, pa.int64())                       # the sample file itself
    assert again()["schema_source"] == "file" and len(compared) == 2
    assert again()["schema_source"] == "cache" and len(compared) == 2
