"""Commits: one statement per version, crashes at every statement, interleaved writers."""

import uuid

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tierload.config import DateValidation, SilverDataset
from tierload.operators import upsert_overwrite
from tierload.plans.gold import GoldLoad
from tierload.plans.silver import SilverLoad
from tierload.plans.tables import ConcurrentCommit, SnapshotTable


def _name(label):
    return f"{label}_{uuid.uuid4().hex[:8]}"


class Crash(BaseException):
    """Not an ``Exception``: nothing on the way may handle it."""


class Crashing:
    """Stops the driver at its ``at``-th catalog statement, before or after it runs."""

    def __init__(self, monkeypatch, at, after):
        self.seen, sql = 0, SnapshotTable._sql

        def run(table, statement):
            self.seen += 1
            if self.seen == at and not after:
                raise Crash(statement)
            out = sql(table, statement)
            if self.seen == at:
                raise Crash(statement)
            return out
        monkeypatch.setattr(SnapshotTable, "_sql", run)


def _bronze(spark, n):
    """Batches 1 ... n, two rows each."""
    df = spark.createDataFrame([(10 * b + i, f"2024-01-0{b}", f"b{b}") for b in range(1, n + 1) for i in (1, 2)],
                               "id int, ingestion_date string, batch_id string")
    return df.withColumn("modified_at", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))


def _load(spark, prefix, mode, n):
    ds = SilverDataset(name="t", pk=["id"], cursor="modified_at", mode=mode)
    return SilverLoad(spark, lambda _: _bronze(spark, n), DateValidation(), prefix, 2, "2026-01-01 00:00:00").run_one(ds)


@pytest.mark.parametrize("mode", ["append_only", "dedupe_latest"])
@pytest.mark.parametrize("first", [0, 1])
def test_a_crash_at_any_statement_loads_each_row_once(spark, monkeypatch, mode, first):
    statements, at = 99, 1
    while at <= statements:
        for after in (False, True):
            prefix = f"{_name('crash')}_"
            if first:
                _load(spark, prefix, mode, 1)
            with monkeypatch.context() as m:
                crash = Crashing(m, at, after)
                try:
                    _load(spark, prefix, mode, 2)
                    statements = crash.seen
                except Crash:
                    pass
            before = sorted(r["id"] for r in spark.table(f"{prefix}t").collect()) if spark.catalog.tableExists(f"{prefix}t") else []
            assert before in ([], [11, 12], [11, 12, 21, 22])          # never a part of a batch
            _load(spark, prefix, mode, 3)
            assert sorted(r["id"] for r in spark.table(f"{prefix}t").collect()) == [11, 12, 21, 22, 31, 32], (at, after)
        at += 1
    assert 2 <= statements < 99


def test_append_and_its_properties_are_one_commit(spark, monkeypatch):
    """A replayed epoch finds itself done, or finds nothing of itself."""
    for at in (1, 2, 3):
        for after in (False, True):
            t = SnapshotTable(spark, _name("epoch"))
            df = spark.createDataFrame([(1,)], "id int")
            t.append(df, {"tierload.stream.s": "0"})
            with monkeypatch.context() as m:
                Crashing(m, at, after)
                with pytest.raises(Crash):
                    t.append(df, {"tierload.stream.s": "1"})
            if int(t.stored_prop("tierload.stream.s")) < 1:
                t.append(df, {"tierload.stream.s": "1"})
            assert t.stored_prop("tierload.stream.s") == "1" and spark.table(t.name).count() == 2
            t.append(df)
            assert t.stored_prop("tierload.stream.s") == "1" and spark.table(t.name).count() == 3   # kept by later versions


def test_readers_see_whole_versions(spark):
    """A view opened before keeps its rows; a segment that was not committed is not read."""
    t = SnapshotTable(spark, _name("seg"))
    v1 = t.append(spark.createDataFrame([(1,)], "id int"))
    t._write_segment(spark.createDataFrame([(99,)], "id int"), t._data(v1))       # a writer that died here
    v2 = t.append(spark.createDataFrame([(2,)], "id int"))
    assert rows(spark.table(t.name)) == [(1,), (2,)] and rows(spark.table(v1)) == [(1,)]
    assert rows(t.read(version=v1)) == [(1,)] and rows(t.read(version=v2)) == [(1,), (2,)]
    plan = spark.table(v1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(tierload_segment" in plan


def test_two_interleaved_merges_lose_no_row(spark):
    name = _name("race")
    a, b = (SnapshotTable(spark, name, key=["id"], buckets=4) for _ in range(2))
    a.write(spark.range(40).select("id", F.lit(0).alias("v")))
    one, two = (spark.createDataFrame([(i, v), (100 + v, v)], "id long, v int") for i, v in ((7, 1), (8, 2)))
    calls = []

    def slow(current):
        calls.append(1)
        if len(calls) == 1:               # the other writer commits while this one merges
            b.merge(two.select("id"), lambda cur: upsert_overwrite(cur, two, ["id"], b.join_partitions()))
        return upsert_overwrite(current, one, ["id"], a.join_partitions())
    done = a.merge(one.select("id"), slow)
    got = {r["id"]: r["v"] for r in spark.table(name).collect()}
    assert len(calls) == 2 and (got[7], got[8], got[101], got[102]) == (1, 2, 1, 2)
    assert len(got) == spark.table(name).count() == done.rows == 42


def test_two_appends_from_one_state_load_a_batch_once(spark, monkeypatch):
    prefix = f"{_name('twice')}_"
    _load(spark, prefix, "append_only", 1)
    append, calls = SnapshotTable.append, []

    def late(table, df, *a, **k):
        calls.append(1)
        if len(calls) == 1:
            _load(spark, prefix, "append_only", 2)     # another run loads the batch first
        return append(table, df, *a, **k)
    monkeypatch.setattr(SnapshotTable, "append", late)
    _load(spark, prefix, "append_only", 2)
    assert len(calls) == 3
    assert sorted(r["id"] for r in spark.table(f"{prefix}t").collect()) == [11, 12, 21, 22]


def test_plain_appends_of_two_writers_both_stay(spark, monkeypatch):
    name = _name("both")
    a, b = SnapshotTable(spark, name), SnapshotTable(spark, name)
    commit, calls = SnapshotTable._commit, []

    def late(table, *args, **k):
        calls.append(1)
        if len(calls) in (1, 3):
            b.append(spark.createDataFrame([(10 * len(calls),)], "id int"))
        return commit(table, *args, **k)
    monkeypatch.setattr(SnapshotTable, "_commit", late)
    a.append(spark.createDataFrame([(1,)], "id int"))         # both create the table
    a.append(spark.createDataFrame([(2,)], "id int"))
    assert sorted(r["id"] for r in spark.table(name).collect())[:2] == [1, 2] and spark.table(name).count() == 4


def test_a_slow_publisher_does_not_take_the_name_back(spark):
    t = SnapshotTable(spark, _name("slow"))
    v1 = t.write(spark.createDataFrame([(1,)], "id int"))
    v2 = t.write(spark.createDataFrame([(2,)], "id int"))
    assert t._save_state(v1) == v2 and rows(spark.table(t.name)) == [(2,)]


def test_watermarks_of_two_runs_both_stay(spark):
    from tierload.plans.gold_frames import save_watermarks
    load = GoldLoad(spark, lambda _: None, watermark_table=_name("wm"), run_ts="2026-01-01 00:00:00")
    store = load.ensure_store()

    def entry(source):
        return spark.createDataFrame([(source, "2024-01-01 00:00:00")], "source_table string, w string").select(
            "source_table", F.col("w").cast("timestamp_ntz").alias("last_watermark"))
    calls = []

    def slow(current):
        calls.append(1)
        if len(calls) == 1:
            load.store().merge(entry("b").select("source_table"), lambda cur: save_watermarks(cur, entry("b"), load.run_ts))
        return save_watermarks(current, entry("a"), load.run_ts)
    store.merge(entry("a").select("source_table"), slow)
    assert sorted(r["source_table"] for r in store.read().collect()) == ["a", "b"]


def test_rows_per_bucket_are_kept_with_the_version(spark, monkeypatch):
    t = SnapshotTable(spark, _name("rows"), key=["id"], buckets=8)
    t.write(spark.range(1000).select("id", F.lit(0).alias("v")))
    src = spark.createDataFrame([(7, 1), (5000, 1)], "id long, v int")

    def merge():
        return t.merge(src.select("id"), lambda cur: upsert_overwrite(cur, src, ["id"], t.join_partitions()))
    assert merge().rows == 1001
    counted, count = [], SnapshotTable._count_buckets
    monkeypatch.setattr(SnapshotTable, "_count_buckets", lambda s, d, b: counted.extend(b) or count(s, d, b))
    done = merge()
    assert done.rows == 1001 and sorted(counted) == done.touched       # carried buckets are not opened


def test_a_failing_statement_is_no_conflict(spark):
    t = SnapshotTable(spark, _name("bad"))
    v = t.write(spark.createDataFrame([(1,)], "id int"))
    with pytest.raises(Exception) as e:
        t._commit(v, lambda _: {"tierload.data": "no_such_table"}, rebase=True)
    assert not isinstance(e.value, ConcurrentCommit) and t.current_version() == v
