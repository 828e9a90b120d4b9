"""Digest reconciliation: equal to the plain join, equal buckets unread."""

import uuid

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tierload.operators import reconcile_by_digest, reconcile_missing_keys
from tierload.operators.reconcile import BUCKET, differing_buckets, key_digests
from tierload.plans import reconcile as R
from tierload.plans.tables import SnapshotTable

SCHEMA = "a bigint, b string, v string"


def _frame(spark, keys):
    return spark.createDataFrame([(a, b, f"v{a}{b}") for a, b in keys], SCHEMA)


@pytest.mark.parametrize("target, source", [
    ([(1, "x"), (2, "y"), (None, "z"), (3, None)], [(1, "x"), (None, "z"), (3, None)]),
    ([(1, "x"), (1, "x"), (2, "y")], [(2, "y"), (2, "y"), (9, "q")]),       # repeats on both sides
    ([(1, "x"), (1, "x")], [(2, "x"), (2, "x")]),                           # pairs must not cancel out
    ([], [(1, "x")]), ([(1, "x")], []), ([], []),
])
@pytest.mark.parametrize("buckets", [1, 7])
def test_equals_the_plain_join(spark, target, source, buckets):
    t, s = _frame(spark, target), _frame(spark, source)
    want = reconcile_missing_keys(t, s, ["a", "b"])
    got = reconcile_by_digest(t, s, ["a", "b"], buckets=buckets)
    assert got.columns == want.columns and rows(got) == rows(want)


def test_keys_of_another_type_are_joined(spark):
    t = _frame(spark, [(1, "x"), (2, "y")])
    s = spark.createDataFrame([(1, "x")], "a int, b string")
    assert [r[-1] for r in rows(reconcile_by_digest(t, s, ["a", "b"]))] == [False, True]


def test_only_the_buckets_of_changed_keys_differ(spark):
    t = spark.range(5000).toDF("id")
    s = t.where("id not in (17, 4000)")
    got = differing_buckets(key_digests(t, ["id"], 64), key_digests(s, ["id"], 64))
    want = t.where("id in (17, 4000)").select(F.pmod(F.hash("id"), F.lit(64)).alias(BUCKET)).distinct()
    assert rows(got) == rows(want)


def test_digests_are_combined_before_the_shuffle(spark):
    p = key_digests(spark.range(10).toDF("id"), ["id"], 8)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in p and "Python" not in p


def _table(spark, n=400, buckets=8):
    t = SnapshotTable(spark, f"rec_{uuid.uuid4().hex[:8]}", key=["id"], buckets=buckets)
    t.write(spark.range(n).select("id", (F.col("id") * 2).alias("v")))
    return t


def test_table_flags_unflags_and_leaves_equal_buckets_unread(spark, monkeypatch):
    t = _table(spark)
    every = spark.range(400).toDF("id")
    v0 = t.current_version()
    assert R.reconcile_table(t, every) == []                      # equal: nothing compared, no data written
    assert t.current_version() == v0 or t.bucket_folders() == t.bucket_folders(v0)
    before, base = t.bucket_folders(), t.current_version()

    read = []
    plain = SnapshotTable.read
    monkeypatch.setattr(SnapshotTable, "read", lambda self, buckets=None, version=None: (
        read.append((self.name, buckets)), plain(self, buckets, version))[1])
    hit = every.where("id in (5, 6)").select(F.pmod(F.hash("id"), F.lit(8)).alias("b")).distinct().collect()
    hit = sorted(r["b"] for r in hit)
    assert R.reconcile_table(t, every.where("id not in (5, 6)")) == hit
    # whole-table frames are only asked for their columns; rows come from the buckets that differ
    assert {tuple(b) for n, b in read if n == t.name and b is not None} == {tuple(hit)}
    monkeypatch.undo()
    assert t.current_version() != base
    after = t.bucket_folders()
    assert [b for b in before if before[b] != after[b]] == hit
    assert rows(t.read().where("is_deleted").select("id")) == [(5,), (6,)]
    assert t.read().count() == 400 and t.read().where("v = 2 * id").count() == 400

    assert R.reconcile_table(t, every.where("id <> 6")) == sorted(
        r["b"] for r in every.where("id = 5").select(F.pmod(F.hash("id"), F.lit(8)).alias("b")).collect())
    assert rows(t.read().where("is_deleted").select("id")) == [(6,)]
    last = t.current_version()
    assert R.reconcile_table(t, every.where("id <> 6")) == [] and t.current_version() == last


def test_source_keys_that_are_not_loaded_yet_write_nothing(spark):
    t = _table(spark, 50)
    R.reconcile_table(t, spark.range(50).toDF("id"))
    v = t.current_version()
    assert len(R.reconcile_table(t, spark.range(52).toDF("id"))) in (1, 2)
    assert t.current_version() == v


def test_only_rewritten_buckets_are_digested_again(spark):
    t = _table(spark)
    every = spark.range(400).toDF("id")
    R.reconcile_table(t, every)
    kept = SnapshotTable(spark, f"{t.name}__digests")
    assert kept.read().count() == 8
    R.reconcile_table(t, every.where("id <> 5"))
    R.reconcile_table(t, every.where("id <> 5"))
    assert kept.read().count() == 9                               # one new folder


def test_table_with_null_keys_and_other_types(spark):
    t = SnapshotTable(spark, f"rec_{uuid.uuid4().hex[:8]}", key=["id"], buckets=4)
    t.write(spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "id int, v string"))
    assert R.reconcile_table(t, spark.range(1, 2).toDF("id")) is None           # bigint keys against int
    assert rows(t.read().select("v", "is_deleted")) == [("a", False), ("b", True), ("c", True)]
    R.reconcile_table(t, spark.createDataFrame([(1,), (3,), (None,)], "id int"))
    assert rows(t.read().select("v", "is_deleted")) == [("a", False), ("b", True), ("c", False)]
    assert R.reconcile_table(t, spark.createDataFrame([(1,), (3,)], "id int")) == []
