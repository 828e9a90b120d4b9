"""JDBC staging + MERGE sink, SQL generation per dialect, streaming."""

import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from tierload import fixtures as fx
from tierload import registry as R
from tierload.plans.tables import SnapshotTable
from tierload.sources.catalog import add_partitions, register_table, show_partitions
from tierload.operators import SchemaGuardError
from tierload.sources.jdbc import JdbcTarget, merge_sql
from tierload.sources.paths import distinct_partitions, parse_folders
from tierload.streaming.bronze_stream import stream_silver


def test_merge_sql_dialects():
    pg = merge_sql("t", "s", ["id", "v"], ["id"], "jdbc:postgresql://h/db")
    assert 'ON CONFLICT ("id") DO UPDATE SET "v" = EXCLUDED."v"' in pg
    assert "DO NOTHING" in merge_sql("t", "s", ["a", "b"], ["a", "b"], "jdbc:postgresql://h/db")
    std = merge_sql("t", "s", ["id", "v"], ["id"], "jdbc:other:x")
    assert std.startswith("MERGE INTO \"t\" t USING \"s\" s ON t.\"id\" = s.\"id\"")
    assert "WHEN MATCHED" not in merge_sql("t", "s", ["a"], ["a"], "jdbc:other:x")
    assert merge_sql("Sales.T", "Sales.s", ["a"], ["a"], "jdbc:postgresql://h/db").startswith(
        'INSERT INTO "Sales"."T" ("a") SELECT "a" FROM "Sales"."s" ')


class Recorder(JdbcTarget):
    """A target that keeps the statements it would send: no database is started."""

    def __init__(self, spark, url="jdbc:postgresql://h/db", columns=(), key=(), runs=None, fail=""):
        super().__init__(spark, url)
        self.sent, self.staged, self.columns, self.key = [], [], list(columns), list(key)
        self.tables = {"T"} if columns else set()
        self.runs, self.fail = dict(runs or {}), fail
        if runs is not None:
            self.tables.add("T_runs")

    def execute(self, *statements):
        self.sent.append(statements)
        if self.fail and any(self.fail in s for s in statements):
            raise RuntimeError("rolled back")
        for s in statements:
            if s.startswith("CREATE TABLE "):
                self.tables.add(s.split()[2].replace('"', ""))
            elif s.startswith("DROP TABLE "):
                self.tables.discard(s.split()[2].replace('"', ""))
            elif s.startswith('INSERT INTO "T_runs" '):
                run, n = s[s.index("VALUES (") + 8:-1].rsplit(", ", 1)
                assert run not in self.runs, "primary key"
                self.runs[run] = n

    def query(self, statement):
        self.sent.append((statement,))
        run = statement.split(" = ", 1)[1]
        return [(self.runs[run],)] if run in self.runs else []

    def table_exists(self, table):
        return table in self.tables

    def existing_columns(self, table):
        return self.columns

    def primary_key(self, table):
        return self.key

    def stage(self, df, staging, batch, max_connections):
        self.tables.add(staging)
        self.staged.append(df)
        return df.count()

    def statements(self):
        return [s for group in self.sent for s in group]


def _pair(spark, n=2):
    return spark.createDataFrame([(f"A{i}", 0.0) for i in range(n)], "id string, v double")


def test_upsert_creates_stages_merges_and_drops(spark):
    t = Recorder(spark)
    assert t.upsert(_pair(spark), "T", ["id"]) == 2
    create, merge, drop = t.statements()
    assert create == 'CREATE TABLE "T" ("id" TEXT NOT NULL, "v" DOUBLE PRECISION, PRIMARY KEY ("id"))'
    assert merge.startswith('INSERT INTO "T" ') and 'DO UPDATE SET "v" = EXCLUDED."v"' in merge
    assert drop.startswith('DROP TABLE "T_stg_') and t.tables == {"T"}
    assert Recorder(spark).upsert(_pair(spark, 0).limit(0), "T", ["id"]) == 0


def test_empty_load_merges_nothing(spark):
    t = Recorder(spark)
    t.upsert(_pair(spark).limit(0), "T", ["id"])
    assert not [s for s in t.statements() if s.startswith(("INSERT", "MERGE"))]


def test_a_run_is_recorded_by_the_transaction_of_its_merge_and_not_repeated(spark):
    t = Recorder(spark)
    assert t.upsert(_pair(spark), "T", ["id"], run_id="r'1") == 2
    both = [g for g in t.sent if len(g) == 2]
    assert len(both) == 1
    assert both[0][0] == "INSERT INTO \"T_runs\" (\"run_id\", \"n_rows\") VALUES ('r''1', 2)"
    assert both[0][1].startswith('INSERT INTO "T" (')
    before, staged = len(t.sent), len(t.staged)
    t.columns, t.key = [("id", "string"), ("v", "double")], ["id"]
    assert t.upsert(_pair(spark, 5), "T", ["id"], run_id="r'1") == 2          # the recorded number
    assert len(t.staged) == staged
    assert [s.split()[0] for g in t.sent[before:] for s in g] == ["SELECT"]
    assert t.upsert(_pair(spark, 5), "T", ["id"], run_id="r2") == 5


def test_an_empty_run_is_recorded(spark):
    t = Recorder(spark)
    t.upsert(_pair(spark).limit(0), "T", ["id"], run_id="r")
    assert t.runs == {"'r'": "0"} and not [s for s in t.statements() if s.startswith('INSERT INTO "T" (')]


def test_a_merge_that_fails_takes_its_record_along_and_drops_staging(spark):
    t = Recorder(spark, fail="ON CONFLICT")
    with pytest.raises(RuntimeError):
        t.upsert(_pair(spark), "T", ["id"], run_id="r")
    assert t.runs == {} and t.tables == {"T", "T_runs"}
    t.fail, t.columns, t.key = "", [("id", "string"), ("v", "double")], ["id"]
    assert t.upsert(_pair(spark), "T", ["id"], run_id="r") == 2 and t.runs == {"'r'": "2"}


def test_an_existing_target_gets_new_columns(spark):
    t = Recorder(spark, columns=[("id", "string"), ("old", "int")], key=["id"])
    t.upsert(_pair(spark), "T", ["id"])
    assert t.statements()[0] == 'ALTER TABLE "T" ADD COLUMN "v" DOUBLE PRECISION'
    assert '"old"' not in t.statements()[1]


@pytest.mark.parametrize("columns, key", [
    ([("id", "string"), ("v", "string")], ["id"]),         # another type
    ([("id", "string"), ("v", "double")], ["id", "v"]),    # another key
    ([("id", "string"), ("v", "double")], []),             # no key at all
    ([("id", "string")], ["v"]),                           # refused before the column is added
])
def test_a_changed_key_or_type_is_refused_before_anything_is_sent(spark, columns, key):
    t = Recorder(spark, columns=columns, key=key)
    with pytest.raises(SchemaGuardError):
        t.upsert(_pair(spark), "T", ["id"])
    assert t.sent == [] and t.staged == []


class Meta:
    """Metadata of a connection: what it is asked, and one stored table."""

    def __init__(self, stored=()):
        self.asked, self.stored = [], stored

    def getSearchStringEscape(self):
        return "!"

    def getTables(self, catalog, schema, table, types):
        self.asked.append((schema, table))
        return self

    def next(self):
        return self.asked[-1] in self.stored


def test_names_are_searched_as_written_and_without_wildcards():
    assert JdbcTarget._name(Meta(), "a_b.T_1") == ("a!_b", "T!_1")
    assert JdbcTarget._name(Meta(), "T") == (None, "T")


def test_a_table_of_another_spelling_is_another_table(spark):
    t, md = JdbcTarget(spark, "jdbc:postgresql://h/db"), Meta(stored=[("sales", "orders")])

    class Connection:
        def getMetaData(self):
            return md

        def close(self):
            pass

    t._connection = Connection
    assert t.table_exists("sales.orders") and not t.table_exists("sales.Orders") and not t.table_exists("orders")


def test_the_target_schema_qualifies_every_statement(spark):
    t = Recorder(spark)
    t.schema = "sales"
    assert t.upsert(_pair(spark), "T", ["id"], run_id="r") == 2
    assert all('"sales"."T' in s for s in t.statements())
    assert {x for x in t.tables} == {"sales.T", "sales.T_runs"}
    assert t.full_name("other.T") == "other.T"


def test_stream_matches_batch_for_rising_cursors(spark, tmp_path):
    """Micro-batches merged one by one give the initial load over all
    files when every key's cursor rises with its batches."""
    src = spark.range(0, 400).select(
        (F.col("id") % 40).alias("k"), F.col("id").alias("seq"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id)").alias("cur"),
        F.lit("2024-01-01").alias("ingestion_date"),
        F.format_string("b%03d", (F.col("id") / 50).cast("int")).alias("batch_id"))
    loc = str(tmp_path / "bronze")
    src.repartition("batch_id").write.partitionBy("ingestion_date", "batch_id").parquet(loc)
    from tierload.config import DateValidation, SilverDataset
    ds = SilverDataset(name="s", pk=["k"], cursor="cur")
    table = SnapshotTable(spark, f"stream_{uuid.uuid4().hex[:8]}", key=["k"], buckets=4)
    q = stream_silver(spark, loc, spark.read.parquet(loc).schema, ["ingestion_date", "batch_id"],
                      table, ds, str(tmp_path / "cp"), DateValidation(), "2026-01-01 00:00:00",
                      "2026-01-01 00:00:00", max_files_per_trigger=2)
    q.awaitTermination()
    got = rows(spark.table(table.name).select("k", "seq", "_source_batch_id"))
    want = rows(src.groupBy("k").agg(F.max("seq").alias("seq"))
                .join(src.select("seq", F.col("batch_id").alias("_source_batch_id")), "seq")
                .select("k", "seq", "_source_batch_id"))
    assert got == want


def test_append_stream_takes_a_replayed_epoch_once(spark, tmp_path):
    from tierload.config import DateValidation, SilverDataset
    from tierload.streaming.bronze_stream import merge_batches
    src = spark.range(0, 60).select("id", F.lit("2024-01-01").alias("ingestion_date"),
                                    F.format_string("b'%d", (F.col("id") / 20).cast("int")).alias("batch_id"))
    loc, cp = str(tmp_path / "bronze"), str(tmp_path / "cp")
    src.repartition("batch_id").write.partitionBy("ingestion_date", "batch_id").parquet(loc)
    ds = SilverDataset(name="s", pk=["id"], cursor="id", mode="append_only")
    table = SnapshotTable(spark, f"stream_{uuid.uuid4().hex[:8]}")
    args = (DateValidation(), "2026-01-01 00:00:00", "2026-01-01 00:00:00")
    stream_silver(spark, loc, spark.read.parquet(loc).schema, ["ingestion_date", "batch_id"], table, ds, cp,
                  *args, max_files_per_trigger=1).awaitTermination()
    once = rows(spark.table(table.name).select("id"))
    assert sorted(once) == [(i,) for i in range(60)]
    replay = merge_batches(table, ds, *args, cp)
    for epoch in (0, 1, 2):                                  # what a restart after a failure would do
        replay(src.where(F.col("batch_id") == f"b'{epoch}"), epoch)
    assert rows(spark.table(table.name).select("id")) == once
    replay(src.limit(1), 3)                                   # the next epoch is taken
    assert spark.table(table.name).count() == 61


def test_partition_values_with_special_characters(spark, tmp_path):
    df = spark.createDataFrame([(1, "a+b c"), (2, "x%y")], "v int, p string")
    df.write.partitionBy("p").parquet(str(tmp_path / "DS"))
    keys = spark.read.format("binaryFile").option("recursiveFileLookup", "true") \
        .load(str(tmp_path)).select(F.regexp_extract("path", r"(DS/.*)$", 1).alias("key"))
    parts = distinct_partitions(parse_folders(keys.where(F.col("key").endswith(".parquet")), "key"))
    parts = parts.withColumn("location", F.concat(F.lit(str(tmp_path) + "/"), "location"))
    name = f"special_{uuid.uuid4().hex[:8]}"
    register_table(spark, name, str(tmp_path / "DS"), spark.createDataFrame([], "v int").schema, ["p"])
    assert add_partitions(spark, name, ["p"], parts, "DS") == (2, 0)
    assert add_partitions(spark, name, ["p"], parts, "DS") == (0, 0)
    assert sorted(r["p"] for r in spark.table(name).select("p").distinct().collect()) == \
        sorted(r["p"] for r in show_partitions(spark, name).collect())


def test_gold_loader_with_jdbc_copy(spark):
    from tierload.config import GoldSettings
    from tierload.plans.gold import load_gold
    tag = uuid.uuid4().hex[:8]
    target = Recorder(spark)
    silver = fx.silver_orders(spark, SF_SMALL)
    summary = load_gold(spark, lambda _: silver, [R.ORDERS_GOLD], GoldSettings(),
                        table_prefix=f"g{tag}_", watermark_table=f"g{tag}_wm", jdbc=target, run_id="day1").first()
    assert summary["status"] == "OK"
    gold = spark.table(f"g{tag}_{R.ORDERS_GOLD.target_table}")
    assert rows(target.staged[0].select(*gold.columns)) == rows(gold)
    assert f"'day1:{R.ORDERS_GOLD.target_table}'" in "".join(target.statements())
    wm = spark.table(f"g{tag}_wm").first()
    assert wm["last_watermark"] == silver.agg(F.max("o_orderdate")).first()[0]
