"""Gold-side cases: batch cap, upsert value handling, DO NOTHING,
staging CSV, schema diff, type compatibility, mapping validation."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tierload.config import (ConfigError, GoldSettings, GoldTable, safe_batch_size,
                             validate_gold_config, validate_gold_table)
from tierload.functions.types import is_compatible_type
from tierload.operators import (ColumnMap, map_columns, schema_diff, upsert, upsert_do_nothing,
                                upsert_overwrite)
from tierload.operators.schema_ops import SchemaGuardError, guard
from tierload.sources.staging import staging_csv

SAMPLE = GoldTable("s_table", "dim_test", ["id"], [
    ColumnMap("s_id", "id", "string"), ColumnMap("s_flag", "flag", "boolean"),
    ColumnMap("s_qty", "quantity", "double"), ColumnMap("s_note", "note", "string")])


# ------------------------------------------------------------ batch size

def test_batch_size_kept_when_safe():
    assert safe_batch_size(2500, 24) == 2500


def test_batch_size_capped_for_wide_tables():
    assert safe_batch_size(2500, 83) == 789


def test_batch_size_rejects_zero_columns():
    with pytest.raises(ConfigError):
        safe_batch_size(100, 0)


def test_batch_size_rejects_row_over_limit():
    with pytest.raises(ConfigError):
        safe_batch_size(100, 70000)


# ---------------------------------------------------------------- upsert

def test_upsert_keeps_falsy_values_and_nulls(spark):
    target = spark.createDataFrame([("A1", False, 0.0, ""), ("A2", True, 5.0, "hello")],
                                   "id string, flag boolean, quantity double, note string")
    src = spark.createDataFrame([("A1", None, None, "x"), ("A3", False, 0.0, "")],
                                "id string, flag boolean, quantity double, note string")
    out = rows(upsert(target, src, ["id"]))
    assert out == [("A1", None, None, "x"), ("A2", True, 5.0, "hello"), ("A3", False, 0.0, "")]


def test_upsert_all_key_columns_does_nothing(spark):
    target = spark.createDataFrame([("a", "b")], "a string, b string")
    src = spark.createDataFrame([("a", "b"), ("a", "c")], "a string, b string")
    assert rows(upsert(target, src, ["a", "b"])) == [("a", "b"), ("a", "c")]
    assert rows(upsert_do_nothing(target, src, ["a", "b"])) == [("a", "b"), ("a", "c")]


def test_upsert_rejects_duplicate_source_keys(spark):
    target = spark.createDataFrame([("A1", 1)], "id string, v int")
    src = spark.createDataFrame([("A2", 1), ("A2", 2)], "id string, v int")
    with pytest.raises(ValueError):
        upsert(target, src, ["id"])


def test_upsert_latest_policy(spark):
    target = spark.createDataFrame([("A1", 1, 1)], "id string, v int, ts int")
    src = spark.createDataFrame([("A2", 1, 1), ("A2", 2, 5)], "id string, v int, ts int")
    out = rows(upsert(target, src, ["id"], duplicates="latest", cursor="ts"))
    assert out == [("A1", 1, 1), ("A2", 2, 5)]


def test_upsert_keeps_target_only_columns(spark):
    target = spark.createDataFrame([("A1", 1, "old")], "id string, v int, legacy string")
    src = spark.createDataFrame([("A1", 2), ("A2", 3)], "id string, v int")
    out = rows(upsert_overwrite(target, src, ["id"]))
    assert out == [("A1", 2, "old"), ("A2", 3, None)]


def test_upsert_twice_equals_once(spark):
    target = spark.createDataFrame([("A1", 1), ("A2", 2)], "id string, v int")
    src = spark.createDataFrame([("A2", 20), ("A3", 30)], "id string, v int")
    once = upsert(target, src, ["id"])
    assert rows(upsert(once, src, ["id"])) == rows(once)


# ---------------------------------------------------------------- mapping

def test_map_columns_missing_source_is_null_and_falsy_kept(spark):
    df = spark.createDataFrame([("A1", "", "0")], "s_id string, s_note string, s_qty string")
    out = map_columns(df, [ColumnMap("s_id", "id", "string"), ColumnMap("s_note", "note", "string"),
                           ColumnMap("s_qty", "quantity", "double"),
                           ColumnMap("s_missing", "extra", "string")])
    assert out.columns == ["id", "note", "quantity", "extra"]
    assert rows(out) == [("A1", "", 0.0, None)]


def test_map_columns_bad_text_raises(spark):
    df = spark.createDataFrame([("abc",)], "s_qty string")
    with pytest.raises(Exception):
        map_columns(df, [ColumnMap("s_qty", "quantity", "double")]).collect()


# ------------------------------------------------------------ staging CSV

def test_staging_csv_quotes_and_null_marker(spark):
    df = spark.createDataFrame([("A1", None, 'say "hi"', ""), ("A2", True, "a,b\nc", None)],
                               "id string, flag boolean, note string, other string")
    out = dict(rows(staging_csv(df, keep=["id"])))
    assert out["A1"] == '"A1",\\N,"say ""hi""",""'
    assert out["A2"] == '"A2","true","a,b\nc",\\N'


# ------------------------------------------------------------ schema diff

CONF = [("id", "text"), ("flag", "boolean"), ("quantity", "double precision"), ("note", "text")]


def test_diff_new_columns_to_add():
    d = schema_diff(CONF, ["id"], [("id", "text"), ("flag", "boolean")], ["id"])
    assert d.to_add == [("quantity", "double precision"), ("note", "text")]
    assert not d.type_mismatches and not d.pk_mismatch and not d.extra_in_existing


def test_diff_extra_columns_only_warned():
    d = schema_diff(CONF, ["id"], CONF + [("legacy_column", "text")], ["id"])
    assert d.extra_in_existing == ["legacy_column"]
    assert guard(d, "dim_test", ["id"], ["id"]) == []


def test_diff_type_mismatch_refused():
    existing = [("id", "text"), ("flag", "text"), ("quantity", "double precision"), ("note", "text")]
    d = schema_diff(CONF, ["id"], existing, ["id"])
    assert d.type_mismatches == [("flag", "text", "boolean")]
    with pytest.raises(SchemaGuardError):
        guard(d, "dim_test", ["id"], ["id"])


def test_diff_pk_mismatch_refused():
    d = schema_diff(CONF, ["id"], CONF, ["note"])
    assert d.pk_mismatch
    with pytest.raises(SchemaGuardError):
        guard(d, "dim_test", ["id"], ["note"])


def test_diff_compatible_spellings():
    existing = [("id", "text"), ("flag", "boolean"), ("quantity", "double precision"),
                ("note", "character varying(20)")]
    assert not schema_diff(CONF, ["id"], existing, ["id"]).type_mismatches


@pytest.mark.parametrize("existing,configured,ok", [
    ("double precision", "DOUBLE PRECISION", True),
    ("timestamp without time zone", "TIMESTAMP", True),
    ("text", "TEXT", True),
    ("boolean", "TEXT", False),
    ("character varying(10)", "TEXT", True),
    ("integer", "INT", False),                # conservative: unsure means mismatch
    ("timestamp with time zone", "TIMESTAMP", True),
])
def test_type_compat(existing, configured, ok):
    assert is_compatible_type(existing, configured) is ok


def test_type_compat_column_matches_python(spark):
    from tierload.functions.types import type_compatible
    pairs = [("double precision", "DOUBLE PRECISION"), ("varchar(3)", "TEXT"), ("boolean", "TEXT"),
             ("timestamp(3)", "timestamp")]
    df = spark.createDataFrame(pairs, "e string, c string")
    got = [r[0] for r in df.select(type_compatible(F.col("e"), F.col("c"))).collect()]
    assert got == [is_compatible_type(e, c) for e, c in pairs]


# ------------------------------------------------------- config validation

def _t(**kw):
    base = dict(source_table="foo", target_table="dim_foo", primary_keys=["id"],
                columns=[ColumnMap("foo_id", "id", "text"), ColumnMap("foo_name", "name", "text")])
    base.update(kw)
    return GoldTable(**base)


def test_valid_config_passes():
    assert validate_gold_config(GoldSettings(batch_size=100), [_t()]) == []


@pytest.mark.parametrize("settings,tables", [
    (None, [_t()]),
    (GoldSettings(batch_size=0), [_t()]),
    (GoldSettings(batch_size=-5), [_t()]),
    (GoldSettings(batch_size=10), []),
    (GoldSettings(batch_size=10), [_t(), _t(source_table="bar")]),     # same target twice
])
def test_invalid_settings(settings, tables):
    with pytest.raises(ConfigError):
        validate_gold_config(settings, tables)


@pytest.mark.parametrize("kw", [
    dict(source_table=""),
    dict(target_table=""),
    dict(primary_keys=[]),
    dict(columns=[]),
    dict(columns=[ColumnMap("a", "id", "text"), ColumnMap("a", "name", "text")]),
    dict(columns=[ColumnMap("a", "id", "text"), ColumnMap("b", "id", "text")]),
    dict(primary_keys=["id", "id"]),
    dict(primary_keys=["missing"]),
    dict(columns=[ColumnMap("foo_id", "id", "")]),
    dict(watermark_enabled=True, watermark_column=None),
    dict(watermark_enabled=True, watermark_column="not_mapped"),
])
def test_invalid_tables(kw):
    with pytest.raises(ConfigError):
        validate_gold_table(_t(**kw))


def test_watermark_in_primary_key_only_warns():
    t = _t(primary_keys=["id", "name"], watermark_enabled=True, watermark_column="foo_name")
    warnings = validate_gold_table(t)
    assert len(warnings) == 1 and "primary key" in warnings[0]


def test_write_staging_files(spark, tmp_path):
    from tierload.sources.staging import write_staging
    df = spark.createDataFrame([("A1", None, 'q"x'), ("A2", True, "")],
                               "id string, flag boolean, note string")
    out = str(tmp_path / "staging")
    write_staging(df, out)
    lines = sorted(r.value for r in spark.read.text(out).collect())
    assert lines == ['"A1",\\N,"q""x"', '"A2","true",""']


def test_gold_load_with_repeated_or_null_keys_publishes_nothing(spark):
    import uuid

    from tierload.config import GoldSettings, GoldTable
    from tierload.plans.gold import load_gold
    from tierload.plans.tables import SnapshotTable
    tag = uuid.uuid4().hex[:8]
    t = GoldTable("s", "t", ["id"], [ColumnMap("id", "id", "bigint"), ColumnMap("v", "v", "int")])

    def load(data):
        df = spark.createDataFrame(data, "id bigint, v int")
        return load_gold(spark, lambda _: df, [t], GoldSettings(), table_prefix=f"g{tag}_",
                         watermark_table=f"g{tag}_wm").first()

    assert load([(1, 1), (2, 2)])["status"] == "OK"
    versions = SnapshotTable(spark, f"g{tag}_t", key=["id"]).versions()
    for bad in ([(1, 5), (1, 6)], [(None, 5), (3, 6)]):
        row = load(bad)
        assert row["status"].startswith("ERROR") and "primary keys" in row["status"]
        assert rows(spark.table(f"g{tag}_t")) == [(1, 1), (2, 2)]
    assert SnapshotTable(spark, f"g{tag}_t", key=["id"]).versions() == versions
    assert load([(2, 7), (3, 8)])["rows_upserted"] == 2
    assert rows(spark.table(f"g{tag}_t")) == [(1, 1), (2, 7), (3, 8)]
