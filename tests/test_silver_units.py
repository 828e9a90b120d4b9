"""Silver-side semantics on tiny frames: anomaly filter, latest row,
state, MERGE outcomes and the documented edge cases, plus invariants."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tierload.config import DateValidation, SilverDataset
from tierload.operators import (batch_state, date_anomaly_filter, exclude_columns,
                                incremental_filter, latest_per_key, merge_latest, null_profile,
                                plan_exclusion, prune_null_columns, read_state, watermark_filter)
from tierload.plans import silver_frames as sf

T = dt.datetime
SCHEMA = ("id bigint, v string, cur timestamp_ntz, other_ts timestamp_ntz, "
          "ingestion_date string, batch_id string")
DS = SilverDataset(name="t", pk=["id"], cursor="cur")
VAL = DateValidation("1950-01-01 00:00:00", 10)
AS_OF = "2026-01-01 00:00:00"


def b(day, hour):
    return f"2024010{day}{hour:02d}0000000_2024010{day}{hour:02d}5959999"


def bronze(spark, data):
    return spark.createDataFrame(data, SCHEMA)


# ------------------------------------------------------------- filters

def test_anomaly_filter_bounds_inclusive_and_nulls_kept(spark):
    df = bronze(spark, [
        (1, "a", T(1950, 1, 1), None, "2024-01-01", b(1, 1)),        # lower bound kept
        (2, "b", T(2036, 1, 1), None, "2024-01-01", b(1, 1)),        # upper bound kept
        (3, "c", T(1949, 12, 31, 23, 59), None, "2024-01-01", b(1, 1)),
        (4, "d", T(2036, 1, 1, 0, 0, 1), None, "2024-01-01", b(1, 1)),
        (5, "e", None, None, "2024-01-01", b(1, 1)),                  # NULL kept
        (6, "f", T(2024, 1, 1), T(1800, 1, 1), "2024-01-01", b(1, 1)),  # other column bad
    ])
    kept = [r[0] for r in rows(date_anomaly_filter(df, None, VAL.min_timestamp, 10, AS_OF))]
    assert kept == [1, 2, 5]


def test_upper_bound_keeps_time_and_clamps_leap_day(spark):
    df = bronze(spark, [(1, "a", T(2034, 2, 28, 12), None, "2024-01-01", b(1, 1)),
                        (2, "b", T(2034, 2, 28, 12, 0, 1), None, "2024-01-01", b(1, 1))])
    kept = [r[0] for r in rows(date_anomaly_filter(df, ["cur"], VAL.min_timestamp, 10,
                                                   "2024-02-29 12:00:00"))]
    assert kept == [1]


def test_excluded_date_column_still_filters(spark):
    """D-13: the anomaly filter uses every Bronze date column, even one
    excluded from the Silver output."""
    ds = SilverDataset(name="t", pk=["id"], cursor="cur", exclude_columns=["OTHER_TS"])
    df = bronze(spark, [(1, "a", T(2024, 1, 1), T(1800, 1, 1), "2024-01-01", b(1, 1)),
                        (2, "b", T(2024, 1, 1), T(2024, 1, 1), "2024-01-01", b(1, 1))])
    out = sf.initial_load(df, ds, VAL, AS_OF, "2026-01-01 00:00:00")
    assert "other_ts" not in out.columns
    assert [r["id"] for r in out.collect()] == [2]


def test_exclusion_is_case_insensitive_and_reports_unknown():
    plan = plan_exclusion(["Id", "Name", "Note"], ["NAME", "missing"])
    assert plan.retained == ["Id", "Note"] and plan.found == ["Name"]
    assert plan.not_found == ["missing"]


def test_exclude_columns(spark):
    df = spark.createDataFrame([(1, "x", "y")], "Id int, Name string, note string")
    assert exclude_columns(df, ["name", "NOTE"]).columns == ["Id"]


def test_incremental_filter_both_arms(spark):
    df = bronze(spark, [
        (1, "a", T(2024, 1, 2), None, "2024-01-02", b(2, 5)),
        (2, "a", T(2024, 1, 2), None, "2024-01-02", b(2, 6)),
        (3, "a", T(2024, 1, 3), None, "2024-01-03", b(3, 1)),
        (4, "a", T(2024, 1, 1), None, "2024-01-01", b(1, 23)),
    ])
    kept = [r[0] for r in rows(incremental_filter(df, "2024-01-02 00:00:00.000", b(2, 5)))]
    assert kept == [2, 3]


def test_null_batch_state_skips_same_day(spark):
    """D-04: a NULL batch id in the state skips the rest of that day."""
    df = bronze(spark, [(1, "a", T(2024, 1, 2), None, "2024-01-02", b(2, 5)),
                        (2, "a", T(2024, 1, 3), None, "2024-01-03", b(3, 1))])
    assert [r[0] for r in rows(incremental_filter(df, "2024-01-02", None))] == [2]


def test_no_state_means_full_read(spark):
    df = bronze(spark, [(1, "a", T(2024, 1, 2), None, "2024-01-02", b(2, 5))])
    assert incremental_filter(df, None, None).count() == 1


def test_watermark_overlap(spark):
    df = spark.createDataFrame([(1, T(2024, 1, 1, 0, 0, 0)), (2, T(2024, 1, 1, 0, 1, 0)),
                                (3, T(2024, 1, 1, 0, 0, 59))], "id int, m timestamp_ntz")
    wm = "2024-01-01 00:01:00"
    assert [r[0] for r in rows(watermark_filter(df, "m", wm))] == [1, 2, 3]     # default 60 s
    assert [r[0] for r in rows(watermark_filter(df, "m", wm, None))] == [1, 2, 3]
    assert [r[0] for r in rows(watermark_filter(df, "m", wm, 0))] == [2]         # D-07: 0 honoured
    assert watermark_filter(df, "m", None).count() == 3


# ---------------------------------------------------------- latest / state

def test_latest_per_key_order(spark):
    df = bronze(spark, [
        (1, "old", T(2024, 1, 1), None, "2024-01-01", b(1, 1)),
        (1, "new", T(2024, 1, 2), None, "2024-01-01", b(1, 1)),
        (1, "null-cursor", None, None, "2024-01-03", b(3, 1)),          # NULLS LAST
        (2, "early-batch", T(2024, 1, 1), None, "2024-01-01", b(1, 1)),
        (2, "late-batch", T(2024, 1, 1), None, "2024-01-01", b(1, 2)),  # tie -> batch desc
        (3, "d1", T(2024, 1, 1), None, "2024-01-01", b(1, 9)),
        (3, "d2", T(2024, 1, 1), None, "2024-01-02", b(2, 0)),          # tie -> date desc
        (4, "only-null", None, None, "2024-01-01", b(1, 1)),
    ])
    got = {r["id"]: r["v"] for r in latest_per_key(df, ["id"], "cur").collect()}
    assert got == {1: "new", 2: "late-batch", 3: "d2", 4: "only-null"}


def test_batch_state(spark):
    s = spark.createDataFrame([("2024-01-02", b(2, 3)), ("2024-01-02", b(2, 7)),
                               ("2024-01-01", b(1, 23)), (None, "x")],
                              "_source_ingestion_date string, _source_batch_id string")
    r = batch_state(s).first()
    assert r["ingestion_ts"] == T(2024, 1, 2) and r["batch_id"] == b(2, 7)
    assert read_state(s) == ("2024-01-02", b(2, 7))


def test_batch_state_empty(spark):
    s = spark.createDataFrame([], "_source_ingestion_date string, _source_batch_id string")
    assert read_state(s) is None
    r = batch_state(s).first()
    assert r["ingestion_ts"] is None and r["batch_id"] is None


# ------------------------------------------------------------------ merge

def _silver(spark, data):
    return spark.createDataFrame(
        data, "id bigint, v string, cur timestamp_ntz, _source_ingestion_date string, "
              "_source_batch_id string, _silver_loaded_at timestamp_ntz")


RUN1, RUN2 = T(2026, 1, 1), T(2026, 1, 2)


def test_merge_outcomes(spark):
    target = _silver(spark, [
        (1, "t1", T(2024, 1, 1), "2024-01-01", b(1, 1), RUN1),   # untouched
        (2, "t2", T(2024, 1, 1), "2024-01-01", b(1, 1), RUN1),   # updated
        (3, "t3", T(2024, 1, 5), "2024-01-01", b(1, 1), RUN1),   # kept (older source)
        (4, "t4", T(2024, 1, 5), "2024-01-01", b(1, 1), RUN1),   # kept (equal cursor)
        (5, "t5", None, "2024-01-01", b(1, 1), RUN1),            # D-02: NULL target cursor
    ])
    src = spark.createDataFrame([
        (2, "s2", T(2024, 1, 2), "2024-01-02", b(2, 1)),
        (3, "s3", T(2024, 1, 2), "2024-01-02", b(2, 1)),
        (4, "s4", T(2024, 1, 5), "2024-01-02", b(2, 1)),
        (5, "s5", T(2024, 1, 9), "2024-01-02", b(2, 1)),
        (6, "s6", None, "2024-01-02", b(2, 1)),                  # insert
    ], "id bigint, v string, cur timestamp_ntz, ingestion_date string, batch_id string")
    out = {r["id"]: r for r in merge_latest(target, src, ["id"], "cur", RUN2).collect()}
    assert {k: r["v"] for k, r in out.items()} == {1: "t1", 2: "s2", 3: "t3", 4: "t4", 5: "t5",
                                                    6: "s6"}
    assert out[2]["_source_batch_id"] == b(2, 1) and out[2]["_silver_loaded_at"] == RUN2
    assert out[3]["_silver_loaded_at"] == RUN1
    assert out[6]["_source_ingestion_date"] == "2024-01-02"


def test_merge_dedupes_source_first(spark):
    """D-01: several source versions of one key never become duplicates."""
    target = _silver(spark, [(1, "t1", T(2024, 1, 1), "2024-01-01", b(1, 1), RUN1)])
    src = spark.createDataFrame([
        (1, "a", T(2024, 1, 2), "2024-01-02", b(2, 1)), (1, "b", T(2024, 1, 3), "2024-01-02", b(2, 1)),
        (2, "c", T(2024, 1, 2), "2024-01-02", b(2, 1)), (2, "d", T(2024, 1, 4), "2024-01-02", b(2, 1)),
    ], "id bigint, v string, cur timestamp_ntz, ingestion_date string, batch_id string")
    out = merge_latest(target, src, ["id"], "cur", RUN2)
    assert sorted((r["id"], r["v"]) for r in out.collect()) == [(1, "b"), (2, "d")]


def test_merge_null_key_inserted_again(spark):
    """D-03: NULL keys never match, so they are inserted on every run."""
    target = _silver(spark, [(None, "t", T(2024, 1, 1), "2024-01-01", b(1, 1), RUN1)])
    src = spark.createDataFrame([(None, "s", T(2024, 1, 2), "2024-01-02", b(2, 1))],
                                "id bigint, v string, cur timestamp_ntz, ingestion_date string, "
                                "batch_id string")
    assert merge_latest(target, src, ["id"], "cur", RUN2).count() == 2


def test_merge_keeps_silver_only_columns(spark):
    target = spark.createDataFrame(
        [(1, "t", T(2024, 1, 1), "x", "2024-01-01", b(1, 1), RUN1)],
        "id bigint, v string, cur timestamp_ntz, silver_only string, _source_ingestion_date string, "
        "_source_batch_id string, _silver_loaded_at timestamp_ntz")
    src = spark.createDataFrame([(1, "s", T(2024, 1, 2), "2024-01-02", b(2, 1)),
                                 (2, "n", T(2024, 1, 2), "2024-01-02", b(2, 1))],
                                "id bigint, v string, cur timestamp_ntz, ingestion_date string, "
                                "batch_id string")
    out = {r["id"]: r for r in merge_latest(target, src, ["id"], "cur", RUN2).collect()}
    assert out[1]["v"] == "s" and out[1]["silver_only"] == "x"
    assert out[2]["silver_only"] is None


# -------------------------------------------------------------- invariants

def _bronze_days(spark):
    data = []
    for day in (1, 2, 3):
        for key in range(6):
            data.append((key, f"k{key}d{day}", T(2024, 1, day, key), None,
                         f"2024-01-0{day}", b(day, 1)))
    data.append((7, "late", T(2023, 12, 1), None, "2024-01-03", b(3, 1)))
    return bronze(spark, data)


def _initial(spark, df):
    return sf.initial_load(df, DS, VAL, AS_OF, RUN1)


def _merge(spark, silver, df):
    return sf.merge_load(silver, df, DS, VAL, read_state(silver), AS_OF, RUN1)


def test_merge_twice_equals_once(spark):
    df = _bronze_days(spark)
    first = _initial(spark, df.where("ingestion_date <= '2024-01-01'"))
    once = _merge(spark, first, df)
    once_rows = rows(once)
    # re-running the same Bronze slice against the merged result changes nothing
    again = sf.merge_load(once, df, DS, VAL, read_state(first), AS_OF, RUN1)
    assert rows(again) == once_rows


def test_initial_plus_merge_equals_initial_all(spark):
    df = _bronze_days(spark)
    first = _initial(spark, df.where("ingestion_date <= '2024-01-01'"))
    assert rows(_merge(spark, first, df)) == rows(_initial(spark, df))


def test_null_profile_and_prune(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, None)], "a int, b string, c string")
    r = null_profile(df).first()
    assert (r["total_rows"], r["a__nonnull"], r["b__nonnull"], r["c__nonnull"]) == (2, 2, 0, 1)
    assert prune_null_columns(df).columns == ["a", "c"]
    assert prune_null_columns(df, keep=["b"]).columns == ["a", "b", "c"]


def test_append_load_with_state(spark):
    ds = SilverDataset(name="t", pk=["id"], cursor="cur", mode="append_only")
    df = _bronze_days(spark)
    first = sf.append_load(df.where("ingestion_date <= '2024-01-02'"), ds, VAL, None, AS_OF, RUN1)
    more = sf.append_load(df, ds, VAL, read_state(first), AS_OF, RUN2)
    assert first.count() == 12 and more.count() == 7
    assert more.where(F.col("_source_ingestion_date") != "2024-01-03").count() == 0


def test_config_checks():
    with pytest.raises(ValueError):
        SilverDataset(name="t", pk=[], cursor="c")
    with pytest.raises(ValueError):
        SilverDataset(name="t", pk=["id"], cursor="c", mode="other")
