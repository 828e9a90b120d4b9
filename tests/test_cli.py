"""Command line jobs and JSON configs, end to end on the fixtures."""

import json
import uuid

import pytest

from conftest import SF_SMALL
from tierload import fixtures as fx
from tierload.cli import run
from tierload.config import ConfigError, gold_config_from_json, silver_config_from_json

SILVER_DOC = {
    "dateValidation": {"minTimestamp": "1950-01-01 00:00:00", "maxYearsFromToday": 10},
    "datasets": [
        {"name": "events", "pk": ["entity_id", "event_type"], "cursor": "cursor_ts",
         "mode": "dedupe_latest", "excludeColumns": ["VALID_TS"], "tieBreakers": ["event_id"]},
        {"name": "events_log", "pk": ["entity_id", "event_type"], "cursor": "cursor_ts",
         "mode": "append_only", "excludeColumns": [], "requiresConfirmation": True,
         "note": "check the key first"},
    ],
}


def test_silver_config_parsing():
    validation, datasets = silver_config_from_json(SILVER_DOC)
    assert validation.max_years_from_today == 10
    assert datasets[0].pk == ("entity_id", "event_type") and datasets[1].requires_confirmation


def test_gold_config_validation():
    doc = {"settings": {"batchSize": 500},
           "tables": [{"sourceTable": "orders", "targetTable": "dim_orders", "primaryKeys": ["id"],
                       "columns": [{"source": "o_orderkey", "target": "id", "postgresType": "BIGINT"}],
                       "watermark": {"enabled": False}}]}
    settings, tables = gold_config_from_json(doc)
    assert settings.batch_size == 500 and tables[0].columns[0].target == "id"
    with pytest.raises(ConfigError):
        gold_config_from_json({"tables": doc["tables"]})


def test_crawl_silver_gold_jobs(spark, tmp_path):
    root = fx.write_bronze_files(spark, SF_SMALL)
    tag = uuid.uuid4().hex[:8]
    db = f"cli_{tag}"
    spark.sql(f"CREATE DATABASE {db}")
    assert run(spark, ["crawl", "--root", root, "--database", db]) == 0
    spark.sql(f"CREATE VIEW {db}.events_log AS SELECT * FROM {db}.events")
    cfg = tmp_path / "silver.json"
    cfg.write_text(json.dumps(SILVER_DOC))
    prefix = f"s{tag}_"
    base = ["silver", "--config", str(cfg), "--bronze-database", db, "--silver-prefix", prefix]
    assert run(spark, base + ["--dry-run"]) == 0
    assert not spark.catalog.tableExists(f"{prefix}events")
    assert run(spark, base) == 0
    assert spark.catalog.tableExists(f"{prefix}events")
    assert not spark.catalog.tableExists(f"{prefix}events_log")       # gated
    assert run(spark, base + ["--confirm-append-only", "--dataset=events_log"]) == 0
    from tierload.operators import date_anomaly_filter
    assert spark.table(f"{prefix}events_log").count() == \
        date_anomaly_filter(fx.bronze_events(spark, SF_SMALL)).count()
    # Bronze without the batch partition columns is refused with a clear error
    orders_doc = {"datasets": [{"name": "orders_v1", "pk": ["o_orderkey"], "cursor": "o_orderdate"}]}
    ocfg = tmp_path / "orders.json"
    ocfg.write_text(json.dumps(orders_doc))
    assert run(spark, ["silver", "--config", str(ocfg), "--bronze-database", db,
                       "--silver-prefix", prefix]) == 1
    gold = {"settings": {"batchSize": 2500, "watermarkOverlapSeconds": 60},
            "tables": [{"sourceTable": "events", "targetTable": "entity_state",
                        "primaryKeys": ["entity_id", "event_type"],
                        "columns": [{"source": "entity_id", "target": "entity_id", "postgresType": "BIGINT"},
                                    {"source": "event_type", "target": "event_type", "postgresType": "TEXT"},
                                    {"source": "cursor_ts", "target": "modified_at", "postgresType": "TIMESTAMP"}],
                        "watermark": {"enabled": True, "sourceColumn": "cursor_ts"}}]}
    gcfg = tmp_path / "gold.json"
    gcfg.write_text(json.dumps(gold))
    assert run(spark, ["gold", "--config", str(gcfg), "--silver-prefix", prefix,
                       "--gold-prefix", f"g{tag}_"]) == 0
    assert spark.table(f"g{tag}_entity_state").count() == spark.table(f"{prefix}events").count()
    bad = tmp_path / "bad.json"
    bad.write_text(json.dumps({**SILVER_DOC, "datasets": [{**SILVER_DOC["datasets"][0],
                                                           "cursor": "no_such_column"}]}))
    assert run(spark, ["silver", "--config", str(bad), "--bronze-database", db,
                       "--silver-prefix", f"x{tag}_"]) == 1
