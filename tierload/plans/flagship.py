"""The flagship load, end to end on the driver tables:

Bronze fixture -> initial Silver load of the batches up to the split
date -> incremental MERGE of the later batches (state read from
Silver) -> Gold upsert of the Silver rows into a keyed serving table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixtures as fx
from ..config import DateValidation, GoldSettings, GoldTable, SilverDataset
from ..operators.columns import ColumnMap
from ..session import new_run_dir
from .gold import load_gold
from .silver import load_silver

EVENTS = SilverDataset(name="events", pk=fx.EVENTS_PK, cursor=fx.EVENTS_CURSOR,
                       exclude_columns=("valid_ts",), tie_breakers=fx.EVENTS_TIE)
EVENTS_GOLD = GoldTable(
    source_table="events", target_table="entity_state", primary_keys=("entity_id", "event_type"),
    columns=[ColumnMap("entity_id", "entity_id", "bigint"),
             ColumnMap("event_type", "event_type", "string"),
             ColumnMap("value", "last_value", "double"),
             ColumnMap("cursor_ts", "modified_at", "timestamp_ntz"),
             ColumnMap("event_id", "last_event_id", "bigint")],
    watermark_column="cursor_ts", watermark_enabled=True)


def flagship(spark: SparkSession, sf_dir: str, buckets: int = 8) -> DataFrame:
    run = new_run_dir(spark, "flagship").rsplit("-", 1)[-1]
    silver_prefix, gold_prefix = f"silver_{run}_", f"gold_{run}_"
    bronze_all = fx.bronze_events(spark, sf_dir)
    validation = DateValidation(fx.MIN_TS, fx.MAX_YEARS)
    first = bronze_all.where(F.col("ingestion_date") <= fx.SPLIT_DATE)
    load_silver(spark, lambda _: first, [EVENTS], validation, as_of=fx.AS_OF,
                run_ts=fx.RUN_TS_1, table_prefix=silver_prefix, buckets=buckets).collect()
    load_silver(spark, lambda _: bronze_all, [EVENTS], validation, as_of=fx.AS_OF,
                run_ts=fx.RUN_TS_2, table_prefix=silver_prefix, buckets=buckets).collect()
    load_gold(spark, lambda name: spark.table(f"{silver_prefix}{name}"), [EVENTS_GOLD],
              GoldSettings(), table_prefix=gold_prefix, watermark_table=f"{gold_prefix}watermarks",
              buckets=buckets, run_ts=fx.RUN_TS_2).collect()
    return spark.table(f"{gold_prefix}{EVENTS_GOLD.target_table}")
