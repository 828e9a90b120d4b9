"""Test inputs derived from the driver tables (see FIXTURES.md).

The driver tables hold no NULLs and no out-of-range dates, so these
views inject them.  Each fixture exists twice: as a Spark DataFrame
over the parquet tables, and as a DuckDB CTE for the oracle SQL.  All
of them are full-table projections: every row of the base table is
used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.literals import ts_lit
from .operators.columns import ColumnMap

# Fixed values shared by the Spark queries and the oracle SQL.
AS_OF = "2026-01-01 00:00:00"          # "now" of the date-anomaly filter
MIN_TS = "1950-01-01 00:00:00"
MAX_YEARS = 10
RUN_TS_1 = "2026-01-02 03:04:05"        # _silver_loaded_at of the initial load
RUN_TS_2 = "2026-01-03 03:04:05"        # ... of the incremental merge
SPLIT_DATE = "2024-01-28"               # target = ingestion_date <= SPLIT_DATE
MID_STATE = ("2024-01-20", "20240120120000000_20240120125959999")  # mid-day state
EVENTS_PK = ["entity_id", "event_type"]
EVENTS_CURSOR = "cursor_ts"
EVENTS_TIE = ["event_id"]

ORDERS_MAPPING = [
    ColumnMap("o_orderkey", "order_id", "bigint"),
    ColumnMap("o_custkey", "customer_id", "bigint"),
    ColumnMap("o_orderstatus", "status", "string"),
    ColumnMap("o_totalprice", "total", "double"),
    ColumnMap("o_orderdate", "modified_at", "timestamp_ntz"),
    ColumnMap("o_orderpriority", "priority", "string"),
]
ORDERS_PK = ["order_id"]
ORDERS_WATERMARK_COL = "o_orderdate"
GOLD_TARGET_CUTOFF = "1999-12-31 00:00:00"
GOLD_PREV_WATERMARK = "1999-10-01 00:00:00"
GOLD_OVERLAP_SECONDS = 60

CRAWL_CUTOFF = "2024-01-20 00:00:00"    # files older than this were crawled before
REWRITE_DAY = "2024-01-15"              # files of this day were rewritten since
LINK_CUTOFF = "1996-12-31 00:00:00"     # all-key link table split

LINEITEM_PK = ["l_orderkey", "l_linenumber"]
LINEITEM_CURSOR = "l_shipdate"
LINEITEM_TIE = ["l_partkey", "l_suppkey", "l_extendedprice"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ------------------------------------------------------------ bronze_events

def bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze table over ``events``: PK (entity_id, event_type), cursor
    ``cursor_ts``, anomalous/NULL dates injected, string partition
    columns ``ingestion_date`` and ``batch_id``."""
    e = table(spark, sf_dir, "events")
    eid, ts = F.col("event_id"), F.col("ts")
    hour = F.date_format(ts, "yyyyMMddHH")
    return e.select(
        eid,
        (F.col("user_id") * 5 + eid % 5).alias("entity_id"),
        "event_type",
        F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("value")).alias("value"),
        F.when(eid % 97 == 0, ts_lit("1900-01-01 00:00:00"))
         .when(eid % 89 == 0, ts_lit("2999-12-31 00:00:00"))
         .when(eid % 83 == 0, F.lit(None)).otherwise(ts).alias("valid_ts"),
        F.when(eid % 101 == 0, F.lit(None))
         .otherwise(ts - F.make_dt_interval((eid % 10).cast("int"))).alias("cursor_ts"),
        F.lit(None).cast("string").alias("legacy_col"),
        F.date_format(ts, "yyyy-MM-dd").alias("ingestion_date"),
        F.concat(hour, F.lit("0000000_"), hour, F.lit("5959999")).alias("batch_id"),
    )


BRONZE_EVENTS_SQL = """bronze_events AS (
  SELECT event_id, user_id*5 + event_id%5 AS entity_id, event_type,
    CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value,
    CASE WHEN event_id%97 = 0 THEN TIMESTAMP '1900-01-01 00:00:00'
         WHEN event_id%89 = 0 THEN TIMESTAMP '2999-12-31 00:00:00'
         WHEN event_id%83 = 0 THEN NULL ELSE ts END AS valid_ts,
    CASE WHEN event_id%101 = 0 THEN NULL
         ELSE ts - to_days(CAST(event_id%10 AS INTEGER)) END AS cursor_ts,
    CAST(NULL AS VARCHAR) AS legacy_col,
    strftime(ts, '%Y-%m-%d') AS ingestion_date,
    strftime(ts, '%Y%m%d%H') || '0000000_' || strftime(ts, '%Y%m%d%H') || '5959999' AS batch_id
  FROM events)"""


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze events whose cursors are distinct and never NULL but do not
    rise with the batches, so merging them in any order of files gives one
    result."""
    micros = F.col("event_id").bitwiseXOR(F.lit(1023)).cast("decimal(18,6)") / F.lit(1000000)
    cursor = ts_lit("2024-01-01 00:00:00") + F.make_dt_interval(secs=micros.cast("decimal(18,6)"))
    return bronze_events(spark, sf_dir).withColumn("cursor_ts", cursor)


STREAM_EVENTS_SQL = BRONZE_EVENTS_SQL.replace("bronze_events AS", "all_events AS") + """,
bronze_events AS (
  SELECT * REPLACE (TIMESTAMP '2024-01-01 00:00:00' + to_microseconds(xor(CAST(event_id AS BIGINT), 1023)) AS cursor_ts)
  FROM all_events)"""


# ------------------------------------------------------------- bronze_paths

def bronze_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object keys in a Bronze bucket, one per event: covers root-level
    files, non-Parquet objects, upper-case suffixes, ``=`` inside a value,
    two layouts in one dataset and a dataset name needing sanitising."""
    e = table(spark, sf_dir, "events")
    eid, ts = F.col("event_id"), F.col("ts")
    day = F.date_format(ts, "yyyy-MM-dd")
    part = F.concat(F.lit("part-"), eid.cast("string"))
    key = (F.when(eid % 50 == 0, F.concat(F.lit("EVENTS/ingestion_date="), day, F.lit("/"), part,
                                          F.lit(".parquet")))
           .when(eid % 51 == 0, F.concat(F.lit("Clicks.v2/year="), F.date_format(ts, "yyyy"),
                                         F.lit("/tag=a=b/"), part, F.lit(".PARQUET")))
           .when(eid % 53 == 0, F.concat(part, F.lit(".parquet")))
           .when(eid % 59 == 0, F.lit("EVENTS/_SUCCESS"))
           .otherwise(F.concat(F.lit("EVENTS/ingestion_date="), day, F.lit("/batch_id="),
                               F.date_format(ts, "yyyyMMddHH"), F.lit("/"), part,
                               F.lit(".parquet"))))
    return e.select(eid, key.alias("key"), ts.alias("last_modified"),
                    (eid * 10 + 1000).alias("size"))


BRONZE_PATHS_SQL = """bronze_paths AS (
  SELECT event_id, CASE
    WHEN event_id%50 = 0 THEN 'EVENTS/ingestion_date=' || strftime(ts, '%Y-%m-%d') || '/part-' || event_id || '.parquet'
    WHEN event_id%51 = 0 THEN 'Clicks.v2/year=' || strftime(ts, '%Y') || '/tag=a=b/part-' || event_id || '.PARQUET'
    WHEN event_id%53 = 0 THEN 'part-' || event_id || '.parquet'
    WHEN event_id%59 = 0 THEN 'EVENTS/_SUCCESS'
    ELSE 'EVENTS/ingestion_date=' || strftime(ts, '%Y-%m-%d') || '/batch_id=' || strftime(ts, '%Y%m%d%H') || '/part-' || event_id || '.parquet'
    END AS key, ts AS last_modified, event_id*10 + 1000 AS size
  FROM events)"""


# ------------------------------------------------------------------ orders

def gold_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Existing Gold rows: mapped orders up to the cutoff."""
    from .operators.columns import map_columns
    o = table(spark, sf_dir, "orders")
    return map_columns(o.where(F.col("o_orderdate") <= ts_lit(GOLD_TARGET_CUTOFF)), ORDERS_MAPPING)


def silver_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver ``orders`` as the Gold loader sees it: rows from the
    watermark overlap on have a new (doubled) total."""
    o = table(spark, sf_dir, "orders")
    changed = F.col("o_orderdate") >= F.lit("1999-09-30 23:59:00").cast("timestamp_ntz")
    return o.withColumn("o_totalprice", F.when(changed, F.col("o_totalprice") * 2)
                        .otherwise(F.col("o_totalprice")))


GOLD_TARGET_SQL = """gold_target AS (
  SELECT CAST(o_orderkey AS BIGINT) AS order_id, CAST(o_custkey AS BIGINT) AS customer_id,
         CAST(o_orderstatus AS VARCHAR) AS status, CAST(o_totalprice AS DOUBLE) AS total,
         CAST(o_orderdate AS TIMESTAMP) AS modified_at, CAST(o_orderpriority AS VARCHAR) AS priority
  FROM orders WHERE o_orderdate <= TIMESTAMP '1999-12-31 00:00:00')"""

SILVER_ORDERS_SQL = """silver_orders AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CASE WHEN o_orderdate >= TIMESTAMP '1999-09-30 23:59:00' THEN o_totalprice*2
              ELSE o_totalprice END AS o_totalprice,
         o_orderdate, o_orderpriority
  FROM orders)"""

GOLD_SOURCE_SQL = """gold_source AS (
  SELECT CAST(o_orderkey AS BIGINT) AS order_id, CAST(o_custkey AS BIGINT) AS customer_id,
         CAST(o_orderstatus AS VARCHAR) AS status, CAST(o_totalprice AS DOUBLE) AS total,
         CAST(o_orderdate AS TIMESTAMP) AS modified_at, CAST(o_orderpriority AS VARCHAR) AS priority
  FROM silver_orders
  WHERE o_orderdate >= TIMESTAMP '1999-10-01 00:00:00' - INTERVAL 60 SECOND)"""


# ------------------------------------------------------- Bronze on disk

_WRITTEN: dict = {}


def write_bronze_files(spark: SparkSession, sf_dir: str) -> str:
    """Write the Bronze fixtures as Hive-partitioned Parquet below a new
    folder of the shared work dir (once per session and scale); return
    the root.  Layout: ``EVENTS/ingestion_date=../batch_id=../part-*``
    and ``Orders.v1/o_orderpriority=../part-*``."""
    from .session import new_run_dir
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _WRITTEN:
        return _WRITTEN[key]
    root = new_run_dir(spark, "bronze")
    parts = ["ingestion_date", "batch_id"]
    (bronze_events(spark, sf_dir).repartition(*parts)
        .write.partitionBy(*parts).parquet(f"{root}/EVENTS"))
    (table(spark, sf_dir, "orders").repartition("o_orderpriority")
        .write.partitionBy("o_orderpriority").parquet(f"{root}/Orders.v1"))
    _WRITTEN[key] = root
    return root


def write_stream_files(spark: SparkSession, sf_dir: str) -> str:
    """Write ``stream_events`` as Hive-partitioned Parquet (once per
    session and scale); return the folder."""
    from .session import new_run_dir
    key = (spark.sparkContext.applicationId, sf_dir, "stream")
    if key not in _WRITTEN:
        root, parts = new_run_dir(spark, "bronze-stream"), ["ingestion_date", "batch_id"]
        stream_events(spark, sf_dir).repartition(*parts).write.partitionBy(*parts).parquet(f"{root}/EVENTS")
        _WRITTEN[key] = f"{root}/EVENTS"
    return _WRITTEN[key]
