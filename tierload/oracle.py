"""DuckDB SQL equivalents of the registered queries.

Only the base tables are registered in the oracle engine, so every
statement inlines its fixture as a CTE (text in ``fixtures``).  The
small generators below keep the long column lists consistent.
"""

from __future__ import annotations

from . import fixtures as fx

EVENT_COLS = ["event_id", "entity_id", "event_type", "value", "valid_ts", "cursor_ts", "legacy_col"]
# retained Silver columns of the events dataset (``valid_ts`` excluded)
SILVER_COLS = ["event_id", "entity_id", "event_type", "value", "cursor_ts", "legacy_col"]
LINEAGE = ["_source_ingestion_date", "_source_batch_id", "_silver_loaded_at"]


def ts(value: str) -> str:
    return f"TIMESTAMP '{value}'"


def anomaly_pred(cols=("valid_ts", "cursor_ts"), as_of=fx.AS_OF) -> str:
    hi = f"{ts(as_of)} + INTERVAL {fx.MAX_YEARS} YEAR"
    return " AND ".join(f"({c} IS NULL OR ({c} >= {ts(fx.MIN_TS)} AND {c} <= {hi}))" for c in cols)


EVENTS_ORDER = "cursor_ts DESC NULLS LAST, CAST(ingestion_date AS DATE) DESC, batch_id DESC, event_id DESC"
EVENTS_PART = "entity_id, event_type"


def clean_cte(where: str = "") -> str:
    extra = f" AND ({where})" if where else ""
    return f"clean AS (SELECT * FROM bronze_events WHERE {anomaly_pred()}{extra})"


def latest_cte(name: str, src: str, where: str = "") -> str:
    w = f" WHERE {where}" if where else ""
    return (f"{name} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {EVENTS_PART} "
            f"ORDER BY {EVENTS_ORDER}) AS rn FROM {src}{w}) WHERE rn = 1)")


def lineage_select(src: str, cols=SILVER_COLS, run_ts=fx.RUN_TS_1) -> str:
    return (f"SELECT {', '.join(cols)}, ingestion_date AS _source_ingestion_date, "
            f"batch_id AS _source_batch_id, {ts(run_ts)} AS _silver_loaded_at FROM {src}")


def state_pred(date_expr: str, batch_expr: str) -> str:
    return (f"(CAST(ingestion_date AS DATE) > CAST({date_expr} AS DATE) OR "
            f"(CAST(ingestion_date AS DATE) = CAST({date_expr} AS DATE) AND batch_id > {batch_expr}))")


def merge_select(t: str, s: str, cols, pk, cursor: str, run_ts: str) -> str:
    """Final SELECT of a MERGE: t/s are CTEs with presence flags tp/sp;
    s carries ingestion_date/batch_id."""
    take = (f"(COALESCE(s.sp, FALSE) AND (t.tp IS NULL OR "
            f"COALESCE(s.{cursor} > t.{cursor}, FALSE)))")
    out = []
    for c in cols:
        if c in pk:
            out.append(f"CASE WHEN t.tp THEN t.{c} ELSE s.{c} END AS {c}")
        else:
            out.append(f"CASE WHEN {take} THEN s.{c} ELSE t.{c} END AS {c}")
    out.append(f"CASE WHEN {take} THEN s.ingestion_date ELSE t._source_ingestion_date END "
               f"AS _source_ingestion_date")
    out.append(f"CASE WHEN {take} THEN s.batch_id ELSE t._source_batch_id END AS _source_batch_id")
    out.append(f"CASE WHEN {take} THEN {ts(run_ts)} ELSE t._silver_loaded_at END "
               f"AS _silver_loaded_at")
    on = " AND ".join(f"t.{k} = s.{k}" for k in pk)
    return (f"SELECT {', '.join(out)} FROM (SELECT *, TRUE AS tp FROM {t}) t "
            f"FULL OUTER JOIN (SELECT *, TRUE AS sp FROM {s}) s ON {on}")


TARGET_CTES = (f"WITH {fx.BRONZE_EVENTS_SQL},\n{clean_cte()},\n"
               f"{latest_cte('tgt_latest', 'clean', f'ingestion_date <= {chr(39)}{fx.SPLIT_DATE}{chr(39)}')},\n"
               f"target AS ({lineage_select('tgt_latest')}),\n"
               f"st AS (SELECT max(CAST(_source_ingestion_date AS TIMESTAMP)) AS d FROM target),\n"
               f"state AS (SELECT d, (SELECT max(_source_batch_id) FROM target "
               f"WHERE CAST(_source_ingestion_date AS TIMESTAMP) = st.d) AS b FROM st)")

SOURCE_CTE = (latest_cte("source", "(SELECT clean.* FROM clean, state WHERE "
                         + state_pred("state.d", "state.b") + ")"))


def _sql() -> dict[str, str]:
    q: dict[str, str] = {}
    bronze = f"WITH {fx.BRONZE_EVENTS_SQL}"

    q["date_anomaly_filter"] = f"{bronze} SELECT * FROM bronze_events WHERE {anomaly_pred()}"

    q["latest_per_key"] = (f"{bronze}, {clean_cte()}, {latest_cte('l', 'clean')} "
                           f"SELECT {', '.join(EVENT_COLS)}, ingestion_date, batch_id FROM l")

    q["latest_per_key_composite"] = (
        "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, "
        "l_linenumber ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC, l_suppkey DESC, "
        "l_extendedprice DESC) AS rn FROM lineitem) WHERE rn = 1")

    q["silver_initial_load"] = (f"{bronze}, {clean_cte()}, {latest_cte('l', 'clean')} "
                                f"{lineage_select('l')}")
    q["silver_rebuild"] = q["silver_initial_load"]
    # micro-batches merged in any order: the latest row of each key over all of them
    q["stream_merge"] = (f"WITH {fx.STREAM_EVENTS_SQL}, {clean_cte()}, {latest_cte('l', 'clean')} "
                         f"{lineage_select('l')}")

    q["lineage_columns"] = (f"{bronze} SELECT {', '.join(EVENT_COLS)}, "
                            f"ingestion_date AS _source_ingestion_date, batch_id AS _source_batch_id, "
                            f"{ts(fx.RUN_TS_1)} AS _silver_loaded_at FROM bronze_events")

    q["exclude_columns"] = (f"{bronze} SELECT event_id, entity_id, event_type, valid_ts, cursor_ts, "
                            f"ingestion_date, batch_id FROM bronze_events")

    q["batch_state"] = (f"{TARGET_CTES} SELECT CAST(d AS TIMESTAMP) AS ingestion_ts, b AS batch_id "
                        f"FROM state")

    d, b = fx.MID_STATE
    q["incremental_filter"] = (f"{bronze} SELECT * FROM bronze_events WHERE "
                               + state_pred(f"DATE '{d}'", f"'{b}'"))

    q["merge_latest"] = (f"{TARGET_CTES},\n{SOURCE_CTE}\n"
                         + merge_select("target", "source", SILVER_COLS, fx.EVENTS_PK,
                                        fx.EVENTS_CURSOR, fx.RUN_TS_2))

    q["merge_outcome"] = (
        f"{TARGET_CTES},\n{SOURCE_CTE}\n"
        "SELECT CASE WHEN s.sp IS NULL THEN 'untouched' WHEN t.tp IS NULL THEN 'inserted' "
        "WHEN COALESCE(s.cursor_ts > t.cursor_ts, FALSE) THEN 'updated' ELSE 'kept' END AS outcome, "
        "count(*) AS n_keys FROM (SELECT *, TRUE AS tp FROM target) t FULL OUTER JOIN "
        "(SELECT *, TRUE AS sp FROM source) s ON t.entity_id = s.entity_id AND "
        "t.event_type = s.event_type GROUP BY 1")

    q["append_initial_load"] = (f"{bronze}, {clean_cte(f'ingestion_date <= {chr(39)}{fx.SPLIT_DATE}{chr(39)}')} "
                                f"{lineage_select('clean')}")

    q["append_incremental"] = (
        f"{TARGET_CTES},\n"
        f"tgt_all AS ({lineage_select('clean WHERE ingestion_date <= ' + chr(39) + fx.SPLIT_DATE + chr(39))}),\n"
        f"st2 AS (SELECT max(CAST(_source_ingestion_date AS TIMESTAMP)) AS d FROM tgt_all),\n"
        f"state2 AS (SELECT d, (SELECT max(_source_batch_id) FROM tgt_all "
        f"WHERE CAST(_source_ingestion_date AS TIMESTAMP) = st2.d) AS b FROM st2),\n"
        f"added AS ({lineage_select('(SELECT clean.* FROM clean, state2 WHERE ' + state_pred('state2.d', 'state2.b') + ')', run_ts=fx.RUN_TS_2)})\n"
        f"SELECT * FROM tgt_all UNION ALL SELECT * FROM added")

    q["null_profile"] = (f"{bronze} SELECT count(*) AS total_rows, "
                         + ", ".join(f"count({c}) AS {c}__nonnull"
                                     for c in EVENT_COLS + ["ingestion_date", "batch_id"])
                         + " FROM bronze_events")
    q["footer_null_profile"] = q["null_profile"]

    q["prune_null_columns"] = (f"{bronze} SELECT event_id, entity_id, event_type, value, valid_ts, "
                               f"cursor_ts, ingestion_date, batch_id FROM bronze_events")

    q["key_violations"] = (
        "SELECT l_orderkey, l_linenumber, count(*) AS n_rows, "
        "CASE WHEN l_orderkey IS NULL OR l_linenumber IS NULL THEN 'null_key' ELSE 'duplicate' END "
        "AS kind FROM lineitem GROUP BY l_orderkey, l_linenumber "
        "HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL")

    q["date_columns"] = (
        f"{bronze} SELECT column_name, 'timestamp' AS data_type FROM "
        f"(DESCRIBE SELECT * FROM bronze_events) WHERE column_type LIKE 'TIMESTAMP%' "
        f"OR column_type = 'DATE'")
    return q


def upsert_select(t: str, s: str, tcols, scols, pk) -> str:
    on = " AND ".join(f"t.{k} = s.{k}" for k in pk)
    out = []
    for c in list(tcols) + [c for c in scols if c not in tcols]:
        t_val = f"t.{c}" if c in tcols else "NULL"
        out.append(f"CASE WHEN s.sp THEN s.{c} ELSE {t_val} END AS {c}" if c in scols
                   else f"{t_val} AS {c}")
    return (f"SELECT {', '.join(out)} FROM (SELECT *, TRUE AS tp FROM {t}) t "
            f"FULL OUTER JOIN (SELECT *, TRUE AS sp FROM {s}) s ON {on}")


GOLD_COLS = ["order_id", "customer_id", "status", "total", "modified_at", "priority"]

# DuckDB type names -> catalog types (same rule as functions.types)
CATALOG_TYPE_CASE = """CASE
  WHEN column_type LIKE '%[]' OR column_type LIKE 'STRUCT%' OR column_type LIKE 'MAP%' THEN 'string'
  WHEN column_type = 'BOOLEAN' THEN 'boolean'
  WHEN column_type IN ('TINYINT', 'SMALLINT', 'INTEGER') THEN 'int'
  WHEN column_type IN ('BIGINT', 'HUGEINT') THEN 'bigint'
  WHEN column_type = 'FLOAT' THEN 'float'
  WHEN column_type = 'DOUBLE' THEN 'double'
  WHEN column_type = 'DATE' THEN 'date'
  WHEN column_type LIKE 'TIMESTAMP%' THEN 'timestamp'
  WHEN column_type LIKE 'DECIMAL%' THEN lower(column_type)
  WHEN column_type = 'BLOB' THEN 'binary'
  ELSE 'string' END"""

SCHEMA_TABLES = ("region nation customer supplier part orders lineitem events documents "
                 "embeddings pages benchmark labels conversations").split()


def infer_schema_sql() -> str:
    parts = [f"SELECT '{t}' AS dataset, '{t}' AS table_name, "
             f"CAST(row_number() OVER () AS INTEGER) AS ordinal, column_name, "
             f"{CATALOG_TYPE_CASE} AS column_type FROM (DESCRIBE SELECT * FROM {t})"
             for t in SCHEMA_TABLES]
    return "\nUNION ALL\n".join(parts)


def _sql_gold() -> dict[str, str]:
    q: dict[str, str] = {}
    q["watermark_filter"] = (f"SELECT * FROM orders WHERE o_orderdate >= "
                             f"{ts(fx.GOLD_PREV_WATERMARK)} - INTERVAL {fx.GOLD_OVERLAP_SECONDS} SECOND")
    q["map_columns"] = ("SELECT CAST(o_orderkey AS BIGINT) AS order_id, CAST(o_custkey AS BIGINT) AS "
                        "customer_id, o_orderstatus AS status, CAST(o_totalprice AS DOUBLE) AS total, "
                        "CAST(o_orderdate AS TIMESTAMP) AS modified_at, o_orderpriority AS priority, "
                        "CAST(NULL AS VARCHAR) AS comment FROM orders")
    q["watermark_max"] = (
        "SELECT greatest(max(TRY_CAST(CASE WHEN o_orderstatus = 'P' THEN 'not a timestamp' "
        "ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS TIMESTAMP)), "
        f"{ts(fx.GOLD_PREV_WATERMARK)}) AS watermark FROM orders")
    q["upsert_overwrite"] = (f"WITH {fx.SILVER_ORDERS_SQL}, {fx.GOLD_TARGET_SQL}, {fx.GOLD_SOURCE_SQL} "
                             + upsert_select("gold_target", "gold_source", GOLD_COLS, GOLD_COLS,
                                             fx.ORDERS_PK))
    q["gold_load"] = q["upsert_overwrite"]
    cut = ts(fx.LINK_CUTOFF)
    q["upsert_do_nothing"] = (
        f"WITH t AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem WHERE l_shipdate <= {cut}), "
        f"s AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem WHERE l_shipdate > {cut}) "
        "SELECT * FROM t UNION ALL SELECT * FROM s WHERE NOT EXISTS "
        "(SELECT 1 FROM t WHERE t.l_orderkey = s.l_orderkey AND t.l_partkey = s.l_partkey)")
    q["watermark_upsert"] = (
        f"WITH store AS (SELECT 'orders' AS source_table, max(o_orderdate) AS last_watermark, "
        f"{ts(fx.RUN_TS_1)} AS updated_at FROM orders WHERE o_orderdate <= {ts(fx.GOLD_TARGET_CUTOFF)} "
        f"UNION ALL SELECT 'events', max(ts), {ts(fx.RUN_TS_1)} FROM events "
        f"WHERE ts < {ts(fx.SPLIT_DATE + ' 00:00:00')}), "
        f"new AS (SELECT 'orders' AS source_table, max(o_orderdate) AS last_watermark, "
        f"{ts(fx.RUN_TS_2)} AS updated_at FROM orders UNION ALL "
        f"SELECT 'lineitem', max(l_shipdate), {ts(fx.RUN_TS_2)} FROM lineitem) "
        + upsert_select("store", "new", ["source_table", "last_watermark", "updated_at"],
                        ["source_table", "last_watermark", "updated_at"], ["source_table"]))
    q["reconcile_missing_keys"] = (
        f"{TARGET_CTES}\n SELECT target.*, NOT EXISTS (SELECT 1 FROM bronze_events s WHERE s.entity_id % 17 <> 3 "
        f"AND s.entity_id = target.entity_id AND s.event_type = target.event_type) AS is_deleted "
        f"FROM target")
    q["reconcile_by_digest"] = q["reconcile_table"] = q["reconcile_missing_keys"]
    cols = ["doc_id", "text", "lang", "source", "n_chars"]
    vals = ", ".join(f"coalesce('\"' || replace(CAST({c} AS VARCHAR), '\"', '\"\"') || '\"', "
                     f"'\\N')" for c in cols)
    q["staging_csv"] = (f"SELECT doc_id, concat_ws(',', {vals}) AS line FROM "
                        f"(SELECT doc_id, text, nullif(lang, 'de') AS lang, source, n_chars "
                        f"FROM documents)")
    q["sanitize_identifier"] = ("SELECT o_orderkey, o_orderpriority, regexp_replace(lower("
                                "o_orderpriority), '[^a-z0-9_]', '_', 'g') AS table_name FROM orders")
    q["normalize_prefix"] = (
        "WITH p AS (SELECT event_id, CASE WHEN event_type = 'error' THEN '/' ELSE "
        "'//lake/' || event_type || '//' END AS raw_prefix, 'part-' || event_id || '.parquet' AS name "
        "FROM events), c AS (SELECT *, regexp_replace(raw_prefix, '^/+|/+$', '', 'g') AS clean FROM p), "
        "n AS (SELECT event_id, raw_prefix, name, CASE WHEN clean = '' THEN '' ELSE clean || '/' END "
        "AS prefix FROM c) SELECT event_id, raw_prefix, prefix, "
        "substr(prefix || 'EVENTS/' || name, length(prefix) + 1) AS relative_key FROM n")
    q["infer_schema"] = infer_schema_sql()
    q["type_compat"] = (
        "WITH s AS (" + infer_schema_sql() + "), m AS (SELECT table_name, column_name, "
        "CASE column_type WHEN 'bigint' THEN 'bigint' WHEN 'int' THEN 'integer' "
        "WHEN 'double' THEN 'double precision' WHEN 'float' THEN 'real' "
        "WHEN 'timestamp' THEN 'timestamp without time zone' WHEN 'string' THEN 'character varying' "
        "WHEN 'boolean' THEN 'boolean' WHEN 'date' THEN 'date' ELSE column_type END AS existing_type, "
        "CASE column_type WHEN 'bigint' THEN 'BIGINT' WHEN 'int' THEN 'INT' "
        "WHEN 'double' THEN 'DOUBLE PRECISION' WHEN 'float' THEN 'REAL' WHEN 'timestamp' THEN 'TIMESTAMP' "
        "WHEN 'string' THEN 'TEXT' WHEN 'boolean' THEN 'BOOLEAN' WHEN 'date' THEN 'DATE' "
        "ELSE upper(column_type) END AS configured_type FROM s), "
        "n AS (SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(lower(existing_type), "
        "'^timestamp.*$', 'timestamp'), '^character varying.*$', 'text'), 'varchar', 'text')) AS ne, "
        "trim(regexp_replace(regexp_replace(regexp_replace(lower(configured_type), "
        "'^timestamp.*$', 'timestamp'), '^character varying.*$', 'text'), 'varchar', 'text')) AS nc "
        "FROM m) SELECT table_name, column_name, existing_type, configured_type, ne = nc AS compatible "
        "FROM n")
    q["schema_diff"] = (
        "WITH ex AS (SELECT column_name, " + CATALOG_TYPE_CASE + " AS t FROM (DESCRIBE SELECT "
        "o_orderkey AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id, o_orderstatus AS status, "
        "o_totalprice AS total, 'x' AS legacy_column FROM orders)), "
        "conf AS (SELECT * FROM (VALUES ('order_id', 'bigint'), ('customer_id', 'bigint'), "
        "('status', 'string'), ('total', 'double'), ('modified_at', 'timestamp'), "
        "('priority', 'string')) v(column_name, t)) "
        "SELECT 'add' AS kind, column_name, CAST(NULL AS VARCHAR) AS existing_type, t AS configured_type "
        "FROM conf WHERE column_name NOT IN (SELECT column_name FROM ex) "
        "UNION ALL SELECT 'extra', column_name, NULL, NULL FROM ex "
        "WHERE column_name NOT IN (SELECT column_name FROM conf) "
        "UNION ALL SELECT 'type_mismatch', c.column_name, e.t, c.t FROM conf c JOIN ex e "
        "ON c.column_name = e.column_name WHERE e.t <> c.t "
        "UNION ALL SELECT 'pk_mismatch', NULL, 'order_id,status', 'order_id'")
    old_tgt = TARGET_CTES.replace(
        f"target AS ({lineage_select('tgt_latest')})",
        "target AS (" + lineage_select(
            "tgt_latest", ["event_id", "entity_id", "event_type", "CAST(NULL AS DOUBLE) AS value",
                           "cursor_ts", "legacy_col"]) + ")")
    q["add_missing_columns"] = (f"{old_tgt},\n{SOURCE_CTE}\n"
                                + merge_select("target", "source", SILVER_COLS, fx.EVENTS_PK,
                                               fx.EVENTS_CURSOR, fx.RUN_TS_2))
    return q


PARSED_CTES = (
    f"WITH {fx.BRONZE_PATHS_SQL},\n"
    "f AS (SELECT *, string_split(key, '/') AS parts FROM bronze_paths),\n"
    "g AS (SELECT *, parts[1] AS dataset, parts[2:-2] AS dirs, "
    "list_filter(parts[2:-2], lambda x: instr(x, '=') > 1) AS pd FROM f "
    "WHERE len(parts) >= 2 AND lower(parts[-1]) LIKE '%.parquet'),\n"
    "parsed AS (SELECT event_id, key, last_modified, size, dataset, "
    "list_transform(pd, lambda x: split_part(x, '=', 1)) AS raw_names, "
    "list_transform(pd, lambda x: regexp_replace(lower(split_part(x, '=', 1)), '[^a-z0-9_]', '_', 'g')) AS names, "
    "list_transform(pd, lambda x: substr(x, instr(x, '=') + 1)) AS vals, "
    "dataset || '/' || array_to_string(dirs, '/') || '/' AS location FROM g)")


def layout_ctes(src: str = "parsed", suffix: str = "") -> str:
    return (f"lay{suffix} AS (SELECT dataset, arg_min(names, key) AS layout FROM {src} "
            f"WHERE len(names) > 0 GROUP BY dataset),\n"
            f"j{suffix} AS (SELECT p.*, l.layout, (len(p.names) = 0 OR "
            f"COALESCE(p.names = l.layout, FALSE)) AS conforms "
            f"FROM {src} p LEFT JOIN lay{suffix} l ON p.dataset = l.dataset)")


def distinct_parts_cte(name: str, src: str) -> str:
    return (f"{name} AS (SELECT dataset, vals, arg_min(location, key) AS location, "
            f"any_value(layout) AS names FROM {src} WHERE len(names) > 0 AND conforms "
            f"GROUP BY dataset, vals)")


def _sql_paths() -> dict[str, str]:
    q: dict[str, str] = {}
    q["parse_partition_path"] = (
        f"{PARSED_CTES} SELECT event_id, key, dataset, array_to_string(raw_names, '/') AS raw_names, "
        "array_to_string(vals, '/') AS values, location FROM parsed")
    q["dataset_summary"] = (
        f"{PARSED_CTES},\n{layout_ctes()} SELECT dataset, count(*) AS n_files, "
        "array_to_string(any_value(layout), ',') AS layout, "
        "count(DISTINCT CASE WHEN len(names) > 0 AND conforms THEN array_to_string(vals, '/') END) "
        "AS n_partitions, min(CASE WHEN conforms THEN key END) AS sample_file, "
        "count(CASE WHEN len(names) > 0 AND NOT conforms THEN 1 END) AS n_incompatible, "
        "regexp_replace(lower(dataset), '[^a-z0-9_]', '_', 'g') AS table_name FROM j GROUP BY dataset")
    q["partition_layout_check"] = (
        f"{PARSED_CTES},\n{layout_ctes()} SELECT dataset, key, array_to_string(names, ',') AS names, "
        "array_to_string(layout, ',') AS layout FROM j WHERE len(names) > 0 AND NOT conforms")
    q["distinct_partitions"] = (
        f"{PARSED_CTES},\n{layout_ctes()},\n{distinct_parts_cte('d', 'j')} SELECT dataset, "
        "array_to_string(vals, '/') AS values, location, array_to_string(names, ',') AS names FROM d")
    cut = ts(fx.CRAWL_CUTOFF)
    q["new_partitions"] = (
        f"{PARSED_CTES},\n{layout_ctes()},\n{distinct_parts_cte('d', 'j')},\n"
        f"old AS (SELECT * FROM parsed WHERE last_modified < {cut}),\n{layout_ctes('old', '2')},\n"
        f"{distinct_parts_cte('r', 'j2')} SELECT dataset, array_to_string(vals, '/') AS values, "
        "location, array_to_string(names, ',') AS names FROM d WHERE NOT EXISTS (SELECT 1 FROM r "
        "WHERE r.dataset = d.dataset AND r.vals = d.vals)")
    q["list_partitions"] = (f"WITH {fx.BRONZE_EVENTS_SQL} SELECT DISTINCT ingestion_date, batch_id "
                            "FROM bronze_events")
    listing = (f"listing AS (SELECT dataset, key, size + CASE WHEN CAST(last_modified AS DATE) = "
               f"DATE '{fx.REWRITE_DAY}' THEN 1 ELSE 0 END AS length, last_modified AS modification_time "
               f"FROM parsed)")
    inv = (f"inv AS (SELECT dataset, key, size AS length, last_modified AS modification_time, "
           f"{ts(fx.RUN_TS_1)} AS processed_at FROM parsed WHERE last_modified < {cut})")
    changed = ("changed AS (SELECT * FROM listing l WHERE NOT EXISTS (SELECT 1 FROM inv i WHERE "
               "i.dataset = l.dataset AND i.key = l.key AND i.length = l.length AND "
               "i.modification_time = l.modification_time))")
    q["changed_files"] = f"{PARSED_CTES},\n{listing},\n{inv},\n{changed} SELECT * FROM changed"
    gone = ("gone AS (SELECT * FROM inv i WHERE NOT EXISTS (SELECT 1 FROM listing l WHERE i.dataset = l.dataset AND i.key = l.key "
            "AND i.length = l.length AND i.modification_time = l.modification_time))")
    folder = "regexp_replace(key, '[^/]*$', '') AS folder"
    q["changed_folders"] = (
        f"{PARSED_CTES},\n{listing},\n{inv},\n{changed},\n{gone} "
        f"SELECT DISTINCT dataset, folder FROM (SELECT dataset, {folder} FROM changed UNION ALL SELECT dataset, {folder} FROM gone) "
        f"WHERE (dataset, folder) IN (SELECT (dataset, {folder.removesuffix(' AS folder')}) FROM listing)")
    cols = ["dataset", "key", "length", "modification_time", "processed_at"]
    q["file_inventory_upsert"] = (
        f"{PARSED_CTES},\n{listing},\n{inv},\n{changed},\n"
        f"chg AS (SELECT *, {ts(fx.RUN_TS_2)} AS processed_at FROM changed) "
        + upsert_select("inv", "chg", cols, cols, ["dataset", "key"]))
    return q


def _sql_tables() -> dict[str, str]:
    q: dict[str, str] = {}
    q["gold_watermark_store"] = (f"SELECT 'orders' AS source_table, max(o_orderdate) AS last_watermark, "
                                 f"{ts(fx.RUN_TS_1)} AS updated_at FROM orders")
    # entry: Silver after initial load + MERGE, mapped to the serving table
    q["entry"] = (f"{TARGET_CTES},\n{SOURCE_CTE},\nmerged AS ("
                  + merge_select("target", "source", SILVER_COLS, fx.EVENTS_PK, fx.EVENTS_CURSOR,
                                 fx.RUN_TS_2)
                  + ") SELECT entity_id, event_type, CAST(value AS DOUBLE) AS last_value, "
                    "cursor_ts AS modified_at, event_id AS last_event_id FROM merged")
    split = f"'{fx.SPLIT_DATE}'"
    q["run_summary"] = (
        f"{TARGET_CTES},\n{SOURCE_CTE},\n"
        f"merged AS ({merge_select('target', 'source', SILVER_COLS, fx.EVENTS_PK, fx.EVENTS_CURSOR, fx.RUN_TS_2)}),\n"
        f"log AS (SELECT * FROM clean WHERE ingestion_date <= {split}),\n"
        "log_d AS (SELECT max(CAST(ingestion_date AS TIMESTAMP)) AS d FROM log),\n"
        "log_state AS (SELECT d, (SELECT max(batch_id) FROM log "
        "WHERE CAST(ingestion_date AS TIMESTAMP) = log_d.d) AS b FROM log_d),\n"
        "log_added AS (SELECT clean.* FROM clean, log_state WHERE "
        + state_pred("log_state.d", "log_state.b") + "),\n"
        "st_txt AS (SELECT strftime(d, '%Y-%m-%d') AS sd, b AS sb FROM state),\n"
        "log_txt AS (SELECT strftime(d, '%Y-%m-%d') AS sd, b AS sb FROM log_state)\n"
        "SELECT 'events' AS dataset, 'dedupe_latest' AS mode, 'INITIAL LOAD' AS operation, "
        "'OK (INITIAL LOAD)' AS status, (SELECT count(*) FROM target) AS rows_written, "
        "CAST(NULL AS VARCHAR) AS state_date, CAST(NULL AS VARCHAR) AS state_batch, 1 AS run\n"
        "UNION ALL SELECT 'events_log', 'append_only', 'INITIAL LOAD', 'OK (INITIAL LOAD)', "
        "(SELECT count(*) FROM log), NULL, NULL, 1\n"
        "UNION ALL SELECT 'events_gated', 'append_only', NULL, "
        "'SKIPPED (requires confirmation): needs review', NULL, NULL, NULL, 1\n"
        "UNION ALL SELECT 'events', 'dedupe_latest', 'INCREMENTAL UPDATE', 'OK (INCREMENTAL UPDATE)', "
        "(SELECT count(*) FROM merged), sd, sb, 2 FROM st_txt\n"
        "UNION ALL SELECT 'events_log', 'append_only', 'INCREMENTAL UPDATE', "
        "'OK (INCREMENTAL UPDATE)', (SELECT count(*) FROM log_added), sd, sb, 2 FROM log_txt\n"
        "UNION ALL SELECT 'events_gated', 'append_only', NULL, "
        "'SKIPPED (requires confirmation): needs review', NULL, NULL, NULL, 2")
    # Bronze written by Spark as one file per partition folder (see
    # fixtures.write_bronze_files): EVENTS by (ingestion_date, batch_id),
    # Orders.v1 by o_orderpriority.
    crawl_facts = (
        f"WITH {fx.BRONZE_EVENTS_SQL},\n"
        "ev AS (SELECT count(*) AS n, min('ingestion_date=' || ingestion_date || '/batch_id=' || batch_id) "
        "AS first_dir FROM (SELECT DISTINCT ingestion_date, batch_id FROM bronze_events)),\n"
        "od AS (SELECT count(*) AS n, min('o_orderpriority=' || o_orderpriority) AS first_dir "
        "FROM (SELECT DISTINCT o_orderpriority FROM orders)),\n"
        "ev_cols AS (SELECT count(*) AS c FROM (DESCRIBE SELECT * EXCLUDE (ingestion_date, batch_id) "
        "FROM bronze_events)),\n"
        "od_cols AS (SELECT count(*) AS c FROM (DESCRIBE SELECT * EXCLUDE (o_orderpriority) FROM orders))\n")

    def crawl_rows(action: str, created_ev: str, created_od: str, source: str, run: str = "") -> str:
        r = f", {run} AS run" if run else ""
        return (f"SELECT 'EVENTS' AS dataset, 'events' AS table_name, n AS n_files, "
                f"'EVENTS/' || first_dir || '/' AS sample_dir, CAST(c AS INTEGER) AS n_columns, "
                f"'ingestion_date,batch_id' AS partition_columns, n AS n_partitions, "
                f"'{action}' AS action, {created_ev} AS partitions_created, "
                f"{'NULL' if created_ev == 'NULL' else '0'} AS partitions_failed, "
                f"'{source}' AS schema_source{r} FROM ev, ev_cols\n"
                f"UNION ALL SELECT 'Orders.v1', 'orders_v1', n, 'Orders.v1/' || first_dir || '/', "
                f"CAST(c AS INTEGER), 'o_orderpriority', n, '{action}', {created_od}, "
                f"{'NULL' if created_od == 'NULL' else '0'}, '{source}'{(', ' + run) if run else ''} "
                f"FROM od, od_cols")

    q["crawl_plan"] = crawl_facts + crawl_rows("PLAN", "NULL", "NULL", "file")
    q["file_listing"] = (
        f"WITH {fx.BRONZE_EVENTS_SQL} SELECT 'EVENTS' AS dataset, "
        "ingestion_date || '/' || batch_id AS values, TRUE AS non_empty "
        "FROM (SELECT DISTINCT ingestion_date, batch_id FROM bronze_events) "
        "UNION ALL SELECT 'Orders.v1', o_orderpriority, TRUE "
        "FROM (SELECT DISTINCT o_orderpriority FROM orders)")
    q["register_table"] = (crawl_facts + crawl_rows("created", "ev.n", "od.n", "file", "1")
                           + "\nUNION ALL\n" + crawl_rows("updated", "0", "0", "cache", "2"))
    q["bronze_scan"] = f"WITH {fx.BRONZE_EVENTS_SQL} SELECT * FROM bronze_events"
    q["bronze_table_scan"] = q["bronze_scan"]
    q["catalog_partitions"] = (f"WITH {fx.BRONZE_EVENTS_SQL} SELECT DISTINCT ingestion_date, batch_id "
                               "FROM bronze_events")
    q["table_columns"] = (f"WITH {fx.BRONZE_EVENTS_SQL} SELECT column_name, {CATALOG_TYPE_CASE} AS "
                          "data_type FROM (DESCRIBE SELECT * EXCLUDE (ingestion_date, batch_id) "
                          "FROM bronze_events)")
    return q


ORACLE_SQL = {**_sql(), **_sql_gold(), **_sql_paths(), **_sql_tables()}
