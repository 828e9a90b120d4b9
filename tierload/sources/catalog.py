"""Catalog registration of external, Hive-partitioned Parquet tables.

DDL goes through the session catalog (in-memory in tests, a Hive
metastore on a cluster).  Partitions are added in chunks with
``ADD IF NOT EXISTS``, each with its location; the partition list is
streamed to the driver chunk by chunk (``toLocalIterator``), never
collected whole.

A new table carries a mark until all its partitions are registered
(``settled``), so a registration that was cut off is taken up again.
"""

from __future__ import annotations

import logging
from collections import defaultdict
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.identifiers import sanitize_name
from .paths import new_partitions

log = logging.getLogger(__name__)

# Partitions per registration statement.
PARTITION_BATCH = 100
SETTLED_PROP = "tierload.partitions"      # "registered": all known partitions are in the catalog


def _q(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def _lit(v: str | None) -> str:
    if v is None:
        return "NULL"
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def split_columns(schema: T.StructType, partition_names: list[str]) -> T.StructType:
    """Data columns: the file schema minus partition columns (compared
    by sanitised, case-insensitive name)."""
    part = {sanitize_name(n) for n in partition_names}
    return T.StructType([f for f in schema.fields if sanitize_name(f.name) not in part])


def register_table(spark: SparkSession, name: str, location: str, columns: T.StructType,
                   partition_names: list[str], known: DataFrame | None = None) -> str:
    """Create or update an external Parquet table; returns ``created``
    or ``updated``.  Partition columns are STRING.  An update adds new
    columns in place; any other change makes the definition anew
    (external: the files are untouched).

    The new definition is complete, with every partition at its location,
    before it takes the table's name.  The partitions are those of
    ``known`` (``values``, ``location``), where it is given and the table
    is settled, else those of the catalog itself."""
    def create(table: str) -> str:
        cols = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in columns.fields]
                         + [f"`{p}` string" for p in partition_names])
        parts = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in partition_names)})" if partition_names else ""
        return f"CREATE TABLE {_q(table)} ({cols}) USING parquet{parts} LOCATION {_lit(location)}"

    if not spark.catalog.tableExists(name):
        spark.sql(create(name))
        return "created"
    existing = spark.table(name).schema
    have = {f.name: f.dataType for f in existing.fields}
    current_parts = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    changed = any(f.name in have and have[f.name] != f.dataType for f in columns.fields)
    if not changed and current_parts == list(partition_names):
        new = [f for f in columns.fields if f.name not in have]
        if new:
            spark.sql(f"ALTER TABLE {_q(name)} ADD COLUMNS ("
                      + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new) + ")")
        return "updated"
    # the catalog has no way to change a column type in place
    staged = f"{name}__next"
    spark.sql(f"DROP TABLE IF EXISTS {_q(staged)}")
    spark.sql(create(staged))
    if current_parts and current_parts == list(partition_names):
        complete = settled(spark, name)
        rows = ((r["values"], r["location"]) for r in known.select("values", "location").toLocalIterator()) \
            if known is not None and complete else catalog_locations(spark, name)
        _, failed = _register(spark, staged, partition_names, rows)
        if failed:
            raise RuntimeError(f"{len(failed)} partitions of {name} cannot be registered with the new definition")
        if complete:
            settle(spark, staged)
    spark.sql(f"DROP TABLE {_q(name)}")
    spark.sql(f"ALTER TABLE {_q(staged)} RENAME TO {_q(name)}")
    return "updated"


def settled(spark: SparkSession, name: str) -> bool:
    """Are all partitions that were known at some point in the catalog?"""
    rows = spark.sql(f"SHOW TBLPROPERTIES {_q(name)}").where(F.col("key") == SETTLED_PROP).collect()
    return bool(rows) and rows[0]["value"] == "registered"


def settle(spark: SparkSession, name: str) -> None:
    spark.sql(f"ALTER TABLE {_q(name)} SET TBLPROPERTIES ('{SETTLED_PROP}' = 'registered')")


def catalog_locations(spark: SparkSession, name: str) -> Iterator[tuple[list, str]]:
    """(values, location) of every partition of a table, asked of the
    catalog one by one (for tables without a ledger)."""
    names = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    for r in show_partitions(spark, name).toLocalIterator():
        values = [r[n] for n in names]
        spec = ", ".join(f"`{n}` = {_lit(v)}" for n, v in zip(names, values))
        told = spark.sql(f"DESCRIBE TABLE EXTENDED {_q(name)} PARTITION ({spec})")
        yield values, told.where(F.col("col_name") == "Location").first()["data_type"]


def registered_partitions(spark: SparkSession, name: str, dataset: str) -> DataFrame:
    """``(dataset, values)`` of the partitions the catalog knows."""
    names = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    if not names:
        return spark.createDataFrame([], "dataset string, values array<string>")
    shown = spark.sql(f"SHOW PARTITIONS {_q(name)}")
    spec = F.split(F.col("partition"), "/")
    values = F.transform(spec, lambda x: _unescape(x.substr(F.instr(x, "=") + 1, F.length(x))))
    return shown.select(F.lit(dataset).alias("dataset"), values.alias("values"))


def _unescape(c):
    """Undo the catalog's ``%XX`` path escaping (``+`` stays ``+``)."""
    return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def show_partitions(spark: SparkSession, name: str) -> DataFrame:
    """``SHOW PARTITIONS`` as one string column per partition column."""
    names = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    spec = F.split(F.col("partition"), "/")
    return spark.sql(f"SHOW PARTITIONS {_q(name)}").select(
        *[_unescape(F.element_at(spec, i + 1).substr(len(n) + 2, 1 << 30)).alias(n)
          for i, n in enumerate(names)])


def add_partitions(spark: SparkSession, name: str, partition_names: list[str],
                   discovered: DataFrame, dataset: str) -> tuple[int, int]:
    """Register discovered partitions that are not registered yet, in
    chunks of ``PARTITION_BATCH``.  Returns ``(created, failed)``; a
    failing chunk is retried partition by partition.  Vanished
    partitions are never dropped."""
    todo = new_partitions(discovered.where(F.col("dataset") == dataset),
                          registered_partitions(spark, name, dataset))
    created, failed = _register(spark, name, partition_names, (
        (r["values"], r["location"]) for r in todo.select("values", "location").toLocalIterator()))
    return created, len(failed)


def _register(spark: SparkSession, name: str, partition_names: list[str],
              rows: Iterable[tuple[list, str]]) -> tuple[int, list[list]]:
    """Add partitions at their locations, in chunks; (number added, values that failed)."""
    created, failed, chunk = 0, [], []
    for row in rows:
        chunk.append(row)
        if len(chunk) >= PARTITION_BATCH:
            n, bad = _add_chunk(spark, name, partition_names, chunk)
            created, failed, chunk = created + n, failed + bad, []
    n, bad = _add_chunk(spark, name, partition_names, chunk)
    return created + n, failed + bad


def _add_chunk(spark: SparkSession, name: str, partition_names: list[str], chunk: list) -> tuple[int, list[list]]:
    if not chunk:
        return 0, []
    specs = ["PARTITION (" + ", ".join(f"`{n}` = {_lit(v)}" for n, v in zip(partition_names, vals))
             + f") LOCATION {_lit(loc)}" for vals, loc in chunk]
    try:
        spark.sql(f"ALTER TABLE {_q(name)} ADD IF NOT EXISTS {' '.join(specs)}")
        return len(chunk), []
    except Exception:  # one bad partition must not keep the others out
        created, failed = 0, []
        for spec, (vals, _) in zip(specs, chunk):
            try:
                spark.sql(f"ALTER TABLE {_q(name)} ADD IF NOT EXISTS {spec}")
                created += 1
            except Exception as e:
                log.warning("registering %s of %s failed: %s", spec, name, e)
                failed.append(vals)
        return created, failed


def register_partitions(spark: SparkSession, todo: DataFrame,
                        tables: dict[str, tuple[str, list[str]]]) -> tuple[dict[str, int], list[tuple[str, list]]]:
    """Register ``(dataset, values, location)`` rows of many datasets in
    one pass over them; ``tables`` gives each dataset's table and
    partition columns.  Returns partitions added per dataset and the
    ``(dataset, values)`` that failed.  At most one chunk per dataset is
    held."""
    created: dict[str, int] = defaultdict(int)
    failed: list[tuple[str, list]] = []
    chunks: dict[str, list] = defaultdict(list)

    def flush(dataset: str) -> None:
        table, names = tables[dataset]
        n, bad = _add_chunk(spark, table, names, chunks.pop(dataset))
        created[dataset] += n
        failed.extend((dataset, v) for v in bad)

    for r in todo.select("dataset", "values", "location").toLocalIterator():
        chunks[r["dataset"]].append((r["values"], r["location"]))
        if len(chunks[r["dataset"]]) >= PARTITION_BATCH:
            flush(r["dataset"])
    for dataset in list(chunks):
        flush(dataset)
    return created, failed


def table_columns(spark: SparkSession, name: str) -> DataFrame:
    from .schema import table_columns as _tc
    return _tc(spark, name)
