"""Relational (JDBC) sink for Gold tables: staging table + one MERGE.

Rows are bulk-written by Spark's JDBC writer into a staging table
(batched inserts, at most ``max_connections`` concurrent sessions,
rows per batch capped by the bound-parameter limit), then a single
statement merges staging into the keyed target inside one transaction
(all or nothing) and the staging table is dropped.  A zero-row load
skips the merge.

With a ``run_id`` the same transaction first records the run in
``<table>_runs``, whose primary key is the run: a retry finds its record
and is skipped, and of two runs at the same time the second one's insert
fails, which rolls its merge back.

Names are quoted part by part and found as they are written; the target
schema qualifies names that have none.  An existing target is guarded: new columns are added, a changed key or
an incompatible type is refused.

Statements that Spark's JDBC source cannot issue (DDL, MERGE) run over
one driver-side JDBC connection.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import safe_batch_size
from ..functions.types import catalog_type
from ..operators.schema_ops import guard, schema_diff, schema_pairs

# Column types per target dialect.
_DERBY_TYPES = {"boolean": "BOOLEAN", "int": "INTEGER", "bigint": "BIGINT", "float": "REAL",
                "double": "DOUBLE", "date": "DATE", "timestamp": "TIMESTAMP",
                "string": "VARCHAR(32672)", "binary": "BLOB"}
_POSTGRES_TYPES = {"boolean": "BOOLEAN", "int": "INTEGER", "bigint": "BIGINT", "float": "REAL",
                   "double": "DOUBLE PRECISION", "date": "DATE", "timestamp": "TIMESTAMP",
                   "string": "TEXT", "binary": "BYTEA"}
# Concurrent sessions against the relational target.
DEFAULT_MAX_CONNECTIONS = 5


def _dialect(url: str) -> str:
    return "postgres" if url.startswith("jdbc:postgresql") else "standard"


def _qi(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def quoted(table: str) -> str:
    """``schema.table`` with each part quoted, so it is found as it is written."""
    return ".".join(_qi(p) for p in table.split("."))


def column_ddl(field: T.StructField, url: str) -> str:
    types = _POSTGRES_TYPES if _dialect(url) == "postgres" else _DERBY_TYPES
    ct = catalog_type(field.dataType)
    return types.get(ct, ct.upper())


def create_table_sql(table: str, schema: T.StructType, pk: list[str], url: str) -> str:
    cols = [f"{_qi(f.name)} {column_ddl(f, url)}" + (" NOT NULL" if f.name in pk else "")
            for f in schema.fields]
    cols.append(f"PRIMARY KEY ({', '.join(_qi(k) for k in pk)})")
    return f"CREATE TABLE {quoted(table)} ({', '.join(cols)})"


def runs_table(table: str) -> str:
    return f"{table}_runs"


def create_runs_sql(table: str, url: str) -> str:
    text = column_ddl(T.StructField("run_id", T.StringType()), url)
    # a key column: the widest type may be too long for an index
    text = text if _dialect(url) == "postgres" else "VARCHAR(200)"
    return (f"CREATE TABLE {quoted(runs_table(table))} ({_qi('run_id')} {text} NOT NULL, "
            f"{_qi('n_rows')} BIGINT NOT NULL, PRIMARY KEY ({_qi('run_id')}))")


def record_run_sql(table: str, run_id: str, n_rows: int) -> str:
    value = run_id.replace("'", "''")
    return f"INSERT INTO {quoted(runs_table(table))} ({_qi('run_id')}, {_qi('n_rows')}) VALUES ('{value}', {n_rows:d})"


def find_run_sql(table: str, run_id: str) -> str:
    value = run_id.replace("'", "''")
    return f"SELECT {_qi('n_rows')} FROM {quoted(runs_table(table))} WHERE {_qi('run_id')} = '{value}'"


def add_column_sql(table: str, field: T.StructField, url: str) -> str:
    return f"ALTER TABLE {quoted(table)} ADD COLUMN {_qi(field.name)} {column_ddl(field, url)}"


def merge_sql(table: str, staging: str, columns: list[str], pk: list[str], url: str) -> str:
    """Insert-or-overwrite from staging; DO NOTHING when all columns are key."""
    non_key = [c for c in columns if c not in pk]
    cols = ", ".join(_qi(c) for c in columns)
    table, staging = quoted(table), quoted(staging)
    if _dialect(url) == "postgres":
        action = ("DO UPDATE SET " + ", ".join(f"{_qi(c)} = EXCLUDED.{_qi(c)}" for c in non_key)
                  if non_key else "DO NOTHING")
        return (f"INSERT INTO {table} ({cols}) SELECT {cols} FROM {staging} "
                f"ON CONFLICT ({', '.join(_qi(k) for k in pk)}) {action}")
    on = " AND ".join(f"t.{_qi(k)} = s.{_qi(k)}" for k in pk)
    upd = (" WHEN MATCHED THEN UPDATE SET " + ", ".join(f"{_qi(c)} = s.{_qi(c)}" for c in non_key)
           if non_key else "")
    return (f"MERGE INTO {table} t USING {staging} s ON {on}{upd} "
            f"WHEN NOT MATCHED THEN INSERT ({cols}) VALUES ({', '.join('s.' + _qi(c) for c in columns)})")


class JdbcTarget:
    """A relational database; ``schema`` holds the tables named without one."""

    def __init__(self, spark: SparkSession, url: str, properties: dict | None = None, schema: str | None = None):
        self.spark = spark
        self.url = url
        self.properties = dict(properties or {})
        self.schema = schema

    def full_name(self, table: str) -> str:
        return f"{self.schema}.{table}" if self.schema and "." not in table else table

    def _connection(self):
        jvm = self.spark.sparkContext._jvm
        props = jvm.java.util.Properties()
        for k, v in self.properties.items():
            props.setProperty(k, str(v))
        return jvm.java.sql.DriverManager.getConnection(self.url, props)

    def execute(self, *statements: str) -> None:
        """Run statements in one transaction (rollback on error)."""
        conn = self._connection()
        try:
            conn.setAutoCommit(False)
            stmt = conn.createStatement()
            for s in statements:
                stmt.execute(s)
            conn.commit()
        except Exception:
            conn.rollback()
            raise
        finally:
            conn.close()

    def query(self, statement: str) -> list[tuple]:
        """The rows of a small result, as strings."""
        conn = self._connection()
        try:
            rs = conn.createStatement().executeQuery(statement)
            n = rs.getMetaData().getColumnCount()
            out = []
            while rs.next():
                out.append(tuple(rs.getString(i + 1) for i in range(n)))
            return out
        finally:
            conn.close()

    @staticmethod
    def _name(md, table: str) -> tuple[str | None, str]:
        """``(schema, table)`` with the wildcards of the metadata calls escaped."""
        schema, _, name = table.rpartition(".")
        escape = md.getSearchStringEscape() or ""

        def plain(x: str) -> str:
            return "".join(escape + c if c in "_%" else c for c in x)

        return plain(schema) if schema else None, plain(name)

    def table_exists(self, table: str) -> bool:
        conn = self._connection()
        try:
            md = conn.getMetaData()
            return bool(md.getTables(None, *self._name(md, table), None).next())
        finally:
            conn.close()

    def primary_key(self, table: str) -> list[str]:
        """Key columns of an existing table (no order)."""
        conn = self._connection()
        try:
            schema, _, name = table.rpartition(".")     # this call takes no patterns
            rs, out = conn.getMetaData().getPrimaryKeys(None, schema or None, name), []
            while rs.next():
                out.append(rs.getString("COLUMN_NAME"))
            return out
        finally:
            conn.close()

    def existing_columns(self, table: str) -> list[tuple[str, str]]:
        """``(column, catalog type)`` of an existing table (no row is read)."""
        return schema_pairs(self.read(f"(SELECT * FROM {quoted(table)} WHERE 1 = 0) t").schema)

    def read(self, table: str) -> DataFrame:
        return (self.spark.read.format("jdbc").option("url", self.url).option("dbtable", table)
                .option("preferTimestampNTZ", "true").options(**self.properties).load())

    def ensure_table(self, table: str, schema: T.StructType, pk: list[str]) -> bool:
        """Create the table (``True``), or check it and add new columns.

        A changed key or an incompatible type raises ``SchemaGuardError``
        before anything is changed; columns that the frame has not got
        are left alone."""
        if not self.table_exists(table):
            self.execute(create_table_sql(table, schema, pk, self.url))
            return True
        key = self.primary_key(table)
        to_add = guard(schema_diff(schema_pairs(schema), pk, self.existing_columns(table), key), table, pk, key)
        if to_add:
            self.execute(*[add_column_sql(table, schema[n], self.url) for n, _ in to_add])
        return False

    def finished(self, table: str, run_id: str) -> int | None:
        """Rows of a recorded run, ``None`` when it is not recorded."""
        if not self.table_exists(runs_table(table)):
            return None
        got = self.query(find_run_sql(table, run_id))
        return int(got[0][0]) if got else None

    def upsert(self, df: DataFrame, table: str, pk: list[str], batch_size: int = 2500,
               max_connections: int = DEFAULT_MAX_CONNECTIONS, run_id: str | None = None) -> int:
        """Stage ``df`` and merge it into ``table`` by ``pk``; returns the
        number of staged rows.  A ``run_id`` that is recorded already is
        not staged again (its recorded number is returned)."""
        table = self.full_name(table)
        self.ensure_table(table, df.schema, pk)
        if run_id is not None:
            done = self.finished(table, run_id)
            if done is not None:
                return done
            if not self.table_exists(runs_table(table)):
                self.execute(create_runs_sql(table, self.url))
        staging = f"{table}_stg_{uuid.uuid4().hex[:8]}"
        batch = safe_batch_size(batch_size, len(df.columns))
        try:
            n = self.stage(df, staging, batch, max_connections)
            merge = [merge_sql(table, staging, df.columns, pk, self.url)] if n else []
            record = [] if run_id is None else [record_run_sql(table, run_id, n)]
            if merge or record:
                self.execute(*record, *merge)        # one transaction: both or neither
        finally:
            if self.table_exists(staging):
                self.execute(f"DROP TABLE {quoted(staging)}")
        return n

    def stage(self, df: DataFrame, staging: str, batch: int, max_connections: int) -> int:
        """Write ``df`` into a new table; the number of its rows."""
        rows = Observation(f"staged_{uuid.uuid4().hex[:8]}")
        # the source is computed at full width; only the insert runs in a few sessions
        staged = df.observe(rows, F.count(F.lit(1)).alias("n")).repartition(max_connections)
        writer = (staged.write.format("jdbc").option("url", self.url).option("dbtable", quoted(staging))
                  .option("batchsize", batch).options(**self.properties).mode("errorifexists"))
        if _dialect(self.url) == "standard":     # other targets: the types of Spark's own dialect
            writer = writer.option("createTableColumnTypes", ", ".join(
                f"{f.name} {column_ddl(f, self.url)}" for f in df.schema.fields))
        writer.save()
        return rows.get.get("n", 0)
