"""Versioned tables on plain Parquet: write new files, commit, publish.

Plain Parquet has no MERGE and a table cannot be overwritten while it
is being read, so every write produces new files and a new version.  A
version is a numbered view ``<name>__v<number>``; its properties hold all
that belongs to it (data table, batch state, stream epochs, key).

* *Commit*: ``CREATE VIEW <name>__v<n + 1>``, one catalog statement that
  fails when the number is taken.  The version, its state and its epochs
  appear together or not at all, and of two writers that read version
  ``n`` only one gets ``n + 1``: the other merges again on top of it.
* *Publish*: the public name, a view too, is pointed at the version.  A
  writer that dies between the two loses nothing: whoever opens the table
  next publishes the committed version first.

A failed write leaves the previous version untouched and readable.

Keyed tables are stored **bucketed by their key** (``bucketBy`` +
``sortBy``).  A merge joins the current version with a small
incremental source on the key: the bucketed side already satisfies the
join's distribution, so only the source is shuffled (into the same
number of buckets), and because every task then holds exactly one
bucket, the new version is written without another exchange and with
one file per bucket.

The bucket number is also the partition column (``tierload_bucket``, not
shown to readers), so each bucket has a folder of its own and ``merge``
reads and writes only the buckets that hold a key of the source.  The
next version registers the others where they already are: bucket folders
are never changed after they are written, and versions share them.

Tables without a key are made of **append segments**: each append (or
stream epoch) writes a folder of its own.  Committing version ``n`` names
that folder; it then becomes partition ``n`` of the data table, and a
version reads the partitions up to its own number.
"""

from __future__ import annotations

import logging
import re
import uuid
from collections.abc import Callable
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import work_dir

log = logging.getLogger(__name__)

BUCKET_COL = "tierload_bucket"            # partition column of keyed tables: the row's bucket
SEGMENT_COL = "tierload_segment"          # partition column of the others: number of the version that added the row
VERSION_PROP = "tierload.version"         # of the public view
DATA_PROP = "tierload.data"               # the version's data table
SEGMENT_PROP = "tierload.segment"         # folder that the version adds
KEY_PROP = "tierload.key"
BUCKETS_PROP = "tierload.buckets"
ROWS_PROP = "tierload.rows"               # + "." + number: rows per bucket, in parts
# batch state of the data in a version, observed while it was written
STATE_DATE_PROP = "tierload.state.date"
STATE_BATCH_PROP = "tierload.state.batch"
# what a version does not take over from the one before
OWN_PROPS = (VERSION_PROP, DATA_PROP, SEGMENT_PROP, KEY_PROP, BUCKETS_PROP, ROWS_PROP, STATE_DATE_PROP, STATE_BATCH_PROP)
LINEAGE_DATE, LINEAGE_BATCH = "_source_ingestion_date", "_source_batch_id"
TABLE_ROOT_CONF = "tierload.table.root"   # shared folder for table versions
COMMIT_ATTEMPTS = 10
PROP_CHARS = 3000                         # metastores bound the length of a property


class ConcurrentCommit(RuntimeError):
    """Another writer committed on top of the version that was read."""


def _q(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def _text(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _chunks(items: list, size: int = 100) -> list[list]:
    return [items[i:i + size] for i in range(0, len(items), size)]


class Merged(NamedTuple):
    """What ``SnapshotTable.merge`` wrote: the version, its rewritten
    buckets (``None``: all), the buckets it took over unchanged, and the
    rows of the version."""
    version: str
    touched: list[int] | None
    carried: list[int]
    rows: int | None = None


class SnapshotTable:
    """A table written as immutable versions and published through a view.

    ``key`` and ``buckets`` make it a keyed table (bucketed by the key);
    without them it is a table of append segments.  ``buckets``
    defaults to ``spark.sql.shuffle.partitions`` when the table is
    created; an existing table keeps its bucket count."""

    def __init__(self, spark: SparkSession, name: str, key: list[str] | tuple | None = None,
                 buckets: int | None = None, root: str | None = None):
        self.spark = spark
        self.name = name
        self.key = list(key or [])
        if buckets is None and self.key:
            # default: the cluster's configured shuffle parallelism
            buckets = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
        self.buckets = buckets if self.key else None
        base = spark.conf.get(TABLE_ROOT_CONF, None) or f"{work_dir(spark)}/tables"
        self.root = (root or f"{base.rstrip('/')}/{name}").rstrip("/")

    # ------------------------------------------------------------ catalog
    def _sql(self, statement: str) -> DataFrame:
        """Every catalog change goes through here, one statement at a time."""
        return self.spark.sql(statement)

    def _has(self, name: str) -> bool:
        return self.spark.catalog.tableExists(name)

    def _version_name(self, number: int) -> str:
        return f"{self.name}__v{number:012d}"

    def _number(self, version: str | None) -> int:
        found = re.fullmatch(r".*__v(\d{12})", version or "")
        return int(found[1]) if found else 0

    def _props(self, name: str) -> dict[str, str]:
        return {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {_q(name)}").collect()}

    def exists(self) -> bool:
        if self._has(self.name):
            return True
        first = self._version_name(1)      # committed, but never published
        if not self._has(first):
            return False
        self._save_state(first)
        return True

    def current_version(self) -> str | None:
        """The newest committed version; it is published if its writer did
        not come to it."""
        if not self.exists():
            return None
        v = self._props(self.name).get(VERSION_PROP)
        if v and self._has(self._version_name(self._number(v) + 1)):
            v = self._save_state(self._version_name(self._number(v) + 1))
        return v

    def stored_prop(self, prop: str) -> str | None:
        """A property of the current version, ``None`` without it."""
        v = self.current_version()
        return None if v is None else self._props(v).get(prop)

    def stored_key(self) -> list[str]:
        return [k for k in (self.stored_prop(KEY_PROP) or "").split(",") if k]

    def stored_buckets(self) -> int | None:
        val = self.stored_prop(BUCKETS_PROP)
        return int(val) if val else None

    def effective_buckets(self) -> int | None:
        """Bucket count the next version will have."""
        return (self.stored_buckets() or self.buckets) if self.key else None

    def join_partitions(self) -> int | None:
        """Partition count a source must be hash-partitioned into to join
        this table without moving it: the bucket count when it differs
        from ``spark.sql.shuffle.partitions`` (else ``None``: the source's
        own shuffle already matches)."""
        b = self.effective_buckets()
        shuffle = int(self.spark.conf.get("spark.sql.shuffle.partitions", "200"))
        return b if b and b != shuffle else None

    def state(self, version: str | None = None) -> tuple | None:
        """``(date 'YYYY-MM-DD', batch_id)`` of the newest Bronze batch in
        the current (or a named) version, or ``None`` when empty.  Read
        from the version's properties (observed during the write, so no
        scan); computed with one aggregate for versions without it."""
        v = version or self.current_version()
        if v is None:
            return None
        known = self._stored_state(self._props(v))
        if known is not None:
            return (known[0][:10], known[1] or None) if known[0] else None
        current = self.read(version=v)
        if LINEAGE_DATE not in current.columns or LINEAGE_BATCH not in current.columns:
            return None
        from ..operators.incremental import read_state
        return read_state(current)

    @staticmethod
    def _stored_state(props: dict[str, str]) -> tuple[str, str] | None:
        date = props.get(STATE_DATE_PROP)
        return None if date is None else (date, props.get(STATE_BATCH_PROP) or "")

    def _observe_state(self, df: DataFrame):
        if LINEAGE_DATE not in df.columns or LINEAGE_BATCH not in df.columns:
            return df, None
        from ..operators.incremental import state_metric
        obs = Observation(f"state_{uuid.uuid4().hex[:8]}")
        return df.observe(obs, state_metric(LINEAGE_DATE, LINEAGE_BATCH).alias("s")), obs

    @staticmethod
    def _state_props(obs, previous: tuple | None) -> dict[str, str]:
        """State of the written rows, never below ``previous``."""
        if obs is None:
            return {}
        s = obs.get.get("s")
        new = (s["d"].strftime("%Y-%m-%d %H:%M:%S"), s["b"]) if s is not None else None
        if previous is not None and previous[0] and (
                new is None or (previous[0][:10], previous[1] or "") > (new[0][:10], new[1] or "")):
            new = previous
        date, batch = new if new else ("", "")
        return {STATE_DATE_PROP: date, STATE_BATCH_PROP: batch or ""}

    def _data(self, version: str) -> str:
        return self._props(version)[DATA_PROP]

    def read(self, buckets: list[int] | None = None, version: str | None = None) -> DataFrame:
        """The current (or a named) version: the bucketed table itself, so
        joins on the key can use its partitioning; or only some of its
        buckets.  Without the bucket or segment column."""
        v = version or self.current_version()
        if v is None:
            raise ValueError(f"table {self.name} does not exist")
        df = self.spark.table(self._data(v))
        if SEGMENT_COL in df.columns:
            df = df.where(F.col(SEGMENT_COL) <= F.lit(self._number(v)).cast("bigint"))
        return (df if buckets is None else df.where(F.col(BUCKET_COL).isin(buckets))).drop(BUCKET_COL, SEGMENT_COL)

    # ------------------------------------------------------------ buckets
    def _bucket(self, buckets: int):
        """The bucket of a row: the hash Spark itself deals bucketed rows by."""
        return F.pmod(F.hash(*[F.col(k) for k in self.key]), F.lit(buckets))

    def touched_buckets(self, keys: DataFrame) -> list[int] | None:
        """Buckets of the current version that hold, or would hold, a key
        of ``keys`` (at most one number per bucket); ``None`` when they
        cannot be told: the version has no bucket folders, or a key
        column has another type."""
        v, buckets = self.current_version(), self.stored_buckets()
        if not buckets or BUCKET_COL not in self.spark.table(self._data(v)).columns:
            return None
        stored = {f.name.lower(): f.dataType for f in self.schema.fields}
        given = {f.name.lower(): f.dataType for f in keys.schema.fields}
        if any(stored.get(k.lower()) != given.get(k.lower()) for k in self.key):
            return None
        return sorted(r["b"] for r in keys.select(self._bucket(buckets).alias("b")).distinct().collect())

    def bucket_folders(self, version: str | None = None) -> dict[int, str]:
        """The folder of every non-empty bucket of a version (default: the
        current one).  A folder may only be removed when no registered
        version lists it."""
        out = {}
        for f in self.spark.table(self._data(version or self.current_version())).inputFiles():
            folder = unquote(f).rsplit("/", 1)[0]
            name, _, bucket = folder.rsplit("/", 1)[-1].partition("=")
            if name == BUCKET_COL:
                out[int(bucket)] = folder
        return out

    def _count_buckets(self, data: str, buckets: list[int]) -> dict[int, int]:
        """Rows of some buckets of a data table (footers only: no column is read)."""
        if not buckets:
            return {}
        got = self.spark.table(data).where(F.col(BUCKET_COL).isin(buckets)).groupBy(BUCKET_COL).agg(F.count("*").alias("n"))
        return {r[BUCKET_COL]: r["n"] for r in got.collect()}      # one row per bucket

    @staticmethod
    def _stored_rows(props: dict[str, str]) -> dict[int, int]:
        """Rows per bucket, as far as they are stored."""
        out = {}
        for k, text in props.items():
            if k.startswith(ROWS_PROP + "."):
                out.update((int(b), int(n)) for b, n in (x.split(":") for x in text.split(",") if x))
        return out

    @staticmethod
    def _rows_props(rows: dict[int, int]) -> dict[str, str]:
        size = PROP_CHARS // 30
        return {f"{ROWS_PROP}.{i}": ",".join(f"{b}:{n}" for b, n in part)
                for i, part in enumerate(_chunks(sorted(rows.items()), size))}

    @property
    def schema(self) -> T.StructType:
        return self.read().schema

    # ------------------------------------------------------------- commit
    def _select(self, data: str, number: int) -> str:
        columns = self.spark.table(data).columns
        where = f" WHERE {SEGMENT_COL} <= {number}L" if SEGMENT_COL in columns else ""
        return ("SELECT " + ", ".join(f"`{c}`" for c in columns if c not in (BUCKET_COL, SEGMENT_COL))
                + f" FROM {_q(data)}{where}")

    def _commit(self, base: str | None, make: Callable[[dict[str, str]], dict[str, str]], rebase: bool) -> str:
        """Commit the version after ``base`` and publish it.

        ``make`` gives its properties from those of the version before.
        When another writer took the number: the next one with ``rebase``,
        else ``ConcurrentCommit``."""
        number = self._number(base) + 1
        before = self._props(base) if base else {}
        while True:
            v = self._version_name(number)
            props = {k: x for k, x in before.items() if k.startswith("tierload.") and not k.startswith(OWN_PROPS)}
            props.update(make(before))
            body = ", ".join(f"{_text(k)} = {_text(x)}" for k, x in sorted(props.items()))
            try:
                self._sql(f"CREATE VIEW {_q(v)} TBLPROPERTIES ({body}) AS {self._select(props[DATA_PROP], number)}")
                break
            except AnalysisException:
                if not self._has(v):
                    raise
                self._save_state(v)
                if not rebase:
                    raise ConcurrentCommit(f"{self.name}: {v} was committed by another writer") from None
                before, number = self._props(v), number + 1
        self._save_state(v)
        return v

    def _save_state(self, version: str) -> str:
        """Bring the catalog up to a committed version and the ones after
        it: register its segment, point the public name at it.  Repeating
        this is harmless."""
        while True:
            props, number = self._props(version), self._number(version)
            data = props[DATA_PROP]
            if SEGMENT_PROP in props:
                self._sql(f"ALTER TABLE {_q(data)} ADD IF NOT EXISTS PARTITION ({SEGMENT_COL} = {number}) "
                          f"LOCATION {_text(props[SEGMENT_PROP])}")
                self.spark.catalog.refreshTable(data)
            self._sql(f"CREATE OR REPLACE VIEW {_q(self.name)} TBLPROPERTIES ({_text(VERSION_PROP)} = {_text(version)}) "
                      f"AS {self._select(data, number)}")
            # a slower writer must not leave the name behind a newer version
            following = self._version_name(number + 1)
            if not self._has(following):
                return version
            version = following

    # ------------------------------------------------------------- writes
    def write(self, df: DataFrame, aligned: bool = False, check: Callable[[], None] | None = None,
              props: dict[str, str] | None = None) -> str:
        """Write ``df`` as a new version that replaces all rows, and
        publish it.  Returns the version's name.

        ``check`` runs when the rows are written and before they are
        committed: when it raises, the current version stays.  ``props``
        are stored with the version.

        A keyed table keeps the bucket count it was created with.  Rows
        are hash-partitioned by the key into that many partitions first
        (one file per bucket) unless ``aligned``: the caller's plan
        already holds one bucket per task, as the output of a join with
        the current (bucketed) version does."""
        return self._replace(self.current_version(), df, aligned, check, props, rebase=True)

    def _replace(self, base: str | None, df: DataFrame, aligned: bool, check: Callable[[], None] | None,
                 props: dict[str, str] | None, rebase: bool) -> str:
        buckets = int(self._props(base).get(BUCKETS_PROP) or 0) if base else 0
        buckets = buckets or self.buckets
        if self.key and buckets:
            data, obs = self._write_buckets(df, aligned, buckets, check)
            more = self._key_props(buckets)
        else:
            data, folder, obs = self._write_segment(df, self._new_name(), check)
            more = {SEGMENT_PROP: folder}
        return self._commit(base, lambda _: {**self._state_props(obs, None), **more, DATA_PROP: data, **(props or {})}, rebase)

    def _new_name(self) -> str:
        return f"{self.name}__d{uuid.uuid4().hex[:16]}"

    def _key_props(self, buckets: int | None) -> dict[str, str]:
        return {KEY_PROP: ",".join(self.key), BUCKETS_PROP: str(buckets or 0)}

    def _write_buckets(self, df: DataFrame, aligned: bool, buckets: int, check: Callable[[], None] | None):
        """(data table, state observation) of a new bucketed data table."""
        data = self._new_name()
        if not aligned:
            df = df.repartition(buckets, *[F.col(k) for k in self.key])
        df, obs = self._observe_state(df)
        (df.withColumn(BUCKET_COL, self._bucket(buckets)).write.partitionBy(BUCKET_COL)
         .bucketBy(buckets, *self.key).sortBy(*self.key)
         .format("parquet").option("path", f"{self.root}/{data.rsplit('__', 1)[-1]}").mode("errorifexists").saveAsTable(data))
        self._checked(data, check)
        return data, obs

    def _write_segment(self, df: DataFrame, data: str, check: Callable[[], None] | None = None):
        """(data table, folder, state observation) of a new segment; the data table is created when new."""
        df, obs = self._observe_state(df)
        folder = f"{self.root}/s{uuid.uuid4().hex[:16]}"
        df.write.parquet(folder)
        if not self._has(data):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
            self._sql(f"CREATE TABLE {_q(data)} ({columns}, {SEGMENT_COL} bigint) USING parquet PARTITIONED BY ({SEGMENT_COL}) "
                      f"LOCATION {_text(self.root + '/' + data.rsplit('__', 1)[-1])}")
            self._checked(data, check)
        return data, folder, obs

    def _checked(self, data: str, check: Callable[[], None] | None) -> None:
        if check is not None:
            try:
                check()
            except Exception:
                self._sql(f"DROP TABLE {_q(data)}")
                raise

    def merge(self, keys: DataFrame, merged: Callable[[DataFrame], DataFrame], aligned: bool = True,
              check: Callable[[], None] | None = None, props: dict[str, str] | None = None) -> Merged:
        """Write and publish the next version, rewriting only the buckets
        touched by ``keys`` (a frame with the source's key columns).

        ``merged`` gets the current rows of these buckets and returns
        what replaces them: old and new rows whose keys lie in them.  It
        must keep every row and must not change keys.  The other buckets
        are taken over where they are, unread.  Keys spread over all
        buckets rewrite the whole table; then, and when the buckets
        cannot be told, ``merged`` gets all of it.

        When another writer commits meanwhile, ``merged`` is called again
        with the rows of that version, so no committed row is lost.

        ``check`` and ``props`` as in ``write``."""
        for attempt in range(1, COMMIT_ATTEMPTS + 1):
            try:
                return self._merge(keys, merged, aligned, check, props)
            except ConcurrentCommit as e:
                if attempt == COMMIT_ATTEMPTS:
                    raise
                log.warning("%s; merging again", e)
        raise AssertionError

    def _merge(self, keys, merged, aligned, check, props) -> Merged:
        base = self.current_version()
        before = self._props(base)
        touched = self.touched_buckets(keys)
        current = self.read(touched, base)
        df = merged(current)
        if touched is not None and any(df.schema[k].dataType != current.schema[k].dataType for k in self.key):
            touched, df = None, merged(self.read(version=base))      # another key type: every bucket changes
        carried = {} if touched is None else {
            b: f for b, f in self.bucket_folders(base).items() if b not in set(touched)}
        previous = (self._stored_state(before) or self.state(base)) if carried else None
        buckets = int(before.get(BUCKETS_PROP) or 0) or self.buckets
        log.info("%s: %s of %s buckets are rewritten", self.name, "all" if touched is None else len(touched), buckets)
        data, obs = self._write_buckets(df, aligned, buckets, check)
        rows = self._carry(data, before, touched, carried)
        try:
            version = self._commit(base, lambda _: {**self._state_props(obs, previous), **self._key_props(buckets),
                                                    **self._rows_props(rows), DATA_PROP: data, **(props or {})}, rebase=False)
        except ConcurrentCommit:
            self._sql(f"DROP TABLE {_q(data)}")
            raise
        return Merged(version, touched, sorted(carried), sum(rows.values()))

    def _carry(self, data: str, before: dict[str, str], touched: list[int] | None, carried: dict[int, str]) -> dict[int, int]:
        """Register untouched buckets with the new data table; rows per bucket of the version.

        Only rewritten buckets are counted; the others keep the number
        stored with the version before (counted once where it has none)."""
        rows = self._count_buckets(data, touched) if touched is not None else {
            r[BUCKET_COL]: r["n"] for r in self.spark.table(data).groupBy(BUCKET_COL).agg(F.count("*").alias("n")).collect()}
        for part in _chunks(sorted(carried.items())):
            self._sql(f"ALTER TABLE {_q(data)} ADD " + " ".join(
                f"PARTITION ({BUCKET_COL} = {b}) LOCATION {_text(folder)}" for b, folder in part))
        known = self._stored_rows(before)
        known.update(self._count_buckets(before[DATA_PROP], [b for b in carried if b not in known]) if carried else {})
        return {**rows, **{b: known.get(b, 0) for b in carried}}

    def append(self, df: DataFrame, props: dict[str, str] | None = None, base: str | None = None) -> str:
        """Append rows as a segment of their own, matching columns by name
        (columns missing from ``df`` are written as NULL).  ``props`` are
        committed with it.  With ``base``, the version that ``df`` was
        computed against, another writer's commit raises
        ``ConcurrentCommit``; without, the segment goes on top of it.
        A keyed table gets a new version with the touched buckets
        rewritten, as versions share bucket folders."""
        v = self.current_version()
        if v is None:
            try:
                return self._replace(None, df, False, None, props, rebase=False)
            except ConcurrentCommit:          # another writer created the table
                if base is not None:
                    raise
                v = self.current_version()
        from ..operators.schema_ops import align_to_schema
        target = self.read(version=v).schema
        aligned = align_to_schema(df, target).select(*target.fieldNames())
        if self.key:
            return self.merge(aligned, lambda current: current.unionByName(aligned), aligned=False, props=props).version
        if base is not None and base != v:
            raise ConcurrentCommit(f"{self.name}: {v} was committed after {base}")
        _, folder, obs = self._write_segment(aligned, self._data(v))

        def make(before: dict[str, str]) -> dict[str, str]:
            return {**self._state_props(obs, self._stored_state(before)), SEGMENT_PROP: folder,
                    DATA_PROP: before[DATA_PROP], **(props or {})}
        return self._commit(v, make, rebase=base is None)

    def add_columns(self, fields: list[T.StructField]) -> None:
        """Additive evolution: ``ALTER TABLE ADD COLUMNS`` on the current
        data table (old files read NULL) and re-publish the view."""
        if not fields:
            return
        v = self.current_version()
        data = self._data(v)
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        self._sql(f"ALTER TABLE {_q(data)} ADD COLUMNS ({cols})")
        self.spark.catalog.refreshTable(data)
        self._save_state(v)

    def versions(self) -> list[str]:
        """Versions of this table, oldest first (qualified like the name)."""
        db, _, short = self.name.rpartition(".")
        prefix = f"{short}__v".lower()
        tables = self.spark.catalog.listTables(db) if db else self.spark.catalog.listTables()
        found = sorted(t.name for t in tables if t.name.lower().startswith(prefix) and self._number(t.name))
        return [f"{db}.{t}" if db else t for t in found]

    def drop_old_versions(self, keep: int = 2) -> list[str]:
        """Unregister all but the newest ``keep`` versions (the current one
        is always kept), and data tables that no version is left of.  Their
        folders stay: newer versions may share them (see
        ``bucket_folders``)."""
        cur = self.current_version()
        older = [v for v in self.versions() if v != cur]
        old = older[:max(len(older) - (keep - 1), 0)]
        used = {self._data(v) for v in [*older[len(old):], *([cur] if cur else [])]}
        for v in old:
            data = self._data(v)
            self._sql(f"DROP VIEW IF EXISTS {_q(v)}")
            if data not in used:
                self._sql(f"DROP TABLE IF EXISTS {_q(data)}")
        return old
