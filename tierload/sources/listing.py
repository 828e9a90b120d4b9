"""Object listing and the Bronze scan.

The listing walks the tree inside tasks.  A frontier of prefixes is dealt
over the tasks; each task lists its prefixes and the folders below them
for some ``SECONDS`` per prefix (and at most ``FOLDERS`` of them), and hands
back the folders that are left as the next frontier: a small or quick tree
takes one round, a slow store spreads early.  Every round is written, so a lost executor repeats
its prefixes only, and the driver sees one number per round: how many
prefixes are left.  All objects are listed, whatever their names begin
with.
"""

from __future__ import annotations

import logging
import os
import re
import time
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.identifiers import normalize_prefix_str
from ..session import new_run_dir
from .paths import PARQUET_SUFFIX

log = logging.getLogger(__name__)

FOLDERS = 10_000     # folders a task lists below one prefix of the frontier, at most
SECONDS = 0.5        # and for how long it goes on (one folder at least)
ROWS = 10_000        # entries per batch
STEP = "folder boolean, key string, length long, modified long"

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


def _strip_scheme(path: str) -> str:
    return re.sub(_SCHEME, "", path)


def _absolute(root: str) -> str:
    base = root.rstrip("/")
    if not re.match(_SCHEME, base) and not base.startswith("/"):
        base = os.path.abspath(base)
    return base


def open_tree(base: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a root; raises ``ArrowInvalid`` for schemes it does not know."""
    if not re.match(_SCHEME, base):
        return pafs.LocalFileSystem(), base
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", re.sub(r"^file:/*", "file:///", base)))


def children(fs: pafs.FileSystem, path: str, missing_ok: bool) -> Iterator[tuple[bool, str, int, int]]:
    """(folder, name, length, modified ms) of everything directly below ``path``.

    A local folder is streamed; links to folders are not followed (they
    may lead back up).  Other systems give one folder's entries at once."""
    if isinstance(fs, pafs.LocalFileSystem):
        try:
            with os.scandir(path) as entries:
                for e in entries:
                    if e.is_dir(follow_symlinks=False):
                        yield True, e.name, 0, 0
                    elif e.is_file():
                        st = e.stat()
                        yield False, e.name, st.st_size, st.st_mtime_ns // 1_000_000
        except FileNotFoundError:
            if not missing_ok:
                raise
        return
    for e in fs.get_file_info(pafs.FileSelector(path, allow_not_found=missing_ok)):
        if e.type == pafs.FileType.Directory:
            yield True, e.base_name, 0, 0
        elif e.type == pafs.FileType.File:
            yield False, e.base_name, e.size or 0, (e.mtime_ns or 0) // 1_000_000


def expand(fs: pafs.FileSystem, base: str, prefix: str, folders: int, missing_ok: bool) -> Iterator[tuple[bool, str, int, int]]:
    """Files below ``prefix``, and the folders left when ``folders`` of them were listed or time is up."""
    left, seen = [prefix], 0
    until = time.monotonic() + SECONDS
    while left and seen < folders and (not seen or time.monotonic() < until):
        here, seen = left.pop(), seen + 1
        for folder, name, length, modified in children(fs, f"{base}/{here}".rstrip("/") or "/", missing_ok or here != prefix):
            if folder:
                left.append(f"{here}{name}/")
            else:
                yield False, here + name, length, modified
    for here in left:
        yield True, here, 0, 0


def walk(spark: SparkSession, root: str, prefix: str = "", folders: int = FOLDERS) -> DataFrame:
    """``(folder, key, length, modified)`` of every file below ``root/prefix``, keys relative to ``root``.

    A folder that vanishes meanwhile is empty; a missing ``root/prefix``
    raises."""
    base = _absolute(root)
    out = new_run_dir(spark, "listing")
    todo, n, step = spark.createDataFrame([(prefix,)], "key string"), 1, 0
    most = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    while n:
        first = step == 0

        def run(batches: Iterator[pa.RecordBatch], first: bool = first) -> Iterator[pa.RecordBatch]:
            fs, path = open_tree(base)
            rows: list = []
            for batch in batches:
                for key in batch.column(0).to_pylist():
                    for row in expand(fs, path.rstrip("/"), key, folders, not first):
                        rows.append(row)
                        if len(rows) >= ROWS:
                            yield _batch(rows)
                            rows = []
            if rows:
                yield _batch(rows)

        path = f"{out}/step={step}"
        todo.repartition(min(n, most)).mapInArrow(run, STEP).write.parquet(path)
        todo = spark.read.schema(STEP).parquet(path).where("folder").select("key")
        n, step = todo.count(), step + 1         # one number per round
    return spark.read.schema(STEP).parquet(*[f"{out}/step={i}" for i in range(step)]).where("NOT folder")


def _batch(rows: list) -> pa.RecordBatch:
    folder, key, length, modified = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(folder), pa.array(key, pa.string()), pa.array(length, pa.int64()),
                                       pa.array(modified, pa.int64())], ["folder", "key", "length", "modified"])


def list_files(spark: SparkSession, root: str, prefix: str = "",
               parquet_only: bool = True) -> DataFrame:
    """``(key, length, modification_time)`` for every file below
    ``root/prefix``; ``key`` is relative to ``root`` (object-store
    style, prefix included).  Only ``.parquet`` files (any case) unless
    ``parquet_only=False``.  Lists when it is called.

    A file system that only Spark's readers can open is listed by
    ``index_files``."""
    base = _absolute(root)
    p = normalize_prefix_str(prefix)
    try:
        open_tree(base)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError) as e:
        log.warning("%s is listed by the driver's file index: %s", base, e)
        out = index_files(spark, base, p)
    else:
        out = walk(spark, base, p).select("key", "length", F.timestamp_millis("modified").cast("timestamp_ntz").alias("modification_time"))
    if parquet_only:
        out = out.where(F.lower("key").endswith(PARQUET_SUFFIX))
    return out


def index_files(spark: SparkSession, root: str, prefix: str = "") -> DataFrame:
    """The listing of Spark's file index (``binaryFile`` without its
    content): one entry per file in driver memory, and names that begin
    with ``_`` or ``.`` are left out."""
    base = _absolute(root)
    df = (spark.read.format("binaryFile")
          .option("recursiveFileLookup", "true")
          .load(f"{base}/{prefix}" if prefix else base)
          .select("path", "length", "modificationTime"))
    rel_root = _strip_scheme(base) + "/"
    key = F.regexp_replace(F.col("path"), _SCHEME, "")
    key = key.substr(F.lit(len(rel_root) + 1), F.length(key))
    return df.select(key.alias("key"), F.col("length"),
                     F.col("modificationTime").cast("timestamp_ntz").alias("modification_time"))


def bronze_scan(spark: SparkSession, location: str, partition_names: list[str],
                data_schema: T.StructType | None = None, sample: str | None = None) -> DataFrame:
    """Read a Hive-partitioned Parquet dataset with its partition
    columns as STRING (what the catalog declares), independent of the
    session's type-inference setting.  Filters on partition columns
    prune directories; other filters are pushed to the Parquet reader."""
    loc = location.rstrip("/")
    if data_schema is None:
        data_schema = spark.read.parquet(sample or loc).schema
    part = {n.lower() for n in partition_names}
    fields = [f for f in data_schema.fields if f.name.lower() not in part]
    fields += [T.StructField(n, T.StringType()) for n in partition_names]
    return spark.read.schema(T.StructType(fields)).option("basePath", loc).parquet(loc)
