"""Parquet footers read in tasks: schemas of many files, null profiles.

One job reads the footers of all files it is given; each task opens its
files by itself, and the driver gets one row per schema asked for.  What
a footer does not tell is read where it lies: files or types that only
Spark's reader knows are left to it, and a null count that is missing is
counted from the column of that row group alone.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import null_profile
from .listing import _absolute, bronze_scan, list_files, open_tree

log = logging.getLogger(__name__)

# The footer key under which Spark keeps its own schema, and
# the folder value that stands for NULL in a partitioned layout.
SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"
HIVE_NULL = "__HIVE_DEFAULT_PARTITION__"
# The reader's settings that change a schema, as they usually are.
READER_SETTINGS = {"spark.sql.parquet.binaryAsString": "false", "spark.sql.parquet.inferTimestampNTZ.enabled": "true"}
HIDDEN = r"(^|/)(\.|_[^/=]*(/|$))"       # names that a scan leaves out

FOOTER = "id string, schema_json string, error string"
COUNTS = "name string, n long, path string, row_group int"
ROWS = 65_536         # values per batch where a column has to be read

_SCALARS = {pa.bool_(): T.BooleanType(), pa.int8(): T.ByteType(), pa.int16(): T.ShortType(), pa.int32(): T.IntegerType(),
            pa.int64(): T.LongType(), pa.float32(): T.FloatType(), pa.float64(): T.DoubleType(),
            pa.string(): T.StringType(), pa.large_string(): T.StringType(), pa.binary(): T.BinaryType(),
            pa.large_binary(): T.BinaryType(), pa.date32(): T.DateType()}


class OnlySpark(ValueError):
    """A footer whose types are left to Spark's reader."""


def open_file(path: str, base: str = "") -> pq.ParquetFile:
    """A file by its path, or by its key below ``base`` (taken as it is, also with ``%`` in it)."""
    fs, inner = open_tree(base or path)
    return pq.ParquetFile(fs.open_input_file(f"{inner.rstrip('/')}/{path}" if base else inner))


def _field_type(t: pa.DataType) -> T.DataType:
    """The type Spark's reader gives; raises for those it decides by more than the footer."""
    if t in _SCALARS:
        return _SCALARS[t]
    if pa.types.is_decimal128(t):
        return T.DecimalType(t.precision, t.scale)
    if pa.types.is_timestamp(t) and t.unit in ("ms", "us"):
        return T.TimestampType() if t.tz else T.TimestampNTZType()
    if pa.types.is_dictionary(t):
        return _field_type(t.value_type)
    if pa.types.is_list(t) or pa.types.is_large_list(t):
        return T.ArrayType(_field_type(t.value_type), True)
    if pa.types.is_struct(t):
        return T.StructType([T.StructField(f.name, _field_type(f.type), True) for f in t])
    raise OnlySpark(str(t))


def footer_schema(f: pq.ParquetFile) -> T.StructType:
    """The schema Spark reads a file with: its own record of it, else the file's types."""
    own = (f.metadata.metadata or {}).get(SPARK_SCHEMA)
    if own:
        return T.StructType.fromJson(json.loads(own))
    leaves = [f.schema.column(i) for i in range(len(f.schema))]
    for leaf in leaves:
        nested = leaf.path.split(".")[1:]
        if leaf.physical_type == "INT96" or (leaf.max_repetition_level and "list" not in nested):
            raise OnlySpark(f"{leaf.path}: {leaf.physical_type}")
    arrow = f.schema_arrow
    return T.StructType([T.StructField(c.name, _field_type(c.type), True) for c in arrow])


def nullable(t: T.DataType) -> T.DataType:
    """A type as a file source gives it: everything may be NULL."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, nullable(f.dataType), True, f.metadata) for f in t.fields])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(nullable(t.elementType), True)
    if isinstance(t, T.MapType):
        return T.MapType(nullable(t.keyType), nullable(t.valueType), True)
    return t


def _read_schemas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, found, errors = batch.column(0).to_pylist(), [], []
        for path in batch.column(1).to_pylist():
            try:
                with open_file(path) as f:
                    found.append(footer_schema(f).json())
                errors.append(None)
            except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OnlySpark, OSError, ValueError) as e:
                found.append(None)
                errors.append(f"{type(e).__name__}: {e}")
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(found, pa.string()),
                                          pa.array(errors, pa.string())], ["id", "schema_json", "error"])


def file_schemas(spark: SparkSession, samples: dict[str, str]) -> dict[str, T.StructType]:
    """``id -> Parquet file`` into ``id -> schema``: one job for all files.

    The schema is what ``spark.read.parquet(file).schema`` gives.  A file
    whose footer cannot be read in a task, or has types that Spark decides
    by its settings, is read by Spark on the driver, and that raises what
    there is to raise."""
    if not samples:
        return {}
    if any(spark.conf.get(k, usual) != usual for k, usual in READER_SETTINGS.items()):
        return {i: spark.read.parquet(p).schema for i, p in samples.items()}
    tasks = min(len(samples), spark.sparkContext.defaultParallelism)
    todo = spark.createDataFrame(list(samples.items()), "id string, path string").repartition(tasks)
    out = {}
    for r in todo.mapInArrow(_read_schemas, FOOTER).collect():      # one row per file asked for
        if r["schema_json"]:
            out[r["id"]] = nullable(T.StructType.fromJson(json.loads(r["schema_json"])))
        else:
            log.info("%s is left to Spark's reader: %s", samples[r["id"]], r["error"])
            out[r["id"]] = spark.read.parquet(samples[r["id"]]).schema
    return out


# ------------------------------------------------------------ null profile

def _folder_values(path: str) -> dict[str, str | None]:
    parts = (p.partition("=") for p in path.split("/")[:-1])
    return {k.lower(): None if v == HIVE_NULL else unquote(v) for k, eq, v in parts if eq}


def _counts(rows: list[tuple]) -> pa.RecordBatch:
    name, n, path, group = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(name, pa.string()), pa.array(n, pa.int64()), pa.array(path, pa.string()),
                                       pa.array(group, pa.int32())], ["name", "n", "path", "row_group"])


def _file_counts(path: str, base: str, columns: list[str], partitions: list[str],
                 known: dict[str | None, int]) -> Iterator[tuple]:
    """Add what the footer tells to ``known`` (``None``: all rows); yield what has to be read."""
    with open_file(path, base) as f:
        md, values = f.metadata, _folder_values(path)
        flat = {md.schema.column(i).path.lower(): i for i in range(len(md.schema))}
        present = {c.name.lower() for c in f.schema_arrow}
        known[None] = known.get(None, 0) + md.num_rows
        for c in partitions:
            known[c] = known.get(c, 0) + (md.num_rows if values.get(c.lower()) is not None else 0)
        for g in range(md.num_row_groups):
            group = md.row_group(g)
            for c in columns:
                if c.lower() not in present:
                    continue                         # the file is older than the column: all NULL
                i = flat.get(c.lower())              # a nested column's leaves do not tell its own NULLs
                stats = group.column(i).statistics if i is not None else None
                if stats is not None and stats.has_null_count:
                    known[c] = known.get(c, 0) + group.num_rows - stats.null_count
                else:
                    yield c, 0, path, g


def _read_counts(rows: list[tuple], base: str = "") -> dict[str, int]:
    """Non-null values of ``(column, path, row group)``, batch by batch."""
    out: dict[str, int] = {}
    by_file: dict[str, list] = {}
    for name, path, group in rows:
        by_file.setdefault(path, []).append((name, group))
    for path, items in by_file.items():
        with open_file(path, base) as f:
            real = {c.name.lower(): c.name for c in f.schema_arrow}
            for name, group in items:
                for batch in f.iter_batches(ROWS, row_groups=[group], columns=[real[name.lower()]]):
                    out[name] = out.get(name, 0) + len(batch) - batch.column(0).null_count
    return out


def footer_counts(files: DataFrame, columns: list[str], partitions: list[str], base: str = "") -> DataFrame:
    """``(name, n, path, row_group)`` of the files in ``files`` (a frame
    with their ``path``, below ``base`` if given): non-null values per column (rows, for a NULL
    name) as far as footers tell, one row per task and column; and, with
    a path, each column of a row group that has to be read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            for path in batch.column(0).to_pylist():
                left = list(_file_counts(path, base, columns, partitions, known))
                if left:
                    yield _counts(left)
        if known:
            yield _counts([(c, n, None, None) for c, n in known.items()])

    return files.select("path").mapInArrow(run, COUNTS)


def count_left(counts: DataFrame, base: str = "") -> DataFrame:
    """:func:`footer_counts` with what had to be read counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*[batch.column(i).to_pylist() for i in range(4)]))
            done = [r for r in rows if r[2] is None]
            todo = [(r[0], r[2], r[3]) for r in rows if r[2] is not None]
            done += [(c, n, None, None) for c, n in _read_counts(todo, base).items()]
            if done:
                yield _counts(done)

    return counts.mapInArrow(run, COUNTS)


def footer_null_profile(spark: SparkSession, root: str, columns: T.StructType, partitions: list[str] = (),
                        prefix: str = "") -> DataFrame:
    """``null_profile`` of the Parquet files below ``root/prefix`` from
    their footers: ``total_rows`` and ``<col>__nonnull`` per column, then
    per partition column (from the folder names).

    Only columns of row groups without a null count, and nested columns,
    are read; these are dealt over the tasks by row group.  Files that
    have not got a column count as NULL there.  A root that only Spark's
    readers can open is scanned."""
    names = [f.name for f in columns.fields if f.name.lower() not in {p.lower() for p in partitions}]
    partitions = list(partitions)
    try:
        open_tree(root)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError) as e:
        log.warning("%s is scanned: %s", root, e)
        return null_profile(bronze_scan(spark, f"{root.rstrip('/')}/{prefix}", partitions, columns), names + partitions)
    base = _absolute(root)
    files = list_files(spark, base, prefix).where(~F.col("key").rlike(HIDDEN)).select(F.col("key").alias("path"))
    width = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    found = footer_counts(files.repartition(width), names, partitions, base)
    # row groups to be read are spread; what is known already goes along by column
    counts = count_left(found.repartition(width, F.coalesce("path", "name"), "row_group", "name"), base)

    def total(name: str | None):
        mine = F.col("name").isNull() if name is None else F.col("name") == name
        return F.coalesce(F.sum(F.when(mine, F.col("n"))), F.lit(0))

    return counts.agg(total(None).alias("total_rows"), *[total(c).alias(f"{c}__nonnull") for c in names + partitions])
