"""Object keys -> datasets, Hive partitions and table layouts.

Folder first: what a key says about its dataset and partition is said by
its folder alone, so a listing is reduced to one row per folder (a partial
aggregate, by folder) before anything is parsed.  Layouts, counts, sample
files and partitions come from these rows; a dataset holding a third of
all files is spread over its folders.  Parsing uses codegen'd string
functions (no UDF, no lambdas).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.identifiers import normalize_prefix_str, sanitize_identifier

# The data-file suffix (case-insensitive) and the
# separators used when arrays are flattened for reporting.
PARQUET_SUFFIX = ".parquet"
NAME_SEP = ","
VALUE_SEP = "/"
#: file names packed into one row by the layout check
FILES_PER_ROW = 10_000


# One ``name=value`` directory -- name is everything up to
# the first ``=`` (non-empty), value the rest of the segment.
PARTITION_SEGMENT = r"(?:^|/)([^/=]+)=([^/]*)"


def _relative(key_col: str, p: str) -> tuple[Column, Column, Column]:
    """(folder below the prefix with its ``/``, file name, is it a
    Parquet file inside a dataset directory) of a key."""
    key = F.col(key_col)
    rel = key.substr(F.lit(len(p) + 1), F.length(key))
    name = F.substring_index(rel, "/", -1)
    folder = rel.substr(F.lit(1), F.length(rel) - F.length(name))
    return folder, name, (F.instr(rel, "/") > 0) & F.lower(rel).endswith(PARQUET_SUFFIX)


def _parse_folder(df: DataFrame, folder: Column, p: str) -> DataFrame:
    """Add what a folder says: ``dataset``, ``raw_names``, ``names``
    (sanitised), ``values``, their joined keys and ``location``.

    Dataset = first segment after the prefix; each later directory whose
    text has ``=`` after a non-empty name is a partition ``name=value``
    (the value keeps any further ``=``, may be empty); other directories
    are skipped but stay part of the location.
    """
    dataset = F.substring_index(folder, "/", 1)
    dirs = F.regexp_extract(folder, r"^[^/]*/(.*)/$", 1)
    location = F.concat(F.lit(p), F.when(F.instr(folder, "/") == F.length(folder), F.concat(folder, F.lit("/")))
                        .otherwise(folder))
    raw_names = F.regexp_extract_all(dirs, F.lit(PARTITION_SEGMENT), 1)
    values = F.regexp_extract_all(dirs, F.lit(PARTITION_SEGMENT), 2)
    # "/" never occurs inside a segment, so the joined forms are exact keys
    names_key = F.regexp_replace(F.lower(F.array_join(raw_names, VALUE_SEP)), "[^a-z0-9_/]", "_")
    names = F.when(names_key == "", F.array().cast("array<string>")) \
             .otherwise(F.split(names_key, VALUE_SEP, -1))
    return (df.withColumn("dataset", dataset)
              .withColumn("raw_names", raw_names)
              .withColumn("names_key", names_key)
              .withColumn("names", names)
              .withColumn("values", values)
              .withColumn("values_key", F.array_join(values, VALUE_SEP))
              .withColumn("location", location))


def parse_keys(df: DataFrame, key_col: str = "key", prefix: str = "") -> DataFrame:
    """Every key that is a Parquet file inside a dataset directory, with
    what its folder says; other keys are dropped."""
    p = normalize_prefix_str(prefix)
    folder, _, keep = _relative(key_col, p)
    return _parse_folder(df.where(keep), folder, p)


def parse_folders(df: DataFrame, key_col: str = "key", prefix: str = "") -> DataFrame:
    """One row per folder with Parquet files: ``n`` files, ``first_key``
    and what the folder says.  The aggregate by folder comes first, so a
    folder is parsed once, not once per file."""
    p = normalize_prefix_str(prefix)
    folder, _, keep = _relative(key_col, p)
    rows = (df.where(keep).groupBy(folder.alias("folder"))
              .agg(F.count(F.lit(1)).alias("n"), F.min(key_col).alias("first_key")))
    return _parse_folder(rows, F.col("folder"), p)


def dataset_layouts(folders: DataFrame) -> DataFrame:
    """``(dataset, layout_key)``: the ``/``-joined sanitised partition
    names of the first listed key (``min(key)``) that has partitions."""
    first = F.min(F.when(F.col("names_key") != "", F.struct("first_key", "names_key")))
    return folders.groupBy("dataset").agg(first["names_key"].alias("layout_key"))


def dataset_summary(folders: DataFrame) -> DataFrame:
    """One row per dataset: table name, file count, layout, distinct
    conforming partitions, sample file (first compatible key) and the
    number of keys whose layout differs.

    One pass: folders are aggregated per ``(dataset, layout variant)``;
    the window that finds a dataset's layout sees one row per variant."""
    g = (folders.groupBy("dataset", F.col("names_key").alias("nk"))
                .agg(F.sum("n").alias("n"), F.min("first_key").alias("first_key"),
                     F.count_distinct("values_key").alias("n_parts")))
    first = F.min(F.when(F.col("nk") != "", F.struct("first_key", "nk"))).over(Window.partitionBy("dataset"))
    j = g.withColumn("layout_key", first["nk"])
    conf = (F.col("nk") == "") | (F.col("nk") == F.col("layout_key"))
    return (j.groupBy("dataset")
             .agg(F.sum("n").alias("n_files"),
                  F.regexp_replace(F.first("layout_key", ignorenulls=True), VALUE_SEP, NAME_SEP)
                   .alias("layout"),
                  F.coalesce(F.sum(F.when((F.col("nk") != "") & conf, F.col("n_parts"))),
                             F.lit(0)).cast("long").alias("n_partitions"),
                  F.min(F.when(conf, F.col("first_key"))).alias("sample_file"),
                  F.coalesce(F.sum(F.when(~conf, F.col("n"))), F.lit(0)).cast("long")
                   .alias("n_incompatible"))
             .withColumn("table_name", sanitize_identifier("dataset")))


def partition_layout_check(listing: DataFrame, key_col: str = "key", prefix: str = "") -> DataFrame:
    """Keys with partitions whose names differ from their dataset's layout
    (these are skipped when partitions are registered).

    The listing is read once (it may be a walk of the store): names are
    packed by folder, at most ``FILES_PER_ROW`` of one input split a row,
    layouts come from these rows, and only rows that differ are unpacked."""
    p = normalize_prefix_str(prefix)
    folder, name, keep = _relative(key_col, p)
    part = F.floor(F.monotonically_increasing_id() / FILES_PER_ROW)
    packed = (listing.where(keep).select(folder.alias("folder"), name.alias("name"), part.alias("part"))
                     .groupBy("folder", "part").agg(F.collect_list("name").alias("files")))
    rows = _parse_folder(packed, F.col("folder"), p).where(F.col("names_key") != "")
    first = F.concat(F.lit(p), F.col("folder"), F.array_min("files"))
    j = rows.join(dataset_layouts(rows.withColumn("first_key", first)), "dataset")
    return (j.where(F.col("names_key") != F.col("layout_key"))
             .select("dataset", F.explode("files").alias("name"), "folder", "names", "layout_key")
             .select("dataset", F.concat(F.lit(p), "folder", "name").alias(key_col),
                     F.array_join("names", NAME_SEP).alias("names"),
                     F.replace("layout_key", F.lit(VALUE_SEP), F.lit(NAME_SEP)).alias("layout")))


def distinct_partitions(folders: DataFrame) -> DataFrame:
    """``(dataset, values, location, names)`` per distinct conforming
    partition; the location is the one of the first key listed with
    those values.  Folders are aggregated per partition before the layout
    join; both of its sides read the same folder rows."""
    parts = (folders.where(F.col("names_key") != "")
                    .groupBy("dataset", "names_key", "values_key")
                    .agg(F.min(F.struct("first_key", "location", "values")).alias("m"))
                    .select("dataset", "names_key", "m.first_key", "m.location", "m.values"))
    j = parts.join(dataset_layouts(parts), "dataset")
    return (j.where(F.col("names_key") == F.col("layout_key"))
             .select("dataset", "values", "location",
                     F.split("names_key", VALUE_SEP, -1).alias("names")))


def new_partitions(discovered: DataFrame, registered: DataFrame) -> DataFrame:
    """Discovered partitions not registered yet (key: dataset + values)."""
    return discovered.join(registered.select("dataset", "values"), ["dataset", "values"], "left_anti")


def flatten(parts: DataFrame) -> DataFrame:
    """Arrays as text for reporting/comparison."""
    out = parts
    for c, sep in (("values", VALUE_SEP), ("names", NAME_SEP), ("raw_names", VALUE_SEP)):
        if c in parts.columns:
            out = out.withColumn(c, F.array_join(c, sep))
    return out
