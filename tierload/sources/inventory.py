"""File inventory: which listed files are new or changed since the
last crawl, and the upserted inventory table.

The inventory key is ``(dataset, key)``; a file counts as changed when
its length or modification time differs (object stores give no cheap
content hash through the file source).

Each crawl also keeps one digest per folder.  Only folders whose digest
is another one are compared file by file, so a crawl over an unchanged
tree joins folders, not files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.literals import ts_lit
from ..operators.merge import upsert_overwrite

INVENTORY_KEY = ["dataset", "key"]
CHANGE_KEY = ["dataset", "key", "length", "modification_time"]


FOLDER_KEY = ["dataset", "folder"]
DIGEST = ["n_files", "n_bytes", "digest_a", "digest_b"]


def folder_of(key_col: str = "key"):
    """The folder of a key, with its final slash."""
    key = F.col(key_col)
    return F.substring(key, F.lit(1), F.length(key) - F.length(F.substring_index(key, "/", -1)))


def folder_digests(listing: DataFrame) -> DataFrame:
    """``(dataset, folder, n_files, n_bytes, digest_a, digest_b)``: count,
    bytes and 128 bits over the names, lengths and times of a folder's
    files (in any order; combined per task before the shuffle)."""
    facts = [F.col(c) for c in ("key", "length", "modification_time")]
    return listing.groupBy("dataset", folder_of().alias("folder")).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes"),
        F.bit_xor(F.xxhash64(F.lit(1), *facts)).alias("digest_a"), F.bit_xor(F.xxhash64(F.lit(2), *facts)).alias("digest_b"))


def changed_folders(digests: DataFrame, known: DataFrame) -> DataFrame:
    """Folders that are new or whose digest differs."""
    columns = [*FOLDER_KEY, *DIGEST]
    return digests.join(known.select(*columns), columns, "left_anti").select(*FOLDER_KEY)


def changed_files(listing: DataFrame, inventory: DataFrame) -> DataFrame:
    """Listed files that are not in the inventory with the same length
    and modification time."""
    return listing.join(inventory.select(*CHANGE_KEY), CHANGE_KEY, "left_anti")


def inventory_upsert(inventory: DataFrame, entries: DataFrame, run_ts=None,
                     partitions: int | None = None) -> DataFrame:
    """Insert-or-replace ``entries`` by ``(dataset, key)``, stamping
    ``processed_at``."""
    return upsert_overwrite(inventory, stamped(entries, run_ts), INVENTORY_KEY, partitions)


def stamped(entries: DataFrame, run_ts=None) -> DataFrame:
    """``entries`` with the time they were processed."""
    return entries.withColumn("processed_at", ts_lit(run_ts) if run_ts is not None else F.localtimestamp())
