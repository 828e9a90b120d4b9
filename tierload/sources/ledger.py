"""Partition ledger: which partition of which dataset is registered, and where it lies.

A table ``(dataset, values_key, values, location)``, one row per
registered partition, kept next to the tables it describes.  What is new
is an anti-join of two tables; a table whose definition is made anew gets
its partitions, with their locations, from here.  Neither passes the
catalog's own partition list through the driver.

A crawl that registers something appends one segment, after the catalog
has the partitions: a crash before it only makes the next crawl register
them again, which changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.tables import COMMIT_ATTEMPTS, ConcurrentCommit, SnapshotTable
from .paths import VALUE_SEP

LEDGER_KEY = ["dataset", "values_key"]
LEDGER_SCHEMA = "dataset string, values_key string, values array<string>, location string"


def keyed(partitions: DataFrame) -> DataFrame:
    """Discovered partitions as ledger rows ("/" is in no value, so the joined values are an exact key)."""
    return partitions.select("dataset", F.array_join("values", VALUE_SEP).alias("values_key"), "values", "location")


class PartitionLedger:
    """The ledger table ``name`` (created with the first row)."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.table = SnapshotTable(spark, name)

    def read(self, version: str | None = None) -> DataFrame:
        v = version or self.table.current_version()
        return self.table.read(version=v) if v else self.spark.createDataFrame([], LEDGER_SCHEMA)

    def missing(self, discovered: DataFrame, version: str | None = None) -> DataFrame:
        """Ledger rows of the discovered partitions that are not in the ledger."""
        return keyed(discovered).join(self.read(version).select(*LEDGER_KEY), LEDGER_KEY, "left_anti")

    def of(self, datasets: list[str]) -> DataFrame:
        """The rows of some datasets."""
        names = self.spark.createDataFrame([(d,) for d in datasets], "dataset string")
        return self.read().join(names, "dataset", "left_semi").select("dataset", "values_key", "values", "location")

    def add(self, rows: DataFrame) -> None:
        """Append rows whose keys are not in the ledger; a row that another crawl added first is left out."""
        for attempt in range(1, COMMIT_ATTEMPTS + 1):
            base = self.table.current_version()
            new = rows.join(self.read(base).select(*LEDGER_KEY), LEDGER_KEY, "left_anti") if base else rows
            try:
                self.table.append(new.select("dataset", "values_key", "values", "location"), base=base or "")
                return
            except ConcurrentCommit:
                if attempt == COMMIT_ATTEMPTS:
                    raise
