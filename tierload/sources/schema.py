"""Schema discovery: one sample file per dataset, catalog type names.

Reading a schema is a footer read in a task, not a scan.  The per-dataset
results are small metadata rows gathered into one DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.identifiers import sanitize_name
from ..functions.types import catalog_type
from .footers import file_schemas

SCHEMA_ROWS = "dataset string, table_name string, ordinal int, column_name string, column_type string"


def schema_rows(dataset: str, schema: T.StructType) -> list[tuple]:
    return [(dataset, sanitize_name(dataset), i + 1, f.name, catalog_type(f.dataType))
            for i, f in enumerate(schema.fields)]


def infer_schema(spark: SparkSession, samples: dict[str, str]) -> DataFrame:
    """``dataset -> sample file`` into rows ``(dataset, table_name,
    ordinal, column_name, column_type)``; the footers are read by one job."""
    rows = []
    for dataset, schema in file_schemas(spark, samples).items():
        rows += schema_rows(dataset, schema)
    return spark.createDataFrame(rows, SCHEMA_ROWS)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def table_columns(spark: SparkSession, name: str) -> DataFrame:
    """``(column_name, data_type, is_partition)`` of a catalog table,
    business columns only (partition columns removed)."""
    cols = [c for c in spark.catalog.listColumns(name) if not c.isPartition]
    schema = spark.table(name).schema
    rows = [(c.name, catalog_type(schema[c.name].dataType)) for c in cols]
    return spark.createDataFrame(rows, "column_name string, data_type string")
