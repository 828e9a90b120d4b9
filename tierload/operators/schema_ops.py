"""Schema evolution and schema diff (metadata work on ``StructType``s).

Schemas are tiny driver-side metadata; the diff is also offered as a
DataFrame so it can be inspected and compared like any other result.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.types import catalog_type, is_compatible_type

log = logging.getLogger(__name__)


def find_missing_columns(source: T.StructType, target: T.StructType) -> list[T.StructField]:
    """Fields of ``source`` whose name (case ignored, as in the catalog) is not in ``target``."""
    existing = {n.lower() for n in target.fieldNames()}
    return [f for f in source.fields if f.name.lower() not in existing]


def align_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Read ``df`` as ``schema``: missing columns are typed NULLs, extra
    columns are kept after the schema's columns."""
    present = set(df.columns)
    cols = [F.col(f"`{f.name}`") if f.name in present else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields]
    extra = [F.col(f"`{c}`") for c in df.columns if c not in set(schema.fieldNames())]
    return df.select(*cols, *extra)


def evolve_schema(existing: T.StructType, incoming: T.StructType) -> T.StructType:
    """Additive evolution: existing columns in place, new ones appended;
    nothing is ever dropped."""
    return T.StructType(list(existing.fields) + find_missing_columns(incoming, existing))


def add_missing_columns(df: DataFrame, incoming: T.StructType) -> DataFrame:
    """``df`` with every column of ``incoming`` it lacks, as NULL."""
    return align_to_schema(df, evolve_schema(df.schema, incoming))


# ------------------------------------------------------------------ diff

@dataclass
class SchemaDiff:
    to_add: list = field(default_factory=list)          # [(name, type)]
    extra_in_existing: list = field(default_factory=list)  # [name]
    type_mismatches: list = field(default_factory=list)  # [(name, existing, configured)]
    pk_mismatch: bool = False

    def rows(self, existing_pk=(), configured_pk=()):
        out = [("add", n, None, t) for n, t in self.to_add]
        out += [("extra", n, None, None) for n in self.extra_in_existing]
        out += [("type_mismatch", n, e, c) for n, e, c in self.type_mismatches]
        if self.pk_mismatch:
            out.append(("pk_mismatch", None, ",".join(existing_pk), ",".join(configured_pk)))
        return out


def schema_diff(configured: list[tuple[str, str]], configured_pk: list[str],
                existing: list[tuple[str, str]], existing_pk: list[str]) -> SchemaDiff:
    """Compare a declared table (``[(column, type)]`` + key) with an
    existing one.  Types are compared with the loose rule
    (:func:`is_compatible_type`); the key is compared as a set."""
    ex = dict(existing)
    conf_names = {n for n, _ in configured}
    return SchemaDiff(
        to_add=[(n, t) for n, t in configured if n not in ex],
        extra_in_existing=[n for n, _ in existing if n not in conf_names],
        type_mismatches=[(n, ex[n], t) for n, t in configured
                         if n in ex and not is_compatible_type(ex[n], t)],
        pk_mismatch=set(configured_pk) != set(existing_pk),
    )


def schema_pairs(schema: T.StructType) -> list[tuple[str, str]]:
    """``[(column, catalog type)]`` of a Spark schema."""
    return [(f.name, catalog_type(f.dataType)) for f in schema.fields]


def schema_diff_frame(spark: SparkSession, diff: SchemaDiff, existing_pk=(),
                      configured_pk=()) -> DataFrame:
    return spark.createDataFrame(
        diff.rows(existing_pk, configured_pk),
        "kind string, column_name string, existing_type string, configured_type string")


class SchemaGuardError(RuntimeError):
    pass


def guard(diff: SchemaDiff, table: str, configured_pk=(), existing_pk=()) -> list:
    """Refuse key or type changes; warn about extra columns; return the
    columns to add."""
    if diff.pk_mismatch:
        raise SchemaGuardError(
            f"{table}: configured primary key {list(configured_pk)} differs from the "
            f"existing key {list(existing_pk)}; resolve manually")
    if diff.type_mismatches:
        detail = "; ".join(f"{n} (existing {e}, configured {c})" for n, e, c in diff.type_mismatches)
        raise SchemaGuardError(f"{table}: type mismatch on {detail}; resolve manually")
    if diff.extra_in_existing:
        log.warning("%s: columns not in the mapping are left untouched: %s",
                    table, ", ".join(diff.extra_in_existing))
    return diff.to_add
