"""Type vocabularies: Spark types -> catalog type names, and the loose
type-compatibility rule used when a declared table is checked against
an existing one.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The catalog type vocabulary written by the crawler.
#   boolean; int (tinyint, smallint, integer); bigint; float; double;
#   date; timestamp (with or without time zone); decimal(p,s);
#   binary; string (everything else, nested types included).


def catalog_type(dt: T.DataType) -> str:
    """Catalog type name for a Spark data type."""
    if isinstance(dt, T.BooleanType):
        return "boolean"
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType)):
        return "int"
    if isinstance(dt, T.LongType):
        return "bigint"
    if isinstance(dt, T.FloatType):
        return "float"
    if isinstance(dt, T.DoubleType):
        return "double"
    if isinstance(dt, T.DateType):
        return "date"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return "timestamp"
    if isinstance(dt, T.DecimalType):
        return f"decimal({dt.precision},{dt.scale})"
    if isinstance(dt, T.BinaryType):
        return "binary"
    return "string"


def is_date_type(dt: T.DataType) -> bool:
    return isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType))


# ---------------------------------------------------------------- compat

def normalize_type_name(name: str) -> str:
    """Loose normal form of a declared/existing type name.

    Lower case; anything starting with ``timestamp`` is ``timestamp``;
    ``character varying...`` and ``varchar`` are ``text``.  Everything
    else must match exactly (unsure means incompatible).
    """
    t = name.lower()
    t = re.sub(r"^timestamp.*$", "timestamp", t)
    t = re.sub(r"^character varying.*$", "text", t)
    t = t.replace("varchar", "text", 1)
    return t.strip()


def normalize_type_col(c: Column) -> Column:
    t = F.lower(c)
    t = F.regexp_replace(t, r"^timestamp.*$", "timestamp")
    t = F.regexp_replace(t, r"^character varying.*$", "text")
    # only the first occurrence is replaced, as in the rule above
    t = F.regexp_replace(t, r"^(.*?)varchar", "$1text")
    return F.trim(t)


def is_compatible_type(existing: str, configured: str) -> bool:
    return normalize_type_name(existing) == normalize_type_name(configured)


def type_compatible(existing: Column, configured: Column) -> Column:
    return normalize_type_col(existing) == normalize_type_col(configured)


# SQL type names used when a Spark type is declared in a
# relational (JDBC) target.
_SQL_TYPE_NAMES = {
    "boolean": "BOOLEAN",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "float": "REAL",
    "double": "DOUBLE PRECISION",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "binary": "BYTEA",
    "string": "TEXT",
}


def parse_type(name: str) -> T.DataType:
    """A declared column type (Spark DDL or a common SQL spelling) as a
    Spark ``DataType``."""
    n = name.strip().lower()
    aliases = {
        "text": "string",
        "double precision": "double",
        "real": "float",
        "integer": "int",
        "timestamp without time zone": "timestamp_ntz",
        "timestamp with time zone": "timestamp",
        "bytea": "binary",
    }
    n = aliases.get(n, n)
    if n.startswith("character varying") or n.startswith("varchar") or n.startswith("char"):
        n = "string"
    return T.DataType.fromDDL(n)
