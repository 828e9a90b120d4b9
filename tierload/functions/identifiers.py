"""Identifier and path-prefix helpers, as Column expressions.

Each helper also has a plain-Python twin for driver-side metadata
(table names, configured prefixes); both follow the same rule.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Catalog identifiers are lower case, and any character
# outside a-z, 0-9 and underscore becomes an underscore.
IDENTIFIER_INVALID = "[^a-z0-9_]"
IDENTIFIER_REPLACEMENT = "_"


def sanitize_identifier(c: Column | str) -> Column:
    """``lower(c)`` with every character outside ``[a-z0-9_]`` -> ``_``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(F.lower(c), IDENTIFIER_INVALID, IDENTIFIER_REPLACEMENT)


def sanitize_name(name: str) -> str:
    return re.sub(IDENTIFIER_INVALID, IDENTIFIER_REPLACEMENT, name.lower())


def normalize_prefix(c: Column | str) -> Column:
    """Trim leading/trailing ``/``; non-empty results end in one ``/``."""
    c = F.col(c) if isinstance(c, str) else c
    clean = F.regexp_replace(F.coalesce(c, F.lit("")), r"^/+|/+$", "")
    return F.when(clean == "", F.lit("")).otherwise(F.concat(clean, F.lit("/")))


def normalize_prefix_str(prefix: str | None) -> str:
    clean = re.sub(r"^/+|/+$", "", prefix or "")
    return f"{clean}/" if clean else ""


def strip_prefix(key: Column, prefix: Column) -> Column:
    """Key relative to a (normalised) prefix: drop its first len(prefix) chars."""
    return key.substr(F.length(prefix) + 1, F.length(key))
