"""Column-level helpers (built-in Spark functions only)."""

from .identifiers import (normalize_prefix, normalize_prefix_str, sanitize_identifier,
                          sanitize_name, strip_prefix)
from .literals import minus_seconds, now_lit, plus_years, ts_lit
from .types import (catalog_type, is_compatible_type, is_date_type,
                    normalize_type_name, parse_type, type_compatible)

__all__ = [
    "normalize_prefix", "normalize_prefix_str", "sanitize_identifier", "sanitize_name",
    "strip_prefix", "minus_seconds", "now_lit", "plus_years", "ts_lit", "catalog_type",
    "is_compatible_type", "is_date_type", "normalize_type_name",
    "parse_type", "type_compatible",
]
