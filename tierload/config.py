"""Configuration objects for the Silver and Gold loads, with the
constructor checks the loaders rely on."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from .operators.columns import ColumnMap, as_column_maps
from .operators.quality import DEFAULT_MAX_YEARS_FROM_TODAY, DEFAULT_MIN_TIMESTAMP

log = logging.getLogger(__name__)

MODES = ("dedupe_latest", "append_only")

# The relational sink's bound-parameter limit per
# statement, used to cap rows per batch for wide tables.
SQL_PARAMETER_LIMIT = 65535


class ConfigError(ValueError):
    pass


@dataclass(frozen=True)
class DateValidation:
    min_timestamp: str = DEFAULT_MIN_TIMESTAMP
    max_years_from_today: int = DEFAULT_MAX_YEARS_FROM_TODAY


@dataclass(frozen=True)
class SilverDataset:
    name: str
    pk: tuple
    cursor: str
    mode: str = "dedupe_latest"
    exclude_columns: tuple = ()
    requires_confirmation: bool = False
    note: str = ""
    tie_breakers: tuple = ()

    def __post_init__(self):
        object.__setattr__(self, "pk", tuple(self.pk))
        object.__setattr__(self, "exclude_columns", tuple(self.exclude_columns))
        object.__setattr__(self, "tie_breakers", tuple(self.tie_breakers))
        if not self.name:
            raise ConfigError("dataset needs a name")
        if not self.pk:
            raise ConfigError(f"{self.name}: primary key is mandatory")
        if self.mode not in MODES:
            raise ConfigError(f"{self.name}: mode must be one of {MODES}")
        if self.mode == "dedupe_latest" and not self.cursor:
            raise ConfigError(f"{self.name}: dedupe_latest needs a cursor column")


@dataclass(frozen=True)
class GoldTable:
    source_table: str
    target_table: str
    primary_keys: tuple
    columns: tuple
    watermark_column: str | None = None
    watermark_enabled: bool = False

    def __post_init__(self):
        object.__setattr__(self, "primary_keys", tuple(self.primary_keys or ()))
        object.__setattr__(self, "columns", tuple(as_column_maps(self.columns or ())))

    @property
    def watermark_target(self) -> str | None:
        for c in self.columns:
            if c.source == self.watermark_column:
                return c.target
        return None


@dataclass(frozen=True)
class GoldSettings:
    # Default rows per statement for relational targets.
    batch_size: int = 2500
    schema: str = "public"
    watermark_overlap_seconds: float | None = None


def _dups(values) -> list:
    seen, dups = set(), []
    for v in values:
        if v in seen and v not in dups:
            dups.append(v)
        seen.add(v)
    return dups


def validate_gold_table(t: GoldTable) -> list[str]:
    """Raise on a broken mapping; return warnings."""
    name = t.source_table or "?"
    if not t.source_table:
        raise ConfigError("a table entry is missing source_table")
    if not t.target_table:
        raise ConfigError(f"{name}: target_table missing")
    if not t.primary_keys:
        raise ConfigError(f"{name}: primary key is mandatory")
    if not t.columns:
        raise ConfigError(f"{name}: no columns configured")
    for c in t.columns:
        if not (c.source and c.target and c.type):
            raise ConfigError(f"{name}: every column needs source, target and type ({c})")
    sources = [c.source for c in t.columns]
    targets = [c.target for c in t.columns]
    for label, values in (("source", sources), ("target", targets), ("primary key", t.primary_keys)):
        d = _dups(values)
        if d:
            raise ConfigError(f"{name}: duplicate {label} column(s): {', '.join(d)}")
    for k in t.primary_keys:
        if k not in targets:
            raise ConfigError(f"{name}: primary key {k!r} is not a target column")
    warnings = []
    if t.watermark_enabled:
        if not t.watermark_column:
            raise ConfigError(f"{name}: watermark column missing")
        if t.watermark_column not in sources:
            raise ConfigError(f"{name}: watermark column {t.watermark_column!r} is not mapped")
        if t.watermark_target in t.primary_keys:
            msg = (f"{name}: watermark column {t.watermark_column!r} -> {t.watermark_target!r} "
                   f"is part of the primary key; a changed value inserts a new row instead "
                   f"of updating the old one")
            log.warning(msg)
            warnings.append(msg)
    return warnings


def validate_gold_config(settings: GoldSettings | None, tables) -> list[str]:
    if settings is None:
        raise ConfigError("settings section missing")
    if not isinstance(settings.batch_size, int) or isinstance(settings.batch_size, bool) \
            or settings.batch_size <= 0:
        raise ConfigError("settings.batch_size must be a positive integer")
    if not tables:
        raise ConfigError("tables must be a non-empty list")
    warnings, seen = [], set()
    for t in tables:
        warnings += validate_gold_table(t)
        if t.target_table in seen:
            raise ConfigError(f"target table {t.target_table!r} is used by more than one source")
        seen.add(t.target_table)
    return warnings


def safe_batch_size(requested: int, n_columns: int) -> int:
    """Rows per statement: the requested size, capped so that
    ``rows * columns`` stays within the parameter limit."""
    if n_columns <= 0:
        raise ConfigError("column count must be > 0")
    cap = SQL_PARAMETER_LIMIT // n_columns
    if cap < 1:
        raise ConfigError(f"one row needs {n_columns} parameters, above the limit "
                          f"{SQL_PARAMETER_LIMIT}")
    return min(requested, cap)


__all__ = ["ColumnMap", "ConfigError", "DateValidation", "GoldSettings", "GoldTable",
           "SilverDataset", "gold_config_from_json", "safe_batch_size",
           "silver_config_from_json", "validate_gold_config", "validate_gold_table"]


# ------------------------------------------------------------ JSON config
# Key names of the loaders' JSON configuration files.

def silver_config_from_json(doc: dict) -> tuple[DateValidation, list[SilverDataset]]:
    """``{"dateValidation": {...}, "datasets": [...]}`` as objects."""
    dv = doc.get("dateValidation") or {}
    validation = DateValidation(dv.get("minTimestamp", DEFAULT_MIN_TIMESTAMP),
                                int(dv.get("maxYearsFromToday", DEFAULT_MAX_YEARS_FROM_TODAY)))
    datasets = [SilverDataset(name=d["name"], pk=d.get("pk") or [], cursor=d.get("cursor"),
                              mode=d.get("mode", "dedupe_latest"),
                              exclude_columns=d.get("excludeColumns") or [],
                              requires_confirmation=bool(d.get("requiresConfirmation", False)),
                              note=d.get("note", ""), tie_breakers=d.get("tieBreakers") or [])
                for d in doc.get("datasets") or []]
    return validation, datasets


def gold_config_from_json(doc: dict) -> tuple[GoldSettings, list[GoldTable]]:
    """``{"settings": {...}, "tables": [...]}`` as objects (validated)."""
    st = doc.get("settings")
    settings = None if st is None else GoldSettings(
        batch_size=st.get("batchSize"), schema=st.get("postgresSchema", "public"),
        watermark_overlap_seconds=st.get("watermarkOverlapSeconds"))
    tables = []
    for t in doc.get("tables") or []:
        wm = t.get("watermark") or {}
        tables.append(GoldTable(
            source_table=t.get("sourceTable"), target_table=t.get("targetTable"),
            primary_keys=t.get("primaryKeys") or [],
            columns=[ColumnMap(c.get("source"), c.get("target"), c.get("postgresType"))
                     for c in t.get("columns") or []],
            watermark_column=wm.get("sourceColumn"), watermark_enabled=bool(wm.get("enabled"))))
    validate_gold_config(settings, tables)
    return settings, tables
