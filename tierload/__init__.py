"""tierload: incremental table loading on Spark.

discover (``sources``) -> clean / dedupe / merge (``operators``) ->
load and upsert (``plans``), all as lazy DataFrame plans.

The main entry points are re-exported here; import submodules for the
individual operators.
"""

__version__ = "0.1.0"

_EXPORTS = {
    "build_session": "tierload.session",
    "SilverDataset": "tierload.config", "DateValidation": "tierload.config",
    "GoldTable": "tierload.config", "GoldSettings": "tierload.config",
    "ColumnMap": "tierload.config",
    "crawl": "tierload.plans.crawl",
    "load_silver": "tierload.plans.silver",
    "load_gold": "tierload.plans.gold",
    "SnapshotTable": "tierload.plans.tables",
    "stream_silver": "tierload.streaming.bronze_stream",
    "JdbcTarget": "tierload.sources.jdbc",
}

__all__ = sorted(_EXPORTS)


def __getattr__(name):
    # lazy, so importing the package does not import pyspark submodules eagerly
    if name in _EXPORTS:
        import importlib
        return getattr(importlib.import_module(_EXPORTS[name]), name)
    raise AttributeError(name)
