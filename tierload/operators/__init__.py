"""Lazy ``DataFrame -> DataFrame`` operators."""

from .columns import (ColumnMap, as_column_maps, exclude_columns, lineage_columns,
                      map_columns, plan_exclusion)
from .incremental import (batch_state, incremental_condition, incremental_filter,
                          read_state, watermark_filter, watermark_max)
from .latest import latest_order, latest_per_key
from .merge import (merge_latest, merge_outcome, reconcile_missing_keys, upsert,
                    upsert_do_nothing, upsert_overwrite)
from .quality import (assert_unique_keys, date_anomaly_condition, date_anomaly_filter,
                      date_columns, date_columns_frame, key_violations, null_counts,
                      null_profile, prune_null_columns)
from .reconcile import differing_buckets, key_digests, reconcile_by_digest
from .schema_ops import (SchemaDiff, SchemaGuardError, add_missing_columns, align_to_schema,
                         evolve_schema, find_missing_columns, guard, schema_diff,
                         schema_diff_frame, schema_pairs)

__all__ = [n for n in dir() if not n.startswith("_")]
