"""Row-level table merges as DataFrame algebra.

There is no MERGE on plain Parquet, so each merge computes the full
next version of the table; ``plans.tables`` writes it as a new version
bucketed by the key and swaps it in.

Every merge is one full-outer equi-join on the key: against a table
bucketed by that key, only the source side is shuffled.  Source keys are unique
(deduplicated first) and target keys are unique (they come from a
previous merge), so the join is 1:1 per key and key skew cannot blow
up a task; AQE coalesces/splits partitions at runtime.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.literals import ts_lit
from .latest import latest_per_key
from .quality import assert_unique_keys

_T = "__t_present"
_S = "__s_present"


def _q(c: str) -> str:
    return f"`{c}`"


def _align(source: DataFrame, pk: list[str], partitions: int | None) -> DataFrame:
    """Hash-partition the (small, deduplicated) source by the key into
    the target's bucket count, so the join keeps the bucketed target in
    place instead of re-shuffling it to the session's partition count."""
    return source if not partitions else source.repartition(partitions, *[F.col(k) for k in pk])


def merge_latest(target: DataFrame, source: DataFrame, pk: list[str], cursor: str,
                 run_ts=None, tie_breakers=(), source_is_latest: bool = False,
                 date_col: str = "ingestion_date", batch_col: str = "batch_id",
                 partitions: int | None = None) -> DataFrame:
    """Incremental MERGE of a Bronze slice into Silver.

    ``source`` is reduced to its latest row per key *before* the join
    (so older source versions can never be inserted as duplicates).
    Per key:

    * only in target: unchanged;
    * only in source: inserted (Silver-only columns NULL);
    * in both and ``source.cursor > target.cursor``: every non-key column
      and the lineage columns come from the source, Silver-only columns
      keep their value;
    * in both otherwise (older, equal or NULL cursor on either side):
      unchanged.  Re-running the same slice is therefore a no-op.

    NULL keys never match (``=`` semantics): such source rows are
    inserted.  Output columns follow the target's order, then any new
    source business column.  ``partitions``: the target's bucket count
    when it differs from ``spark.sql.shuffle.partitions``.
    """
    s = source if source_is_latest else latest_per_key(source, pk, cursor, tie_breakers)
    s = _align(s, pk, partitions)
    src_cols = [c for c in s.columns if c not in (date_col, batch_col)]
    tgt_cols = list(target.columns)
    out_cols = tgt_cols + [c for c in src_cols if c not in tgt_cols]

    t = target.select(*[F.col(_q(c)).alias(f"t__{c}") for c in tgt_cols], F.lit(True).alias(_T))
    s2 = s.select(*[F.col(_q(c)).alias(f"s__{c}") for c in src_cols],
                  F.col(date_col).alias("s___source_ingestion_date"),
                  F.col(batch_col).alias("s___source_batch_id"),
                  F.lit(True).alias(_S))
    cond = reduce(lambda a, b: a & b, [F.col(f"t__{k}") == F.col(f"s__{k}") for k in pk])
    j = t.join(s2, cond, "full_outer")

    t_in = F.col(_T).isNotNull()
    s_in = F.col(_S).isNotNull()
    take = s_in & (~t_in | (F.col(f"s__{cursor}") > F.col(f"t__{cursor}"))).eqNullSafe(True)
    loaded = ts_lit(run_ts) if run_ts is not None else F.localtimestamp()

    def pick(c: str):
        t_val = F.col(f"t__{c}") if c in tgt_cols else F.lit(None)
        if c in pk:
            return F.when(t_in, t_val).otherwise(F.col(f"s__{c}")).alias(c)
        if c == "_silver_loaded_at":
            new = loaded
        elif c in ("_source_ingestion_date", "_source_batch_id") or c in src_cols:
            new = F.col(f"s__{c}")
        else:
            return t_val.alias(c)                 # Silver-only column: kept
        return F.when(take, new).otherwise(t_val).alias(c)

    return j.select(*[pick(c) for c in out_cols])


def merge_outcome(target: DataFrame, source_latest: DataFrame, pk: list[str],
                  cursor: str) -> DataFrame:
    """Per key: ``untouched``, ``updated``, ``kept`` or ``inserted`` -- the
    four MERGE outcomes, for reporting."""
    t = target.select(*pk, F.col(cursor).alias("__tc"), F.lit(True).alias(_T))
    s = source_latest.select(*pk, F.col(cursor).alias("__sc"), F.lit(True).alias(_S))
    cond = reduce(lambda a, b: a & b, [t[k] == s[k] for k in pk])
    j = t.join(s, cond, "full_outer")
    outcome = (F.when(F.col(_S).isNull(), "untouched")
               .when(F.col(_T).isNull(), "inserted")
               .when((F.col("__sc") > F.col("__tc")).eqNullSafe(True), "updated")
               .otherwise("kept"))
    return j.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n_keys"))


def upsert(target: DataFrame, source: DataFrame, pk: list[str],
           duplicates: str = "error", cursor: str | None = None,
           tie_breakers=(), partitions: int | None = None) -> DataFrame:
    """INSERT ... ON CONFLICT: overwrite every non-key column, or do
    nothing when every column is part of the key.

    ``duplicates='error'`` raises when the source has NULL or repeated
    keys (one aggregate); ``'latest'`` keeps the latest row per key by
    ``cursor``; ``'trust'`` skips the check (caller guarantees it)."""
    if duplicates == "error":
        assert_unique_keys(source, pk)
    elif duplicates == "latest":
        if cursor is None:
            raise ValueError("duplicates='latest' needs a cursor column")
        source = latest_per_key(source, pk, cursor, tie_breakers)
    elif duplicates != "trust":
        raise ValueError(f"unknown duplicates policy {duplicates!r}")
    if all(c in pk for c in source.columns):
        return upsert_do_nothing(target, source, pk, partitions)
    return upsert_overwrite(target, source, pk, partitions)


def upsert_overwrite(target: DataFrame, source: DataFrame, pk: list[str],
                     partitions: int | None = None) -> DataFrame:
    """Insert new keys; replace every mapped non-key column of existing
    keys unconditionally.  Target-only columns keep their values on
    update and are NULL on insert.  One full-outer join on the key."""
    source = _align(source, pk, partitions)
    tgt_cols = list(target.columns)
    src_cols = list(source.columns)
    out_cols = tgt_cols + [c for c in src_cols if c not in tgt_cols]
    t = target.select(*[F.col(_q(c)).alias(f"t__{c}") for c in tgt_cols], F.lit(True).alias(_T))
    s = source.select(*[F.col(_q(c)).alias(f"s__{c}") for c in src_cols], F.lit(True).alias(_S))
    cond = reduce(lambda a, b: a & b, [F.col(f"t__{k}") == F.col(f"s__{k}") for k in pk])
    j = t.join(s, cond, "full_outer")
    s_in = F.col(_S).isNotNull()

    def pick(c: str):
        t_val = F.col(f"t__{c}") if c in tgt_cols else F.lit(None)
        if c not in src_cols:
            return t_val.alias(c)
        return F.when(s_in, F.col(f"s__{c}")).otherwise(t_val).alias(c)

    return j.select(*[pick(c) for c in out_cols])


def upsert_do_nothing(target: DataFrame, source: DataFrame, pk: list[str],
                      partitions: int | None = None) -> DataFrame:
    """All columns are key columns: insert missing keys, leave existing
    rows untouched (target-only columns keep their values; a key repeated
    in the source is inserted once).  One full-outer join on the key, so
    the output stays aligned with a table bucketed by the key."""
    src = _align(source.select(*pk).dropDuplicates(pk), pk, partitions)
    tgt_cols = list(target.columns)
    t = target.select(*[F.col(_q(c)).alias(f"t__{c}") for c in tgt_cols], F.lit(True).alias(_T))
    s = src.select(*[F.col(_q(c)).alias(f"s__{c}") for c in pk])
    cond = reduce(lambda a, b: a & b, [F.col(f"t__{k}") == F.col(f"s__{k}") for k in pk])
    j = t.join(s, cond, "full_outer")
    t_in = F.col(_T).isNotNull()
    return j.select(*[(F.when(t_in, F.col(f"t__{c}")).otherwise(F.col(f"s__{c}")) if c in pk
                       else F.col(f"t__{c}")).alias(c) for c in tgt_cols])


def reconcile_missing_keys(target: DataFrame, source_keys: DataFrame, pk: list[str],
                           flag: str = "is_deleted") -> DataFrame:
    """Soft delete: flag target rows whose key no longer exists upstream."""
    present = source_keys.select(*pk).distinct().withColumn("__present", F.lit(True))
    return (target.join(present, on=pk, how="left")
                  .withColumn(flag, F.col("__present").isNull())
                  .drop("__present")
                  .select(*target.columns, flag))
