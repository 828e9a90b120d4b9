"""Digest reconciliation: find vanished keys bucket by bucket.

Both sides are reduced to one digest per key bucket (count and two sums
of 64-bit key hashes, combined per task before the shuffle).  Equal
digests mean equal keys, so only the buckets that differ are joined.

The digest is of rows, not of distinct keys: a source that repeats a key
only makes its bucket differ, which costs a join and never a wrong flag.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .merge import reconcile_missing_keys

BUCKET = "bucket"
DIGEST = ["n_keys", "digest_a", "digest_b"]
DEFAULT_BUCKETS = 1024


def key_bucket(pk: list[str], buckets: int) -> Column:
    """The bucket of a key: the hash Spark deals bucketed tables by."""
    return F.pmod(F.hash(*[F.col(k) for k in pk]), F.lit(buckets))


def any_null(pk: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in pk])


def key_digests(df: DataFrame, pk: list[str], buckets: int) -> DataFrame:
    """``(bucket, n_keys, digest_a, digest_b, n_null)`` of the keys of ``df``.

    Keys with a NULL match nothing; they are only counted.  The sums are
    decimals, as sums of 64-bit hashes pass 64 bits."""
    keys = df.select(*pk)
    null = any_null(pk)

    def total(seed: int) -> Column:
        h = F.xxhash64(F.lit(seed), *[F.col(k) for k in pk]).cast("decimal(20,0)")
        return F.coalesce(F.sum(F.when(~null, h)), F.lit(0).cast("decimal(30,0)"))

    return keys.groupBy(key_bucket(pk, buckets).alias(BUCKET)).agg(
        F.count_if(~null).alias("n_keys"), total(1).alias("digest_a"), total(2).alias("digest_b"),
        F.count_if(null).alias("n_null"))


def differing_buckets(target: DataFrame, source: DataFrame) -> DataFrame:
    """Buckets (of two :func:`key_digests`) in which target and source
    may hold different keys: another digest, only one side, or a target
    key with a NULL."""
    t, s = target.alias("t"), source.alias("s")
    same = reduce(lambda a, b: a & b, [F.coalesce(F.col(f"t.{c}"), F.lit(0)) == F.coalesce(F.col(f"s.{c}"), F.lit(0))
                                       for c in DIGEST])
    return (t.join(s, F.col(f"t.{BUCKET}") == F.col(f"s.{BUCKET}"), "full_outer")
            .where(~same | (F.coalesce(F.col("t.n_null"), F.lit(0)) > 0))
            .select(F.coalesce(f"t.{BUCKET}", f"s.{BUCKET}").alias(BUCKET)))


def same_key_types(a: DataFrame, b: DataFrame, pk: list[str]) -> bool:
    return a.select(*pk).schema.simpleString() == b.select(*pk).schema.simpleString()


def reconcile_by_digest(target: DataFrame, source_keys: DataFrame, pk: list[str], flag: str = "is_deleted",
                        buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """:func:`reconcile_missing_keys` that joins only differing buckets.

    The driver gets at most ``buckets`` numbers.  Key columns of another
    type on one side hash differently: then everything is joined."""
    if not same_key_types(target, source_keys, pk):
        return reconcile_missing_keys(target, source_keys, pk, flag)
    differ = differing_buckets(key_digests(target, pk, buckets), key_digests(source_keys, pk, buckets))
    hit = key_bucket(pk, buckets).isin([r[BUCKET] for r in differ.collect()])
    joined = reconcile_missing_keys(target.where(hit), source_keys.where(hit), pk, flag)
    return target.where(~hit).withColumn(flag, F.lit(False)).unionByName(joined)
