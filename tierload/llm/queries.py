"""Registered queries of this subpackage: each applies its operator to the whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierload.llm import collocations, decontam, hmm, langid, mixture, neardup, pii, preferences, quality, render, resample, substrings, tokens

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TOKEN_LIMIT = 1024
MIX_WEIGHTS = (3, 1, 2)
MIX_SHARE = 1.5


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_preference_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    pairs = preferences.truncated_pairs(turns).unionAll(preferences.opening_pairs(turns))
    rows = preferences.format_pairs(pairs, ["chosen_id", "rejected_id"])
    return rows.select("chosen_id", "rejected_id", "n_common", "prompt", "chosen", "rejected",
                       preferences.spans_text(F.col("chosen_spans")).alias("chosen_mask"),
                       preferences.spans_text(F.col("rejected_spans")).alias("rejected_mask"), "usable")


@_query
def op2_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"), q=4, percent=80)


@_query
def op3_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.ledger(_table(spark, sf_dir, "documents"))
    bits = F.col("fail_bits")
    base = quality.BASE.rejects(bits)
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       base.alias("base_failed"), (~base & ~quality.DEFAULT_POLICY.rejects(bits)).alias("kept"), "fail_bits")


@_query
def op4_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pii.extract(_table(spark, sf_dir, "documents"))
    kinds = F.transform("base", lambda s: s["k"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{kind}")
              for k, kind in enumerate(pii.KINDS[:pii.CONTEXT])]
    return rows.select("doc_id", *counts, F.sha2(pii.spans_text(F.col("base")), 256).alias("base_sha256"),
                       pii.spans_text(F.col("spans")).alias("spans"))


@_query
def op5_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return hmm.score_texts(_table(spark, sf_dir, "documents"), held_out)


@_query
def op6_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = render.render_pages(_table(spark, sf_dir, "pages"))
    return rows.select("page_id", "text", F.length("text").cast("long").alias("n_chars"),
                       F.when(F.col("text") == "", 0).otherwise(F.size(F.split("text", "\n"))).cast("long").alias("n_lines"))


@_query
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digest(_table(spark, sf_dir, "documents"), window=13)


@_query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    rows = tokens.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return rows.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@_query
def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixture.mix_documents(_table(spark, sf_dir, "documents"), MIX_WEIGHTS, MIX_SHARE)
    return rows.select("doc_id", "size", "source_size", "target", "taken")


@_query
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontam.hits(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                       (F.col("n_hit") > 0).alias("contaminated"))


@_query
def op11_target_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = resample.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), percent=25, seed=7)
    return rows.select("doc_id", "n_features", "weight", "score", "rank")


@_query
def op12_phrase_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"), longest=3, min_count=10, percent=50, top=2000)


@_query
def op13_segment_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    return langid.identify(_table(spark, sf_dir, "documents"), held_out, public_tokenizers.path("piece_bpe_32k.model"))
