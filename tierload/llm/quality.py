"""Rule bitmask ledger.

Every rule is evaluated once per text; the ledger keeps one bit per
failed rule (``fail_bits``) and the measurements behind it.  Policies are
versioned bit masks: applying one, or asking what a policy would do
without one of its rules, are bitwise expressions over the ledger and
never touch the texts again.

Defined cases: a null text is an empty one (no words, so ``few_words``
fails); an empty table gives an empty ledger; repeated rows are judged
alone; other columns of the input are passed through ``apply_policy``
untouched, whatever their names, and only the id column reaches the
ledger.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierload.llm.common import arrow_map
from tierload.llm.text import Words, blocks, hash_spans, mix

MEASURES = ("n_chars", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
            "n_alpha_words", "n_upper", "n_letters")

#: (name, failing condition); the same condition serves Spark columns and numpy arrays of the measures.
#: Integers only.  Bit i belongs to rule i for ever; new rules are appended.
RULES: tuple[tuple[str, Callable], ...] = (
    ("few_words", lambda m: m["n_words"] < 50),
    ("repeated_words", lambda m: 100 * m["n_repeat_words"] > 50 * m["n_words"]),
    ("short_words", lambda m: m["word_chars"] < 2 * m["n_words"]),
    ("long_words", lambda m: m["word_chars"] > 15 * m["n_words"]),
    ("symbols", lambda m: 4 * m["n_symbols"] > m["n_words"]),
    ("repeated_lines", lambda m: 10 * m["n_dup_lines"] > 3 * m["n_lines"]),
    ("few_alphabetic", lambda m: 10 * m["n_alpha_words"] < 6 * m["n_words"]),
    ("upper_case", lambda m: (10 * m["n_upper"] > 6 * m["n_letters"]) & (m["n_letters"] > 0)),
    ("many_words", lambda m: m["n_words"] > 100000),
)
BIT = {name: i for i, (name, _) in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A named, versioned set of enforced rules; ``soft`` rules reject when ``max_soft`` of them are exceeded."""

    name: str
    version: int
    hard: tuple[str, ...]
    soft: tuple[str, ...] = ()
    max_soft: int = 0

    def mask(self, which: tuple[str, ...] | None = None) -> int:
        return sum(1 << BIT[r] for r in (self.hard + self.soft if which is None else which))

    def rejects(self, bits: Column, without: str | None = None) -> Column:
        """Boolean column: the policy (less one rule, for ablations) rejects these failure bits."""
        hard = self.mask(tuple(r for r in self.hard if r != without))
        soft = self.mask(tuple(r for r in self.soft if r != without))
        return ((bits.bitwiseAND(F.lit(hard)) != 0)
                | (F.bit_count(bits.bitwiseAND(F.lit(soft))) > self.max_soft))


BASE = Policy("base", 1, ("few_words", "repeated_words"))
POLICIES: dict[tuple[str, int], Policy] = {(p.name, p.version): p for p in (
    BASE,
    Policy("corpus", 1, BASE.hard + ("short_words", "long_words", "symbols", "repeated_lines", "few_alphabetic")),
    Policy("corpus", 2, BASE.hard + ("symbols", "repeated_lines", "few_alphabetic", "upper_case"),
           soft=("short_words", "long_words"), max_soft=1),
)}
DEFAULT_POLICY = POLICIES[("corpus", 2)]

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_CONTINUES = np.array([(b & 0xC0) == 0x80 for b in range(256)])
_UPPER = np.array([65 <= b <= 90 for b in range(256)])
_LETTER = np.array([65 <= b <= 90 or 97 <= b <= 122 for b in range(256)])
_ALPHA = _LETTER | np.array([b >= 0xC0 for b in range(256)])


def _per_row(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Number of set flags between consecutive bounds."""
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[bounds[1:]] - total[bounds[:-1]]


def measure(texts: pa.Array) -> dict[str, np.ndarray]:
    """The measures of each text."""
    w = Words(texts)
    n, data, off = len(w.offsets) - 1, w.data, w.offsets
    lead = ~_CONTINUES[data]
    lead_total = np.concatenate([[0], np.cumsum(lead)])
    chars = lead_total[w.end] - lead_total[w.start]
    alpha = np.concatenate([[0], np.cumsum(_ALPHA[data])])
    has_alpha = alpha[w.end] > alpha[w.start]
    rows = np.arange(n)
    # lines: cut at \n and at text ends
    newline = np.flatnonzero(data == 10)
    line_start = np.union1d(off[:-1], newline + 1) if len(data) else np.zeros(0, np.int64)
    line_start = line_start[line_start < len(data)]
    line_row = np.searchsorted(off, line_start, side="right") - 1
    stop = np.append(newline, len(data))
    line_end = np.minimum(stop[np.searchsorted(stop, line_start)], off[line_row + 1])
    worded = np.searchsorted(w.start, line_end) > np.searchsorted(w.start, line_start)
    line_start, line_end, line_row = line_start[worded], line_end[worded], line_row[worded]
    line_key = hash_spans(data, line_start, line_end) ^ mix(line_row.astype(np.uint64))
    order = np.argsort(line_key, kind="stable")
    again = np.zeros(len(order), bool)
    again[1:] = line_key[order][1:] == line_key[order][:-1]
    # words inside 3-word windows that occur at least twice in their text
    at, h = w.windows(3)
    key = h ^ mix(w.row[at].astype(np.uint64))
    o = np.argsort(key)
    s = key[o]
    twice = np.zeros(len(s), bool)
    same = s[1:] == s[:-1]
    twice[1:] |= same
    twice[:-1] |= same
    begin = at[o[twice]]
    hit = np.zeros(len(w.start) + 3, bool)
    for j in range(3):
        hit[begin + j] = True
    first = w.first
    return {
        "n_chars": _per_row(lead, off), "n_words": w.count, "word_chars": _per_row_sum(chars, first),
        "n_symbols": _per_row(_SYMBOL[data], off),
        "n_lines": np.bincount(line_row, minlength=n), "n_dup_lines": np.bincount(line_row[order[again]], minlength=n),
        "n_repeat_words": _per_row(hit[:len(w.start)], first), "n_alpha_words": _per_row(has_alpha, first),
        "n_upper": _per_row(_UPPER[data], off), "n_letters": _per_row(_LETTER[data], off),
    } if len(rows) else {m: np.zeros(0, np.int64) for m in MEASURES}


def _per_row_sum(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]


def rule_bits() -> Column:
    """The failure bits of a row of measures."""
    bits = F.lit(0).cast("long")
    measures = {m: F.col(m) for m in MEASURES}
    for i, (_, failing) in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(failing(measures), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return bits


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, every measure (long) and ``fail_bits``.  One narrow pass, no shuffle."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = src.schema["id"].dataType.simpleString()

    def fn(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for b in blocks(batch, "text"):
            m = measure(b.column("text"))
            yield pa.RecordBatch.from_arrays(
                [b.column("id")] + [pa.array(m[k].astype(np.int64)) for k in MEASURES], ["id", *MEASURES])

    rows = arrow_map(src, fn, f"id {id_type}, " + ", ".join(f"{m} long" for m in MEASURES))
    out = rows.withColumn("fail_bits", rule_bits())
    return out.withColumnRenamed("id", id_col)


def apply_policy(docs: DataFrame, policy: Policy = DEFAULT_POLICY, text_col: str = "text") -> DataFrame:
    """The input rows (all columns) that the policy keeps, in one narrow pass.

    Rules are evaluated inside the pass, so no join by id is needed: repeated or null ids are harmless.
    """
    fields, names = docs.schema, docs.columns
    at = names.index(text_col)
    hard, soft, most = policy.mask(policy.hard), policy.mask(policy.soft), policy.max_soft

    def fn(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        renamed = pa.RecordBatch.from_arrays(batch.columns, [f"c{i}" for i in range(batch.num_columns)])
        for b in blocks(renamed, f"c{at}"):
            bits = fail_bits(measure(b.column(at)))
            n_soft = sum(((bits & soft) >> i) & 1 for i in range(len(RULES)))
            keep = ((bits & hard) == 0) & (n_soft <= most)
            part = b.filter(pa.array(keep))
            yield pa.RecordBatch.from_arrays(part.columns, batch.schema.names)

    return arrow_map(docs, fn, fields)


def fail_bits(m: dict[str, np.ndarray]) -> np.ndarray:
    """The same rules over numpy measures."""
    bits = np.zeros(len(m["n_words"]), np.int64)
    for i, (_, failing) in enumerate(RULES):
        bits |= failing(m).astype(np.int64) << i
    return bits


def ablations(rows: DataFrame, policy: Policy = DEFAULT_POLICY) -> DataFrame:
    """Per rule of a policy: documents failing it, rejected by it alone, and kept if it were dropped.

    The ledger is first reduced to distinct failure patterns (2^rules at most, combined before the shuffle).
    """
    patterns = rows.groupBy("fail_bits").agg(F.count("*").alias("n"))
    bits = F.col("fail_bits")
    kept = F.sum(F.when(~policy.rejects(bits), F.col("n")).otherwise(0))
    names = policy.hard + policy.soft
    aggs = [kept.alias("kept")]
    for r in names:
        failing = bits.bitwiseAND(F.lit(1 << BIT[r])) != 0
        aggs += [F.sum(F.when(failing, F.col("n")).otherwise(0)).alias(f"f_{r}"),
                 F.sum(F.when(policy.rejects(bits) & ~policy.rejects(bits, r), F.col("n")).otherwise(0)).alias(f"o_{r}")]
    one = patterns.agg(*aggs)
    out = F.explode(F.array(*[F.struct(
        F.lit(policy.name).alias("policy"), F.lit(policy.version).alias("version"), F.lit(r).alias("rule"),
        F.coalesce(F.col(f"f_{r}"), F.lit(0)).cast("long").alias("n_failed"),
        F.coalesce(F.col(f"o_{r}"), F.lit(0)).cast("long").alias("n_rejected_alone"),
        (F.coalesce(F.col("kept"), F.lit(0)) + F.coalesce(F.col(f"o_{r}"), F.lit(0))).cast("long").alias("n_kept_without"))
        for r in names]))
    return one.select(out.alias("r")).select("r.*")
