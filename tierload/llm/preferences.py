"""Chat formatting of preference pairs, with DataFrame functions only.

A pair is a chosen and a rejected conversation.  Their longest common turn
prefix (same role and text, null equal to null) is rendered once as the
prompt; the rest of either side is its completion.  Spans (code points,
end exclusive) mark what is trained in a completion: the text and end mark
of assistant turns, never a header or another role's turn.

Rendering: ``<|role|>\\n`` + text + ``<|end|>\\n``.  ``<|`` inside a text or
role is written ``< |`` so a text cannot forge a mark.

One shuffle brings the turns of a pair together; a row then holds one pair
of conversations.  Opening groups (conversations with the same first turn)
may be of any size: the best conversation of a group is found by a
combined aggregate, and only its turns are repeated over ``SALTS`` to meet
the others, so no task sees a whole group.

Defined cases: turns are ordered by turn number, then role, then text
(repeated rows stay); a null text renders as an empty one and a null role
as ``unknown``; equal sides give empty completions; turns without a
conversation id belong to no conversation; an empty table gives no pairs;
only the four turn columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TRAINED = "assistant"
SALTS = 32
_TURNS = "array<struct<turn:bigint,role:string,text:string>>"


def render_turn(role: Column, text: Column) -> tuple[Column, Column]:
    """(header, body with end mark) of a turn."""
    def plain(c: Column) -> Column:
        return F.replace(c, F.lit("<|"), F.lit("< |"))

    return (F.concat(F.lit("<|"), plain(F.coalesce(role, F.lit("unknown"))), F.lit("|>\n")),
            F.concat(plain(F.coalesce(text, F.lit(""))), F.lit("<|end|>\n")))


def _rendered(turns: Column) -> Column:
    def one(t: Column) -> Column:
        head, body = render_turn(t["role"], t["text"])
        return F.struct(head.alias("head"), body.alias("body"), F.coalesce(t["role"] == TRAINED, F.lit(False)).alias("train"))

    return F.transform(turns, one)


def _text(parts: Column) -> Column:
    return F.array_join(F.transform(parts, lambda p: F.concat(p["head"], p["body"])), "")


def _spans(parts: Column) -> Column:
    """array<struct<start, end>> of the trained code points."""
    kind = "struct<pos:int,out:array<struct<start:int,end:int>>>"
    zero = F.struct(F.lit(0).alias("pos"), F.array().cast("array<struct<start:int,end:int>>").alias("out")).cast(kind)

    def step(acc: Column, p: Column) -> Column:
        start = acc["pos"] + F.length(p["head"])
        end = (start + F.length(p["body"])).cast("int")
        span = F.array(F.struct(start.cast("int").alias("start"), end.alias("end")))
        return F.struct(end.alias("pos"), F.when(p["train"], F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    return F.aggregate(parts, zero, step)["out"]


def format_pairs(turns: DataFrame, keys: list[str]) -> DataFrame:
    """One row per pair: keys, n_common, prompt, chosen, rejected, chosen_spans, rejected_spans, usable.

    ``turns``: keys, side ('chosen' or 'rejected'), turn, role, text.  ``usable``: the sides differ and both have
    something to train on.
    """
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"),
                    F.col("text").cast("string").alias("text"))

    def side(name: str) -> Column:
        return F.array_sort(F.collect_list(F.when(F.col("side") == name, turn))).alias(name)

    both = turns.groupBy(*keys).agg(side("chosen"), side("rejected"))
    least = F.least(F.size("chosen"), F.size("rejected"))
    same = F.zip_with(F.slice("chosen", 1, least), F.slice("rejected", 1, least),
                      lambda a, b: a["role"].eqNullSafe(b["role"]) & a["text"].eqNullSafe(b["text"]))
    common = F.coalesce(F.nullif(F.array_position(same, False), F.lit(0)) - 1, least).cast("int")
    out = both.withColumn("n_common", common)
    for name in ("chosen", "rejected"):
        out = out.withColumn(f"{name}_parts", _rendered(F.slice(name, F.col("n_common") + 1, F.size(name))))
    prompt = _text(_rendered(F.slice("chosen", 1, F.col("n_common"))))
    spans = {name: _spans(F.col(f"{name}_parts")) for name in ("chosen", "rejected")}
    return out.select(*keys, F.col("n_common").cast("long").alias("n_common"), prompt.alias("prompt"),
                      _text(F.col("chosen_parts")).alias("chosen"), _text(F.col("rejected_parts")).alias("rejected"),
                      spans["chosen"].alias("chosen_spans"), spans["rejected"].alias("rejected_spans")).withColumn(
        "usable", (F.size("chosen_spans") > 0) & (F.size("rejected_spans") > 0) & (F.col("chosen") != F.col("rejected")))


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")


def truncated_pairs(turns: DataFrame) -> DataFrame:
    """Pairs of each conversation with itself, its last assistant turn cut to the first half of its words.

    (chosen_id, rejected_id null, side, turn, role, text); conversations without an assistant turn have equal sides.
    """
    last = F.max(F.when(F.col("role") == TRAINED, F.col("turn"))).over(Window.partitionBy("conv_id"))
    words = F.split("text", " ")
    half = F.array_join(F.slice(words, 1, F.greatest(F.ceil(F.size(words) / 2), F.lit(1)).cast("int")), " ")
    cut = F.when((F.col("role") == TRAINED) & (F.col("turn") == F.col("last")), half).otherwise(F.col("text"))
    side = F.explode(F.array(F.lit("chosen"), F.lit("rejected")))
    return (turns.where("conv_id IS NOT NULL").withColumn("last", last).withColumn("side", side)
            .select(F.col("conv_id").alias("chosen_id"), F.lit(None).cast("long").alias("rejected_id"), "side", "turn", "role",
                    F.when(F.col("side") == "rejected", cut).otherwise(F.col("text")).alias("text")))


def opening_pairs(turns: DataFrame) -> DataFrame:
    """Pairs of conversations with the same first turn: the one with the most assistant text against each other one.

    Ties go to the smallest id.  Same columns as ``truncated_pairs``.
    """
    turns = turns.where("conv_id IS NOT NULL")
    first = F.min(F.struct("turn", "role", "text"))
    conv = turns.groupBy("conv_id").agg(first.alias("f"), F.sum(F.when(
        F.col("role") == TRAINED, F.length("text")).otherwise(0)).alias("score")).select(
        "conv_id", F.sha2(F.to_json(F.struct("f.role", "f.text")), 256).alias("opening"), F.coalesce("score", F.lit(0)).alias("score"))
    best = (conv.groupBy("opening").agg(F.max(F.struct("score", (-F.col("conv_id")).alias("minus"))).alias("top"), F.count("*").alias("n"))
            .where("n > 1").select("opening", (-F.col("top.minus")).alias("best")))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    salted = conv.withColumn("salt", F.pmod(F.xxhash64("conv_id"), F.lit(SALTS)).cast("int"))
    pairs = (salted.join(best.select("*", salts), ["opening", "salt"]).where("conv_id != best")
             .select(F.col("best").alias("chosen_id"), F.col("conv_id").alias("rejected_id"), "salt"))
    body = turns.select("conv_id", "turn", "role", "text")
    of_best = body.join(best.select(F.col("best").alias("conv_id")), "conv_id", "left_semi").select("*", salts)
    chosen = pairs.join(of_best.withColumnRenamed("conv_id", "chosen_id"), ["chosen_id", "salt"]).withColumn("side", F.lit("chosen"))
    rejected = pairs.join(body.withColumnRenamed("conv_id", "rejected_id"), "rejected_id").withColumn("side", F.lit("rejected"))
    columns = ["chosen_id", "rejected_id", "side", "turn", "role", "text"]
    return chosen.select(columns).unionAll(rejected.select(columns))
