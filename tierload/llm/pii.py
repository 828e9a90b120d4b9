"""Personal data: fixed patterns, and contextual extraction bootstrapped from them.

Everything is built-in DataFrame functions.  One pass finds the base
entities (email, ip, card, phone) of every text with their positions:
``regexp_extract_all`` gives the matches, ``split`` by the same pattern
the gaps between them, and their running lengths are code-point offsets.
The same pass lists identifier-like tokens (6 or more characters, a digit
among them) that no base entity covers.  Patterns are written so that
Java's matcher needs no backtracking over long runs (possessive, and
anchored at the start of a run), with the same matches.

Bootstrapping: base entities and long key-like secrets are seed instances;
the two words before an instance (lower-cased; one at a text's start) are
its lexical pattern, with the quotes, brackets or signs directly before it.
On the distinct (pattern, instance) graph, rounds of

* pattern confidence = mean confidence of its instances, kept if at least
  ``MIN_SUPPORT`` different confident instances support it and it reaches
  ``MIN_PATTERN``,
* instance confidence = 1 - product of (1 - pattern confidence)

are plain aggregates, combined before each shuffle.  Tokens that no fixed
pattern knows but whose confidence reaches ``MIN_INSTANCE`` are reported
as kind ``context`` wherever they occur.

Defined cases: a null text is an empty one (no spans); texts without a
match have no spans; repeated rows and ids are reported each; ties in
start are ordered by kind; an empty table gives an empty result;
``redact`` keeps all input columns, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierload.llm.common import save

KINDS = ("email", "ip", "card", "phone", "context")
CONTEXT = 4
MIN_SUPPORT, MIN_PATTERN, MIN_INSTANCE, ROUNDS = 3, 0.6, 0.6, 3
#: characters before an instance that are read first for its context
NEAR = 80

_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # runs of fewer than 12 digits could not pass the length check
    "card": r"[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: cheap test that a text may hold a match
GATES = {"email": "@", "phone": "+"}
TOKEN = r"(?<!\S)(?=[^\s0-9]*+[0-9])\S{6,}+"
SECRET = r"^(?:[0-9a-fA-F]{32,}|AKIA[0-9A-Z]{16})$"
#: on reversed text: what stands directly before an instance, and two words before that
_LEAD, _TWO = r"[^A-Za-z0-9\s]*+", r"\s++\S++\s++\S++"
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"


def _spans(text: Column, pattern: str) -> Column:
    """array<struct<start, end, m>> of the matches, in code points."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pairs = F.zip_with(found, gaps, lambda m, g: F.struct(m.alias("m"), g.alias("g")))
    kind = "struct<pos:int,out:array<struct<start:int,end:int,m:string>>>"

    def step(acc: Column, x: Column) -> Column:
        start = acc["pos"] + F.length(x["g"])
        end = start + F.length(x["m"])
        one = F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"), x["m"].alias("m"))
        return F.struct(end.cast("int").alias("pos"), F.concat(acc["out"], F.array(one)).alias("out"))

    zero = F.struct(F.lit(0).alias("pos"), F.array().cast("array<struct<start:int,end:int,m:string>>").alias("out")).cast(kind)
    return F.aggregate(F.filter(pairs, lambda x: x["m"].isNotNull()), zero, step)["out"]


def _valid(kind: str, m: Column) -> Column:
    digits = F.regexp_replace(m, r"[^0-9]", "")
    if kind == "ip":
        return m.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "phone":
        return F.length(digits).between(9, 15)
    if kind == "card":
        back = F.split(F.reverse(digits), "")
        values = F.transform(back, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
        luhn = F.aggregate(values, F.lit(0), lambda a, b: a + b) % 10 == 0
        return F.when(F.length(digits).between(12, 19), luhn).otherwise(False)
    return F.lit(True)


_EMPTY = "array<struct<start:int,k:int,end:int,m:string>>"


def base_spans(text: Column) -> Column:
    """array<struct<start, k, end, m>>: valid base matches, ordered by start, then kind."""
    return F.array_sort(F.concat(*[_kind_spans(text, k, kind) for k, kind in enumerate(PATTERNS)]))


def _kind_spans(text: Column, k: int, kind: str) -> Column:
    pattern = PATTERNS[kind]
    gate = F.instr(text, GATES[kind]) > 0 if kind in GATES else text.rlike(pattern)
    if kind == "ip":
        gate = text.rlike(r"[0-9]\.[0-9]++\.[0-9]")
    ok = F.filter(_spans(text, pattern), lambda s: _valid(kind, s["m"]))
    named = F.transform(ok, lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("k"), s["end"].alias("end"), s["m"].alias("m")))
    return F.when(gate, named).otherwise(F.array().cast(_EMPTY))


def _pattern_before(text: Column, start: Column) -> Column:
    """The two words before an instance and what stands directly before it (quotes, brackets), lower-cased.

    One word at a text's start; empty where there is none, or where a letter or digit stands directly before.
    The last ``NEAR`` characters mostly tell; what they cut is read from the whole text before the instance.
    """
    begin = F.greatest(start - NEAR, F.lit(0))
    near = F.reverse(F.substring(text, begin + 1, start - begin))
    told = (begin == 0) | near.rlike(rf"^{_LEAD}(?:[A-Za-z0-9]|{_TWO}\s)")
    back = F.when(told, near).otherwise(F.reverse(F.substring(text, F.lit(1), start)))
    words = F.reverse(F.regexp_extract(back, rf"^{_LEAD}\s++\S++(?:\s++\S++)?+", 0))
    return F.lower(F.regexp_replace(words, r"\s+", " "))


def entity_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, doc, base, mentions): the compact table of one pass over the texts; ``doc`` numbers the rows.

    mentions: (start, end, pattern, instance, seed) of base entities and of identifier-like tokens.
    """
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    base = src.withColumn("base", base_spans(F.col("text")))
    text = F.col("text")
    tokens = F.when(text.rlike(TOKEN), _spans(text, TOKEN)).otherwise(F.array().cast("array<struct<start:int,end:int,m:string>>"))

    def trimmed(s: Column) -> Column:
        lead = F.length(F.regexp_extract(s["m"], r"^[^A-Za-z0-9]*+", 0))
        core = F.regexp_extract(s["m"], r"^[^A-Za-z0-9]*+(.*[A-Za-z0-9])", 1)
        start = (s["start"] + lead).cast("int")
        return F.struct(start.alias("start"), (start + F.length(core)).cast("int").alias("end"), core.alias("m"))

    free = F.filter(F.transform(tokens, trimmed), lambda s: (F.length(s["m"]) >= 6) & ~F.exists(
        F.col("base"), lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))

    def mention(s: Column, seed: Column) -> Column:
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), _pattern_before(text, s["start"]).alias("pattern"),
                        F.xxhash64(F.lower(s["m"])).alias("instance"), seed.alias("seed"))

    mentions = F.concat(F.transform(F.col("base"), lambda s: mention(s, F.lit(2))),
                        F.transform(free, lambda s: mention(s, F.when(s["m"].rlike(SECRET), 1).otherwise(0))))
    hashed = F.transform(F.filter(mentions, lambda m: (m["pattern"] != "") | (m["seed"] < 2)),
                         lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"),
                                            F.when(m["pattern"] != "", F.xxhash64(m["pattern"])).alias("pattern"),
                                            m["instance"].alias("instance"), m["seed"].alias("seed")))
    spans = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["k"].alias("k"), s["end"].alias("end")))
    return base.select("id", F.xxhash64("text").alias("text_hash"), spans.alias("base"), hashed.alias("mentions")).withColumn(
        "doc", F.monotonically_increasing_id())


def score(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(instance, conf) after the rounds; ``edges``: distinct (pattern, instance, seed 0/1)."""
    seeds = edges.groupBy("instance").agg(F.max("seed").cast("double").alias("conf"))
    inst = seeds
    for _ in range(rounds):
        pat = (edges.join(inst, "instance").groupBy("pattern")
               .agg(F.avg("conf").alias("pc"), F.sum((F.col("conf") >= MIN_INSTANCE).cast("int")).alias("n"))
               .where((F.col("n") >= MIN_SUPPORT) & (F.col("pc") >= MIN_PATTERN)).select("pattern", "pc"))
        grown = (edges.join(pat, "pattern").groupBy("instance")
                 .agg((1 - F.exp(F.sum(F.log(1 - F.least("pc", F.lit(0.999)))))).alias("new")))
        inst = save(seeds.join(grown, "instance", "left").select(
            "instance", F.greatest("conf", F.coalesce("new", F.lit(0.0))).alias("conf")), "instances")
    return inst


def discovered(table: DataFrame) -> DataFrame:
    """(doc, start, end): occurrences of confident instances that no fixed pattern finds."""
    rows = table.where(F.size("mentions") > 0).select("doc", F.explode("mentions").alias("m")).select("doc", "m.*")
    edges = save(rows.where("pattern IS NOT NULL").groupBy("pattern", "instance").agg(F.max((F.col("seed") > 0).cast("int")).alias("seed")), "edges")
    # a secret counts as found only where a learned pattern leads to it
    pat = (edges.join(score(edges), "instance").groupBy("pattern")
           .agg(F.avg("conf").alias("pc"), F.sum((F.col("conf") >= MIN_INSTANCE).cast("int")).alias("n"))
           .where((F.col("n") >= MIN_SUPPORT) & (F.col("pc") >= MIN_PATTERN)).select("pattern", "pc"))
    sure = (edges.join(pat, "pattern").groupBy("instance")
            .agg((1 - F.exp(F.sum(F.log(1 - F.least("pc", F.lit(0.999)))))).alias("conf"))
            .where(F.col("conf") >= MIN_INSTANCE).select("instance"))
    return rows.where("seed < 2").join(sure, "instance").select("doc", "start", "end")


def extract(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, spans), one row per input row: arrays of (start, k, end), k an index of ``KINDS``."""
    table = save(entity_table(docs, id_col, text_col), "entities")
    return _all_spans(table).select(F.col("id").alias(id_col), "base", "spans")


def _all_spans(table: DataFrame) -> DataFrame:
    one = F.struct("start", F.lit(CONTEXT).alias("k"), "end")
    more = discovered(table).groupBy("doc").agg(F.collect_list(one).alias("more"))
    spans = F.array_sort(F.concat("base", F.coalesce("more", F.array().cast("array<struct<start:int,k:int,end:int>>"))))
    return table.select("id", "text_hash", "doc", "base").join(more, "doc", "left").withColumn("spans", spans)


def spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["k"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def merged(spans: Column) -> Column:
    """Spans that overlap as one, of the first one's kind."""
    kind = "array<struct<start:int,k:int,end:int>>"

    def step(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        joined = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
            last["start"].alias("start"), last["k"].alias("k"), F.greatest(last["end"], s["end"]).alias("end"))))
        return F.when(F.size(acc) == 0, F.array(s)).when(s["start"] < last["end"], joined).otherwise(F.concat(acc, F.array(s)))

    return F.aggregate(spans, F.array().cast(kind), step)


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All rows and columns, with every span of the text replaced by its kind in brackets.

    Spans go by text, so only the (few) texts with spans have a partner in the join.
    """
    table = save(entity_table(docs.withColumn("__id", F.lit(0)), "__id", text_col), "entities")
    found = (_all_spans(table).where(F.size("spans") > 0).groupBy("text_hash").agg(F.first("spans").alias("__spans"))
             .withColumnRenamed("text_hash", "__hash"))
    text = F.col(text_col)
    label = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    spans = merged(F.col("__spans"))
    ends = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end"]))
    pieces = F.zip_with(ends, spans, lambda e, s: F.when(s.isNull(), F.substring(text, e + 1, F.length(text))).otherwise(
        F.concat(F.substring(text, e + 1, s["start"] - e), F.element_at(label, s["k"] + 1))))
    out = docs.join(found, F.xxhash64(F.coalesce(text.cast("string"), F.lit(""))) == F.col("__hash"), "left")
    return out.withColumn(text_col, F.when(F.col("__spans").isNull(), text).otherwise(F.array_join(pieces, ""))).select(
        *[F.col(f"`{c}`") for c in docs.columns])
