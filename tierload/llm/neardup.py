"""Near-duplicate groups by a multi-index Hamming join over b-bit MinHash signatures.

A document's set holds its distinct ``q``-word shingles (ASCII lower-cased;
a shorter text is one shingle).  Its signature has ``CHUNKS * CHUNK``
symbols of 16 bits, each the low bits of one MinHash value; the distance
of two signatures is the number of differing symbols (for a Jaccard
similarity J about ``(1 - J)`` of them).

Pigeonhole: at a distance of at most ``CHUNKS * (ERRORS + 1) - 1`` some
chunk of the two signatures differs in at most ``ERRORS`` symbols.  Every
way to place the allowed errors in a chunk is enumerated (the symbols that
may be wrong are left out of the index key), so all pairs up to that
distance share a key.  With 12 chunks of 5 symbols and one error the
guaranteed distance is 23 of 60; a pair at J = 0.8 differs in 12 on
average, and shares no key with probability below 1e-6.

Candidates are confirmed on full shingle sets.  Documents with equal sets
form one class first, and only class representatives are indexed.  A
shingle that no other candidate holds cannot lie in an intersection, so
the number of the others bounds every intersection: it rules out most
pairs of a family of loose variants exactly, before any set is compared.
In the last step, parity bitmaps rule out most of the others, exactly too.  Within
a key, members are linked through hubs (a star, not all pairs) for
``STARS`` rounds; afterwards, every pair of members of one key whose
groups still differ is tested, so no link between different components
is lost.  Keys with many members never send all pairs while a star
already explains them.

Links become components by large-star/small-star contraction over written
edge tables; the smallest id of a component is its name.

Defined cases: a null text, an empty one or one without words has an
empty set and is linked with nothing; rows repeating an id count as one
node (a link of one of them is a link of that id); a null id has a null
component, is linked with nothing and kept; an empty table gives an empty
result; ``deduplicate`` keeps all input columns, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierload.llm.common import IdFilter, arrow_map, save
from tierload.llm.text import Words, blocks, mix

CHUNKS, CHUNK, ERRORS = 12, 5, 1
SYMBOLS = CHUNKS * CHUNK
STARS = 3
PART = 256  # pairs of one hub that a task confirms together
BITMAP = [f"w{i}" for i in range(16)]  # 64-bit words of a parity bitmap
_SEEDS = mix(np.arange(1, SYMBOLS + 1, dtype=np.uint64))
_ODD = mix(np.arange(101, 101 + SYMBOLS, dtype=np.uint64)) | np.uint64(1)


def shingles(texts: pa.Array, q: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, hashes, n): the distinct shingle hashes of each text, sorted, and where each text's begin."""
    w = Words(texts, lower=True)
    at, h = w.windows(q)
    row = w.row[at]
    short = np.flatnonzero((w.count > 0) & (w.count < q))
    if len(short):  # the whole sequence is the one shingle
        whole = np.zeros(len(short), np.uint64)
        for j in range(q - 1):
            has = w.count[short] > j
            whole[has] = mix(whole[has] + w.hash[w.first[short[has]] + j])
        whole = mix(whole + w.count[short].astype(np.uint64))
        h, row = np.concatenate([h, whole]), np.concatenate([row, short])
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    h, row = h[new], row[new]
    n = np.bincount(row, minlength=len(texts))
    return np.concatenate([[0], np.cumsum(n)]), h, n


def signatures(first: np.ndarray, h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """(texts, SYMBOLS) 16-bit symbols; texts without shingles get zeros."""
    out = np.zeros((len(n), SYMBOLS), np.uint16)
    full = np.flatnonzero(n)
    if len(full):
        at = first[full]
        for k in range(SYMBOLS):
            least = np.minimum.reduceat((h ^ _SEEDS[k]) * _ODD[k], at)
            out[full, k] = mix(least).astype(np.uint16)
    return out


def signature_table(docs: DataFrame, id_col: str, text_col: str, q: int) -> DataFrame:
    """(id, n_shingles, set_a, set_b, signature): two 64-bit sums name the set; one row per input row."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def fn(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for b in blocks(batch, "text"):
            first, h, n = shingles(b.column("text"), q)
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h))])
            other = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h ^ np.uint64(0x5851F42D4C957F2D)))])
            sig = signatures(first, h, n)
            fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(2 * SYMBOLS), len(n), [None, pa.py_buffer(sig.tobytes())])
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(n.astype(np.int64)),
                 pa.array((total[first[1:]] - total[first[:-1]]).view(np.int64)),
                 pa.array((other[first[1:]] - other[first[:-1]]).view(np.int64)), fixed.cast(pa.binary())],
                ["id", "n_shingles", "set_a", "set_b", "signature"])

    return arrow_map(src, fn, "id long, n_shingles long, set_a long, set_b long, signature binary")


def index_keys(nodes: DataFrame) -> DataFrame:
    """(key, node): every chunk of every signature with each allowed placement of errors left out."""
    kept = [c for c in combinations(range(CHUNK), CHUNK - ERRORS)]

    def fn(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for a in range(0, batch.num_rows, 20_000):
            b = batch.slice(a, 20_000)
            ids = b.column("node").to_numpy()
            sig = np.frombuffer(b"".join(b.column("signature").to_pylist()), np.uint16).reshape(len(ids), CHUNKS, CHUNK)
            keys = np.empty((CHUNKS, len(kept), len(ids)), np.uint64)
            for j, cols in enumerate(kept):
                k = np.zeros((len(ids), CHUNKS), np.uint64)
                for c in cols:
                    k = k << np.uint64(16) | sig[:, :, c]
                keys[:, j, :] = mix(mix(k) + np.arange(CHUNKS, dtype=np.uint64) * np.uint64(len(kept)) + np.uint64(j)).T
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel().view(np.int64)), pa.array(np.tile(ids, CHUNKS * len(kept)))], ["key", "node"])

    return arrow_map(nodes.select("node", "signature"), fn, "key long, node long")


def possible(a: str, b: str, percent: int) -> Column:
    """Two classes can be linked: neither shares too few shingles with anyone, whatever the other holds.

    A link needs an intersection of percent / (100 + percent) of both sizes, and it lies within the shared shingles.
    """
    return (100 + percent) * F.least(F.col(f"{a}.r"), F.col(f"{b}.r")) >= percent * (F.col(f"{a}.n") + F.col(f"{b}.n"))


def few_differences(percent: int) -> Column:
    """The bitmaps x and y of classes c and d do not rule out a link.

    A bitmap holds the parity of the set's shingles per bit, so two sets differ in at least as many shingles as
    their bitmaps differ in bits; a link allows (100 - percent) / (100 + percent) of both sizes.
    """
    bits = sum((F.bit_count(F.col(f"x.{w}").bitwiseXOR(F.col(f"y.{w}"))) for w in BITMAP), F.lit(0))
    return (100 + percent) * bits <= (100 - percent) * (F.col("c.n") + F.col("d.n"))


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``pairs`` (a, b) with ``linked``: 100 * intersection >= percent * union, on full sets.

    Shingles of one class only cannot lie in an intersection, so the shared ones and the full sizes suffice.
    A class with many pairs (a hub) is dealt in parts of some ``PART`` pairs, each with a copy of its set.
    """
    pairs = save(pairs, "pairs")
    ends = pairs.select(F.explode(F.array(*[F.struct(F.lit(e).alias("end"), F.col(e).alias("node")) for e in "ab"])).alias("e"))
    many = save(ends.groupBy("e.end", "e.node").agg(F.ceil(F.count("*") / PART).alias("parts")).where("parts > 1"), "hubs")
    dealt, side = pairs, {}
    for end, other in ("ab", "ba"):
        hubs = many.where(F.col("end") == end).select(F.col("node").alias(end), "parts")
        parts, part = F.coalesce("parts", F.lit(1)), f"part_{end}"
        dealt = dealt.join(hubs, end, "left").withColumn(part, F.pmod(F.xxhash64(other), parts)).drop("parts")
        own = sets.select(F.col("node").alias(end), F.col("shingles").alias(f"s{end}"), F.col("n").alias(f"n{end}"))
        side[end] = own.join(hubs, end, "left").withColumn(
            part, F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("parts")
    both = F.size(F.array_intersect("sa", "sb"))
    linked = (100 + percent) * both >= percent * (F.col("na") + F.col("nb"))
    rows = dealt.join(side["b"], ["b", "part_b"]).join(side["a"], ["a", "part_a"]).select("a", "part_a", "b", linked.alias("linked"))
    # the part follows from the pair; with it the groups stay where the join has put them
    return rows.groupBy("a", "part_a", "b").agg(F.max("linked").alias("linked")).drop("part_a")


def components(edges: DataFrame, label: str = "components", most: int = 60) -> DataFrame:
    """(node, component): smallest reachable node, for every node of ``edges`` (a, b)."""
    def fingerprint(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    def star(e: DataFrame, large: bool) -> DataFrame:
        # neighbours of u: all of them, or those not above u
        if large:
            near = e.unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            near = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        out = near.join(low, "a")
        if large:
            out = out.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = out.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(low.select("a", F.col("m").alias("b")))
        return out.where(F.col("a") != F.col("b")).distinct()

    edges = save(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    seen = fingerprint(edges)
    for _ in range(most):
        edges = save(star(star(edges, True), False), label)
        now = fingerprint(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    found = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", q: int = 5, percent: int = 80) -> DataFrame:
    """(id, n_shingles, component_id, kept), one row per input row."""
    table = save(signature_table(docs, id_col, text_col, q), "signatures")
    nodes = save(table.where((F.col("n_shingles") > 0) & F.col("id").isNotNull())
                 .groupBy("set_a", "set_b", "n_shingles").agg(F.min("id").alias("node"), F.first("signature").alias("signature")), "classes")
    names = linked_classes(docs, nodes, id_col, text_col, q, percent)
    classes = nodes.join(names, "node", "left").select(
        "set_a", "set_b", "n_shingles", F.coalesce("component", "node").alias("component"))
    out = table.drop("signature").join(classes, ["set_a", "set_b", "n_shingles"], "left")
    # an id that repeats with different texts has the smallest component of its rows
    name = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", name.alias("component_id"),
                      F.coalesce(F.col("id") == name, F.lit(True)).alias("kept"))


def linked_classes(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str, q: int, percent: int) -> DataFrame:
    """(node, component) of the class representatives that have a link."""
    keys = index_keys(nodes)
    common = keys.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first != last").select("key")
    found = save(keys.join(common, "key"), "members")
    sets = save(shared_shingles(save(shingle_sets(docs, id_col, text_col, q, IdFilter(found, "node")), "sets"), percent), "shared")
    class_of = F.struct("node", F.size("shingles").alias("r"), "n").alias("c")
    members = save(found.join(sets.select("node", class_of), "node").select("key", "c"), "members")

    # first star: each class against its smallest hub
    hubs = members.groupBy("key").agg(F.min("c").alias("hub"))
    pairs = (members.join(hubs, "key").where((F.col("c.node") != F.col("hub.node")) & possible("c", "hub", percent))
             .groupBy(F.col("c.node").alias("b")).agg(F.min("hub.node").alias("a")).select("a", "b"))
    all_tested = save(confirm(pairs, sets, percent), "tested")
    names = components(all_tested.where("linked").select("a", "b"))
    for _ in range(STARS - 1):
        open_keys = unresolved(members, names)
        score = (all_tested.select(F.col("a").alias("node"), "linked").unionAll(all_tested.select(F.col("b").alias("node"), "linked"))
                 .groupBy("node").agg(F.sum(F.when(F.col("linked"), 1).otherwise(-1)).alias("score")))
        ranked = open_keys.join(score, F.col("c.node") == F.col("node"), "left").select(
            "key", "c", "component", F.coalesce("score", F.lit(0)).alias("score"))
        hubs = ranked.groupBy("key").agg(F.max(F.struct("score", (-F.col("c.node")).alias("minus"), F.col("c").alias("hub"),
                                                        F.col("component").alias("hub_component"))).alias("top")).select("key", "top.*")
        pairs = (ranked.select("key", "c", "component").join(hubs, "key")
                 .where((F.col("component") != F.col("hub_component")) & possible("c", "hub", percent))
                 .select(F.least("hub.node", "c.node").alias("a"), F.greatest("hub.node", "c.node").alias("b")).distinct()
                 .join(all_tested.select("a", "b"), ["a", "b"], "left_anti"))
        tested = save(confirm(pairs, sets, percent), "tested")
        if not tested.head(1):
            break
        all_tested = all_tested.unionAll(tested)
        names = components(all_tested.where("linked").select("a", "b"))
    # what no star has joined: every possible pair of one key whose components still differ
    bits = sets.select("node", F.struct(*BITMAP).alias("x"))
    rest = unresolved(members, names).join(bits, F.col("c.node") == F.col("node")).select("key", "c", "component", "x")
    other = rest.select("key", F.col("c").alias("d"), F.col("component").alias("other_component"), F.col("x").alias("y"))
    pairs = (rest.join(other, "key").where((F.col("c.node") < F.col("d.node")) & (F.col("component") != F.col("other_component"))
                                           & possible("c", "d", percent) & few_differences(percent))
             .select(F.col("c.node").alias("a"), F.col("d.node").alias("b")).distinct()
             .join(all_tested.select("a", "b"), ["a", "b"], "left_anti"))
    tested = save(confirm(pairs, sets, percent), "tested")
    if tested.where("linked").head(1):
        names = components(all_tested.unionAll(tested).where("linked").select("a", "b"))
    return names


def unresolved(members: DataFrame, names: DataFrame) -> DataFrame:
    """(key, c, component) of the keys whose members are in different components."""
    named = members.join(names, F.col("c.node") == F.col("node"), "left").select(
        "key", "c", F.coalesce("component", "c.node").alias("component"))
    mixed = named.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo != hi").select("key")
    return save(named.join(mixed, "key"), "open")


def shared_shingles(sets: DataFrame, percent: int) -> DataFrame:
    """(node, n, shingles, bitmap): full size, and the shingles that some other class holds too.

    A class of which fewer than ``percent`` percent are shared can have no link and is left out.
    """
    rows = sets.select("node", "n", F.explode("shingles").alias("shingle"))
    common = rows.groupBy("shingle").agg(F.count("*").alias("holders")).where("holders > 1").select("shingle")
    kept = rows.join(common, "shingle").groupBy("node", "n").agg(F.collect_list("shingle").alias("shingles"))
    return kept.where(100 * F.size("shingles") >= percent * F.col("n")).join(sets.select("node", "n", *BITMAP), ["node", "n"])


def shingle_sets(docs: DataFrame, id_col: str, text_col: str, q: int, ids: IdFilter) -> DataFrame:
    """(node, shingles) of the documents that share an index key with another one."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def fn(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for b in blocks(batch.filter(pa.array(ids.contains(batch.column("id")))), "text"):
            first, h, n = shingles(b.column("text"), q)
            lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(h.view(np.int64)))
            width = 64 * len(BITMAP)
            place = np.repeat(np.arange(len(n)), n) * width + (mix(h + np.uint64(7)) % np.uint64(width)).astype(np.int64)
            odd = (np.bincount(place, minlength=len(n) * width) & 1).reshape(len(n), width)
            words = np.packbits(odd.astype(np.uint8), axis=1).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(n.astype(np.int32)), lists, *[pa.array(words[:, i].copy()) for i in range(len(BITMAP))]],
                ["node", "n", "shingles", *BITMAP])

    return arrow_map(src, fn, "node long, n int, shingles array<long>, " + ", ".join(f"{w} long" for w in BITMAP)).where(F.size("shingles") > 0)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", q: int = 5, percent: int = 80,
                null_ids: bool = False) -> DataFrame:
    """The input rows of which one per group stays, with all columns.

    Every row with an id is a node of its own, so rows that repeat an id are
    judged by their texts.  The row with the smallest id stays (of rows
    repeating it, one).  Rows without words all stay, and so do rows without
    an id, which link with nothing; with ``null_ids`` they are judged like
    the others, as the last of their groups.
    """
    row = "__row"
    while row in docs.columns:
        row += "_"
    # written, so that a row keeps its number in every later step
    rows = save(docs.withColumn(row, row_number(docs, id_col)), "rows")
    judged = rows if null_ids else rows.where(F.col(id_col).isNotNull())
    found = near_duplicates(judged, row, text_col, q, percent).select(row, "component_id")
    named = found.join(rows.select(row, F.struct(F.col(id_col).isNull(), F.col(id_col), F.col(row).alias("row")).alias("rank")), row)
    best = named.groupBy("component_id").agg(F.min("rank").alias("first"), F.count("*").alias("n")).where("n > 1")
    gone = named.join(best, "component_id").where(F.col(row) != F.col("first.row")).select(row)
    return rows.join(gone, row, "left_anti").select(*docs.columns)


def row_number(docs: DataFrame, id_col: str) -> Column:
    """A number of its own for every row: its id where that occurs once, else one below all ids.

    Ids that may repeat are told by a filter of fixed size; one that is
    taken for a repeated id only gets another number.
    """
    ids = docs.select(F.col(id_col).cast("long").alias("id")).where("id IS NOT NULL")
    least = ids.agg(F.min("id")).first()[0] or 0
    own = F.lit(min(least, 0) - 1) - F.monotonically_increasing_id()
    number = F.col(id_col).cast("long")
    again = save(ids.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id"), "repeated")
    if again.isEmpty():
        return F.coalesce(number, own)
    known = IdFilter(again, "id")

    @F.pandas_udf("boolean")
    def repeats(series: pd.Series) -> pd.Series:
        return pd.Series(known.contains(pa.Array.from_pandas(series, type=pa.int64())))

    return F.when(repeats(number) | number.isNull(), own).otherwise(number)
