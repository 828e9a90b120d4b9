"""Mix sources to target weights by min-cost flow.

A document may belong to several sources.  Documents are aggregated by
membership pattern (the sorted set of their sources); the words of each
pattern are routed to the sources' quotas by a min-cost flow in which
every further repetition of a pattern costs more than the one before
(convex costs), so nothing is repeated while unrepeated words could
serve.  Documents are then chosen by a seeded hash: a pattern that must
give ``q * size + r`` words repeats every document ``q`` times and gives
one more copy of documents taken in hash order up to ``r`` words: a
document that no longer fits is passed over, and the order is followed
further with documents of at most the words still missing until none
fits.  Then the smallest one left is added if that comes nearer.

Only one row per pattern ever reaches the driver (``max_patterns`` bounds
them); documents are never sorted or gathered.  The cut in hash order is
found by descending a histogram 4096-fold per step, all patterns at once.

Defined cases: a null text has size 0 and is taken 0 times; a null
source is a source of its own, last in order; a document in no source
(empty array) is never taken; rows repeating an id share its hash,
and equal ones are taken alike; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierload.llm.common import save

STEP_BITS, BITS = 12, 48
RUNS = "array<struct<low:long,high:long,cap:long>>"
WORD = r"[^\x20\x09-\x0D]+"


def shared_targets(sizes: dict, weights: dict, total: float, most: float = 2.0) -> dict:
    """Split ``total`` by weight; no source above ``most`` times its size, the excess reshared by weight."""
    target, free, rest = {}, list(sizes), float(total)
    while free:
        weight = sum(weights[s] for s in free)
        share = {s: rest * weights[s] / weight for s in free}
        full = [s for s in free if share[s] > most * sizes[s]]
        if not full:
            target.update(share)
            break
        for s in full:
            target[s] = float(most * sizes[s])
            rest -= target[s]
        free = [s for s in free if s not in target]
    return target


def route(capacity: dict[tuple, int], quota: dict[object, int], repeats: int = 2) -> dict[tuple, dict[object, int]]:
    """Words each pattern gives each source: min-cost flow by successive cheapest paths.

    Patterns hold ``capacity`` words ``repeats`` times over; the r-th time costs r.  Integer capacities.
    """
    patterns, sources = sorted(capacity, key=repr), sorted(quota, key=repr)
    node = {("p", p): i + 1 for i, p in enumerate(patterns)}
    node |= {("s", s): len(node) + 1 + i for i, s in enumerate(sources)}
    sink = len(node) + 1
    graph: list[list[int]] = [[] for _ in range(sink + 1)]
    to, room, cost = [], [], []

    def edge(a: int, b: int, cap: int, c: int) -> int:
        graph[a].append(len(to))
        to.append(b), room.append(cap), cost.append(c)
        graph[b].append(len(to))
        to.append(a), room.append(0), cost.append(-c)
        return len(to) - 2

    serves = {}
    for p in patterns:
        for r in range(repeats):
            edge(0, node["p", p], capacity[p], r)
        for s in p:
            if s in quota:
                serves[p, s] = edge(node["p", p], node["s", s], capacity[p] * repeats, 0)
    for s in sources:
        edge(node["s", s], sink, quota[s], 0)
    potential = [0] * (sink + 1)
    while True:
        dist, via = [None] * (sink + 1), [-1] * (sink + 1)
        heap = [(0, 0)]
        dist[0] = 0
        while heap:
            d, u = heapq.heappop(heap)
            if d > dist[u]:
                continue
            for e in graph[u]:
                if room[e] > 0:
                    nd = d + cost[e] + potential[u] - potential[to[e]]
                    if dist[to[e]] is None or nd < dist[to[e]]:
                        dist[to[e]], via[to[e]] = nd, e
                        heapq.heappush(heap, (nd, to[e]))
        if dist[sink] is None:
            break
        longest = max(d for d in dist if d is not None)
        potential = [p + (longest if d is None else d) for p, d in zip(potential, dist, strict=True)]
        path, u = [], sink
        while u:
            path.append(via[u])
            u = to[via[u] ^ 1]
        give = min(room[e] for e in path)
        for e in path:
            room[e] -= give
            room[e ^ 1] += give
    flow: dict[tuple, dict[object, int]] = {p: {} for p in patterns}
    for (p, s), e in serves.items():
        if room[e ^ 1]:
            flow[p][s] = room[e ^ 1]
    return flow


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sized(docs: DataFrame, id_col: str, text_col: str, sources: Column, seed: int, keep: bool = False) -> DataFrame:
    """(id, pattern, size, h): the table all steps work on, written once; with ``keep`` also the input ``row``."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), sources.alias("member"),
                      *[F.struct(*docs.columns).alias("row")] * keep)
    pattern = F.array_sort(F.array_distinct("member"))
    return save(src.select("id", pattern.alias("pattern"), word_count(F.col("text")).alias("size"),
                           F.xxhash64(F.lit(seed), F.col("id")).alias("h"), *["row"] * keep), "mixture")


def mix(rows: DataFrame, quotas: dict, repeats: int = 2, max_patterns: int = 100_000) -> DataFrame:
    """Add ``taken`` (words, repeats counted) to a ``sized`` table."""
    spark = rows.sparkSession
    per_pattern = rows.groupBy("pattern").agg(F.sum("size").alias("size")).limit(max_patterns + 1).collect()
    if len(per_pattern) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns; merge sources or raise max_patterns")
    sizes = {tuple(r["pattern"]): r["size"] for r in per_pattern if r["pattern"] is not None}
    flow = route(sizes, {s: int(round(q)) for s, q in quotas.items()}, repeats)
    plan = []
    for i, (pattern, size) in enumerate(sorted(sizes.items(), key=lambda kv: repr(kv[0]))):
        give = sum(flow[pattern].values())
        times = min(repeats, give // size) if size else 0
        plan.append((i, list(pattern), times, give - times * size))
    kind = rows.schema["pattern"].dataType.simpleString()
    plan_df = spark.createDataFrame(plan, f"k int, pattern {kind}, times int, missing long")
    # one row per pattern: bounded by max_patterns; array equality treats null members as equal
    keyed = rows.join(F.broadcast(plan_df), "pattern", "left").drop("pattern")
    chosen = spark.createDataFrame([(k, *x) for k, x in _choose(keyed, plan).items()],
                                   f"k int, runs {RUNS}, extra struct<h:long,size:long>")
    more = _within(_place()) | ((F.col("extra.h") == F.col("h")) & (F.col("extra.size") == F.col("size")))
    return (rows.join(F.broadcast(plan_df.join(chosen, "k")), "pattern", "left")
            .select(*rows.columns, (F.col("size") * (F.coalesce("times", F.lit(0))
                                    + F.coalesce(more, F.lit(False)).cast("int"))).cast("long").alias("taken")))


def _choose(keyed: DataFrame, plan: list[tuple]) -> dict[int, tuple[list[tuple], tuple]]:
    """Per pattern: take one more copy of what its ``runs`` (from, to, largest size) and ``extra`` (hash, size) hold.

    A run takes what fits in hash order up to a document that does not; the next one goes on behind it with
    documents of at most the words still missing, until none fits.
    """
    spark = keyed.sparkSession
    live = keyed.where((F.col("size") > 0) & F.col("k").isNotNull()).select("k", "size", "h", _place().alias("key"))
    runs: dict[int, list[tuple]] = {k: [] for k, *_ in plan}
    missing = {k: m for k, _, _, m in plan if m > 0}
    # where each pattern's run stands: its start and largest size, the prefix found so far, words missing below it
    state = {k: (0, m, 0, 0, m) for k, m in missing.items()}
    before = Window.partitionBy("k").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    while state:
        at = spark.createDataFrame([(k, *x) for k, x in state.items()], "k int, low long, cap long, prefix long, bits int, left long")
        bins = (live.where(F.col("size") <= max(cap for _, cap, *_ in state.values())).join(F.broadcast(at), "k")
                .where((F.col("key") >= F.col("low")) & (F.col("size") <= F.col("cap"))
                       & (F.expr(f"shiftrightunsigned(key, {BITS} - bits)") == F.col("prefix")))
                .groupBy("k", "left", F.expr(f"shiftrightunsigned(key, {BITS - STEP_BITS} - bits)").alias("bin"))
                .agg(F.sum("size").alias("n"), F.min("key").alias("first"), F.max("key").alias("last")))
        # the bin in which the words run out, or the last one
        cut = (bins.withColumn("below", F.coalesce(F.sum("n").over(before), F.lit(0)))
               .withColumn("total", F.sum("n").over(Window.partitionBy("k")))
               .where(F.when(F.col("total") <= F.col("left"), F.col("below") + F.col("n") == F.col("total")).otherwise(
                   (F.col("below") <= F.col("left")) & (F.col("left") < F.col("below") + F.col("n")))))
        found = {r["k"]: r for r in cut.collect()}
        then = {}
        for k, (low, cap, _, bits, left) in state.items():
            r = found.get(k)
            if r is None:  # nothing fits
                continue
            if r["total"] <= left:  # all of it
                runs[k].append((low, 1 << BITS, cap))
                missing[k] = left - r["total"]
                continue
            left -= r["below"]
            if left and r["first"] < r["last"]:
                then[k] = (low, cap, r["bin"], bits + STEP_BITS, left)
                continue
            runs[k].append((low, r["first"], cap))
            missing[k] = left
            if left:
                then[k] = (r["first"] + 1, left, 0, 0, left)
        state = then
    extra: dict[int, tuple] = {}
    missing = {k: m for k, m in missing.items() if m}
    if missing:
        # every document left is larger than what is missing: the smallest one, where that comes nearer
        at = spark.createDataFrame([(k, m, runs[k]) for k, m in missing.items()], f"k int, left long, runs {RUNS}")
        gap = F.col("size") * F.col("rows") - F.col("left")
        best = (live.join(F.broadcast(at), "k").where((F.col("size") < 2 * F.col("left")) & ~_within(F.col("key")))
                .groupBy("k", "left", "h", "size").agg(F.count("*").alias("rows"))
                .where(F.abs(gap) < F.col("left"))
                .groupBy("k").agg(F.min(F.struct(F.abs(gap).alias("gap"), "h", "size")).alias("b")))
        extra = {r["k"]: (r["b"]["h"], r["b"]["size"]) for r in best.collect()}
    return {k: (runs[k], extra.get(k)) for k in runs}


def _place() -> Column:
    """Place in hash order."""
    return F.shiftrightunsigned("h", 64 - BITS)


def _within(key: Column) -> Column:
    return F.exists("runs", lambda r: (key >= r["low"]) & (key < r["high"]) & (F.col("size") <= r["cap"]))


def weighted_quotas(rows: DataFrame, weights: Iterable[int], share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, target): sources by code point, null last, weighted in turn; ``rows`` from ``sized``."""
    sizes = {r["s"]: r["n"] for r in
             rows.select(F.explode("pattern").alias("s"), "size").groupBy("s").agg(F.sum("size").alias("n")).collect()}
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    cycle = list(weights)
    target = shared_targets({s: sizes[s] for s in order}, {s: cycle[i % len(cycle)] for i, s in enumerate(order)},
                            share * sum(sizes.values()), most)
    return rows.sparkSession.createDataFrame([(s, sizes[s], target[s]) for s in order],
                                             "source string, source_size long, target double")


def mix_documents(docs: DataFrame, weights: Iterable[int] = (3, 1, 2), share: float = 1.5, repeats: int = 2,
                  seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                  keep: bool = False) -> DataFrame:
    """(id, source, size, source_size, target, taken[, row]) of every document with one source each."""
    rows = sized(docs, id_col, text_col, F.array(F.col(source_col).cast("string")), seed, keep)
    table = weighted_quotas(rows, weights, share, repeats)
    quotas = {r["source"]: r["target"] for r in table.collect()}
    out = mix(rows, quotas, repeats).withColumn("source", F.element_at("pattern", 1))
    # one row per source, as many as collected above
    table = table.withColumnRenamed("source", "s")
    return (out.join(F.broadcast(table), F.col("source").eqNullSafe(F.col("s")), "left")
            .select(F.col("id").alias(id_col), "source", "size", "source_size", "target", "taken", *["row"] * keep))


def take(docs: DataFrame, weights: Iterable[int] = (3, 1, 2), share: float = 1.5, **kw) -> DataFrame:
    """The input rows that the mix takes, with all their columns, how many times (``copies``) and words (``taken``).

    Every row is judged and returned as itself, whatever its id; input
    columns named ``copies`` or ``taken`` are replaced.
    """
    rows = mix_documents(docs, weights, share, keep=True, **kw).where(F.col("taken") > 0)
    new = {"copies": F.expr("CAST(taken div size AS int)"), "taken": F.col("taken")}
    return rows.select(*[F.col("row")[c].alias(c) for c in docs.columns if c not in new], *[x.alias(c) for c, x in new.items()])
