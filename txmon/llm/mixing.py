"""Mixing sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources they belong to).  A flow network
routes each pattern's words to its sources: the r-th repetition of a pattern's words is an arc of its
own whose cost grows with r, and the arcs into the sink carry the sources' targets.  The flow decides
how many words each pattern gives; whole documents are then taken in a seeded order until each
pattern's words are reached, so the mix is the same in every run.

Only the network (patterns x sources) is on the driver; its size is checked.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txmon.llm.common import DOC_COLUMNS, read, staged, word_count

SEED = 17
REPEATS = 2
#: Run: 996,000 arcs, three sources a pattern, take 22 s and 460 MB on the driver.
MAX_ARCS = 1_000_000
#: Slices of the seeded order; the rows of one slice of one pattern are ordered in one task.
SLICES = 1 << 14
FILL_ROUNDS = 5


def targets(sizes: dict, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, cap: float = REPEATS) -> dict:
    """Targets by source: sources in code-point order (null last) weigh ``weights`` in turn and share
    ``share`` of all sizes; a target stops at ``cap`` times its source's size, and the excess is
    shared by weight among the others until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, free, left = {}, list(order), share * sum(sizes.values())
    while free:
        unit = left / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * unit >= cap * sizes[s]]
        if not over:
            return out | {s: weight[s] * unit for s in free}
        for s in over:
            out[s] = float(cap * sizes[s])
            left -= out[s]
        free = [s for s in free if s not in out]
    return out


def min_cost_flow(arcs: list[list], source: int, sink: int, n: int) -> list[int]:
    """Flow on each arc [from, to, capacity, cost] of a maximum flow of least cost.

    Shortest distances give potentials; then all flow that fits on arcs of reduced cost 0 is sent at once,
    by blocking flows over levels, before the distances are found anew.  So there is a round for each
    different cost of a path, not for each path.  Integer capacities and non-negative costs.
    """
    to, cap, cost, out = [], [], [], [[] for _ in range(n)]
    for a, b, c, w in arcs:
        for x, y, r, v in ((a, b, c, w), (b, a, 0, -w)):
            out[x].append(len(to))
            to.append(y), cap.append(r), cost.append(v)
    potential = [0] * n
    while True:
        dist, heap, best = [None] * n, [(0, source)], {source: 0}
        while heap:
            d, x = heapq.heappop(heap)
            if dist[x] is not None:
                continue
            dist[x] = d
            for e in out[x]:
                y = to[e]
                if cap[e] and dist[y] is None:
                    far = d + cost[e] + potential[x] - potential[y]
                    if y not in best or far < best[y]:
                        best[y] = far
                        heapq.heappush(heap, (far, y))
        if dist[sink] is None:
            return [cap[2 * i + 1] for i in range(len(arcs))]
        for x in range(n):
            potential[x] += dist[x] if dist[x] is not None else dist[sink]
        while True:
            level = levels(out, to, cap, cost, potential, source, n)
            if level[sink] < 0:
                break
            block(out, to, cap, cost, potential, level, source, sink)


def levels(out, to, cap, cost, potential, source: int, n: int) -> list[int]:
    """Steps from ``source`` over arcs with room and reduced cost 0; -1 where none leads."""
    level = [-1] * n
    level[source] = 0
    front = [source]
    while front:
        ahead = []
        for x in front:
            for e in out[x]:
                y = to[e]
                if cap[e] and level[y] < 0 and cost[e] + potential[x] == potential[y]:
                    level[y] = level[x] + 1
                    ahead.append(y)
        front = ahead
    return level


def block(out, to, cap, cost, potential, level, source: int, sink: int) -> None:
    """Send flow along paths of rising level until each is blocked; an arc that leads nowhere is passed once."""
    at = [0] * len(out)
    path: list[int] = []
    x = source
    while True:
        if x == sink:
            room = min(cap[e] for e in path)
            for e in path:
                cap[e] -= room
                cap[e ^ 1] += room
            full = next(i for i, e in enumerate(path) if not cap[e])  # go on from the first full arc
            x = to[path[full] ^ 1]
            del path[full:]
            continue
        arcs = out[x]
        while at[x] < len(arcs):
            e = arcs[at[x]]
            y = to[e]
            if cap[e] and level[y] == level[x] + 1 and cost[e] + potential[x] == potential[y]:
                break
            at[x] += 1
        if at[x] < len(arcs):
            path.append(e)
            x = y
        elif path:
            x = to[path.pop() ^ 1]
            at[x] += 1
        else:
            return


def route(patterns: dict[tuple, int], wanted: dict, repeats: int = REPEATS) -> dict[tuple, dict]:
    """Words each pattern gives to each of its sources: {pattern: {source: words}}."""
    keys, sources = list(patterns), list(wanted)
    arcs_of = sum(len(p) + repeats for p in keys) + len(sources)
    if arcs_of > MAX_ARCS:
        raise ValueError(f"{arcs_of} arcs; the network holds {MAX_ARCS}: merge rare sources first")
    at = {s: 1 + len(keys) + i for i, s in enumerate(sources)}
    sink = 1 + len(keys) + len(sources)
    arcs = [[0, 1 + i, patterns[p], r * r] for i, p in enumerate(keys) for r in range(repeats)]
    first = len(arcs)
    links = [(p, s) for p in keys for s in p if s in at]
    place = {p: 1 + i for i, p in enumerate(keys)}
    arcs += [[place[p], at[s], repeats * patterns[p], 0] for p, s in links]
    arcs += [[at[s], sink, round(wanted[s]), 0] for s in sources]
    flow = min_cost_flow(arcs, 0, sink, sink + 1)
    out: dict[tuple, dict] = {p: {} for p in keys}
    for (p, s), f in zip(links, flow[first:], strict=False):
        out[p][s] = f
    return out


def place(seed: int) -> tuple[Column, Column]:
    """A document's place in the seeded order, and its slice."""
    h = F.xxhash64(F.lit(seed), "doc_id")
    return h, F.pmod(h, F.lit(SLICES)).cast("int")


def select(rows: DataFrame, quota: dict[str, int], sizes: dict[str, int], seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """``rows`` (pattern, doc_id, size, ...) with ``taken``: words taken, whole documents only; and the rule
    that gives nearly all of it: pattern, passes, room, cut.  A document of up to ``room`` words in a
    slice before ``cut`` is taken once more than ``passes`` times.

    A pattern's quota is some whole passes over its documents and a rest.  For the rest documents
    are taken in the seeded order while they fit; documents that still fit into what is left are
    taken in further rounds, and at last one document more if that comes nearer to the quota.
    """
    spark = rows.sparkSession
    base = {p: quota[p] // sizes[p] if sizes[p] else 0 for p in quota}
    left = {p: quota[p] - base[p] * sizes[p] for p in quota}
    table = lambda d, name: spark.createDataFrame(list(d.items()), f"pattern string, {name} bigint")
    h, slice_ = place(seed)
    rule: list = []
    own = staged(rows.join(F.broadcast(table(base, "passes")), "pattern")  # a row for each pattern: checked in route()
                 .withColumn("h", h).withColumn("slice", slice_)
                 .withColumn("extra", F.lit(0)), "mix")
    for _ in range(FILL_ROUNDS):
        left = {p: v for p, v in left.items() if v > 0}
        if not left:
            break
        bound = F.broadcast(table(left, "room"))
        fits = own.where("extra = 0 AND size > 0").join(bound, "pattern").where("size <= room")
        order = Window.partitionBy("pattern").orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)
        sums = fits.groupBy("pattern", "slice", "room").agg(F.sum("size").alias("words"))
        cut = (sums.withColumn("upto", F.sum("words").over(order)).withColumn("from", F.col("upto") - F.col("words"))
               .where("upto > room").groupBy("pattern").agg(F.min(F.struct("slice", "from")).alias("c"))
               .select("pattern", "c.*").collect())  # a row for each pattern at most
        at = {r["pattern"]: (r["slice"], r["from"]) for r in cut}
        rule = rule or [(p, base[p], left.get(p, 0), at.get(p, (SLICES, 0))[0]) for p in base]
        cuts = spark.createDataFrame([(p, v, *at.get(p, (SLICES, 0))) for p, v in left.items()],
                                     "pattern string, room bigint, cut int, upto bigint")
        marked = own.join(F.broadcast(cuts), "pattern", "left").withColumn(
            "fits", F.coalesce((F.col("extra") == 0) & (F.col("size") > 0) & (F.col("size") <= F.col("room")), F.lit(False)))
        edge = marked.where(F.col("fits") & (F.col("slice") == F.col("cut")))
        running = F.sum("size").over(Window.partitionBy("pattern").orderBy("h", "doc_id", "size").rowsBetween(
            Window.unboundedPreceding, 0))
        edge = edge.withColumn("extra", F.when(running + F.col("upto") <= F.col("room"), 1).otherwise(0))
        rest = marked.where(~(F.col("fits") & F.coalesce(F.col("slice") == F.col("cut"), F.lit(False)))).withColumn(
            "extra", F.when(F.col("fits") & (F.col("slice") < F.col("cut")), 1).otherwise(F.col("extra")))
        before, own = own, staged(edge.unionByName(rest).select(*own.columns), "mix")
        got = {r["pattern"]: r["words"] for r in own.where("extra = 1").groupBy("pattern").agg(
            F.sum("size").alias("words")).collect()}
        now = {p: quota[p] - base[p] * sizes[p] - got.get(p, 0) for p in left}
        if now == left:
            own = before
            break
        left = now
    left = {p: v for p, v in left.items() if v > 0}
    if left:  # one document more where that comes nearer than stopping short
        near = own.where("extra = 0 AND size > 0").join(F.broadcast(table(left, "room")), "pattern").where("size < 2 * room")
        best = near.groupBy("pattern").agg(F.min(F.struct(F.abs(F.col("size") - F.col("room")), "h", "doc_id", "size")).alias("b"))
        one = best.select("pattern", F.col("b.h").alias("bh"), F.col("b.doc_id").alias("bid"), F.col("b.size").alias("bs"))
        hit = F.coalesce((F.col("h") == F.col("bh")) & F.col("doc_id").eqNullSafe(F.col("bid"))
                         & (F.col("size") == F.col("bs")) & (F.col("extra") == 0), F.lit(False))
        # a row for each pattern at most
        own = own.join(F.broadcast(one), "pattern", "left").withColumn("extra", F.when(hit, 1).otherwise(F.col("extra")))
    rule = rule or [(p, base[p], 0, 0) for p in base]
    return own.withColumn("taken", F.col("size") * (F.col("passes") + F.col("extra"))).drop(
        "passes", "extra", "h", "slice", "bh", "bid", "bs"), spark.createDataFrame(
        rule, "pattern string, passes bigint, room bigint, cut int")


def pattern() -> Column:
    return F.to_json(F.struct("sources"), {"ignoreNullFields": "false"})


def mix(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, repeats: int = REPEATS,
        seed: int = SEED) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``docs``: doc_id, size, sources (array of the sources it belongs to), with pattern and taken
    added; the sources: source, source_size, target; and the rule of ``select``.

    Rows of equal id and size share their place in the seeded order and stand for themselves; a
    document of size 0 is never taken; repeated sources of a document count once.  Whole documents
    only, so a source's taken words miss its target by a part of one of its documents.
    """
    rows = docs.withColumn("sources", F.array_sort(F.array_distinct("sources"))).withColumn("pattern", pattern())
    summed = rows.groupBy("pattern").agg(F.sum("size").alias("size"), F.first("sources").alias("sources")).limit(
        MAX_ARCS + 1).collect()  # one more than the network may hold: route() then refuses
    patterns = {r["pattern"]: (tuple(r["sources"]), r["size"]) for r in summed}
    sizes: dict = {}
    for sources, size in patterns.values():
        for s in sources:
            sizes[s] = sizes.get(s, 0) + size
    wanted = targets(sizes, weights, share, repeats)
    flow = route({v[0]: v[1] for v in patterns.values()}, wanted, repeats)
    quota = {p: sum(flow[v[0]].values()) for p, v in patterns.items()}
    mixed, rule = select(rows, quota, {p: v[1] for p, v in patterns.items()}, seed)
    info = docs.sparkSession.createDataFrame(
        [(s, int(sizes[s]), float(wanted[s])) for s in sizes], "source string, source_size bigint, target double")
    return mixed, info, rule


def mixed_documents(documents: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target, taken of every row."""
    return _mixed_documents(documents)[0]


def _mixed_documents(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    # the texts are read once; everything after works on this narrow table
    docs = staged(documents.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    mixed, sources, rule = mix(docs.withColumn("sources", F.array("source")))
    sources = sources.withColumnRenamed("source", "of")
    # a row for each source, no more than the network holds
    return mixed.join(F.broadcast(sources), F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "source", "size", "source_size", "target", "taken"), rule


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of documents with its source's size and target and the words taken of it; null and
    blank texts have size 0; null is a source of its own, the last; an empty table gives an empty
    result; other columns are ignored."""
    return mixed_documents(read(spark, sf_dir, "documents")).drop("source")


def _usual(rows: DataFrame, rule: DataFrame, source: str, size: str, seed: int = SEED) -> DataFrame:
    """``rows`` with ``_usual``: how often the rule of ``select`` takes each."""
    ruled = rows.withColumn("sources", F.array(source)).withColumn("_pattern", pattern()).drop("sources").join(
        F.broadcast(rule), F.col("_pattern") == F.col("pattern"))  # a row for each pattern: checked in route()
    once_more = (F.col(size) <= F.col("room")) & (place(seed)[1] < F.col("cut"))
    return ruled.withColumn("_usual", F.when(F.col(size) > 0, F.col("passes") + once_more.cast("int")).otherwise(0)).drop(
        "_pattern", "pattern", "passes", "room", "cut")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix itself: a row for each time a document is taken.

    Texts are not shuffled.  How often nearly every document is taken follows from its source, its size and
    its place in the seeded order, by a rule that is broadcast; the others, those of one slice a source and
    those that filled up what was left, are joined by their ids.
    """
    docs = docs.select(*DOC_COLUMNS)
    mixed, rule = _mixed_documents(docs)
    times = F.when(F.col("size") > 0, (F.col("taken") / F.col("size")).cast("int")).otherwise(0).alias("_times")
    taken = _usual(mixed.select("doc_id", "source", "size", times), rule, "source", "size")
    # repeated rows of one id, source and size are one document here: each is taken as often
    others = staged(taken.groupBy(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size")).agg(
        F.sum("_times").alias("_sum"), F.count("*").alias("_rows"), F.first("_usual").alias("_usual")).withColumn(
        "_times", F.ceil(F.col("_sum") / F.col("_rows"))).where("_times <> _usual").select("_id", "_source", "_size", "_times"), "others")
    own = _usual(docs.withColumn("_words", word_count(F.col("text"))), rule, "source", "_words")
    same = (F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_source"))
            & (F.col("_words") == F.col("_size")))
    # about a row in SLICES, and those of the later rounds
    joined = own.join(F.broadcast(others), same, "left").withColumn("_n", F.coalesce("_times", "_usual").cast("int"))
    return joined.where("_n > 0").withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("_n")))).select(*DOC_COLUMNS)
