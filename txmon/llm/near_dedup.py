"""MinHash near-deduplication with an LSH forest.

Texts become sets of five-word shingles; equal sets are one class from the start.  Every class has
``TREES`` signature orders of ``DEPTH`` minhashes.  The classes below a forest node share a prefix of
an order.  Links are confirmed on full shingle sets, in two rounds:

1. at the first depth each node proposes the strongest spanning links among its classes (by signature
   agreement); a node of more than ``NODE`` classes is read as chunks of neighbours in the sorted
   order.  The confirmed links are joined into components;
2. a node of one component can add nothing and is left.  In the others every pair that may be similar
   enough and whose classes are in different components is put to the test: small nodes at once; large
   ones with few classes outside their main component by blocks, those classes against all; the rest
   one minhash deeper, where they fall apart into smaller nodes, down to full depth, where blocks
   compare what is still large.  Nothing is dropped.

A longer prefix is shared in fewer orders: classes that are read deeper get more orders, as many as
keep the miss rate at each depth below ``MISS``.  As links come first, a group of near copies, however
large, is one component by then and is not read deeper: it costs about its size in links and rows,
while a pair in two components is always put to the test.  A pair just similar enough shares no node
of the forest with a probability of at most ``MISS`` in sparse regions (2e-7 at 85 %, 8e-8 at 80 %)
and in dense ones.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txmon.llm.common import DOC_COLUMNS, read, staged, tasks_for, without_ids
from txmon.llm.components import components

SHINGLE = 5
PERCENT = 85  # of op4
STAGE_PERCENT = 80  # of the pipeline
TREES, DEPTH = 16, 8
#: Highest probability that a pair just similar enough shares no forest node (for 58 % and more).
MISS = 1e-6
NODE = 256
BLOCK = 512
#: Rows in one task: of ids alone, of ids with signatures, of pairs or ids with full sets.
NARROW, SIGNED, FULL = 50_000, 10_000, 2_000
#: Of 128 minhashes, pairs agreeing so many standard deviations below the threshold are not tested.
DEVIATIONS = 4.75
_rng = np.random.default_rng(23)
_A = _rng.integers(1 << 20, 1 << 32, TREES * DEPTH, np.uint32) | np.uint32(1)
_B = _rng.integers(0, 1 << 32, TREES * DEPTH, np.uint32)
_PLACE = _rng.integers(1, 1 << 63, SHINGLE, np.uint64) | np.uint64(1)
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_BLANK = str.maketrans("\t\n\x0b\x0c\r", "     ")


class _Words(dict):
    """64-bit hashes of words, a bounded number of them kept."""

    def __missing__(self, word: str) -> int:
        h = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        if len(self) < 50_000:
            self[word] = h
        return h


_words = _Words()


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_set(text: str | None, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles; fewer words are one shingle, none are none."""
    words = [w for w in (text or "").translate(_LOWER).translate(_BLANK).split(" ") if w]
    if not words:
        return np.zeros(0, np.uint64)
    h = np.array(list(map(_words.__getitem__, words)), np.uint64)
    if len(h) < k:
        place = np.arange(1, len(h) + 1, dtype=np.uint64)
        return _mix(np.array([(h * _mix(place * _PLACE[0])).sum(dtype=np.uint64) + np.uint64(len(h))], np.uint64))
    n = len(h) - k + 1
    total = np.zeros(n, np.uint64)
    for i in range(k):  # h * place, place odd and different for each position
        total += h[i:i + n] * (_PLACE[i % SHINGLE] + np.uint64(2 * (i // SHINGLE)))
    return np.unique(_mix(total))


def trees_at(depth: int, percent: int) -> int:
    """Orders in which a pair just similar enough shares a prefix of this depth once, but for MISS."""
    return math.ceil(math.log(MISS) / math.log1p(-min(percent / 100, 0.999999) ** depth))


def first_depth(percent: int) -> int:
    return max([d for d in range(1, DEPTH + 1) if trees_at(d, percent) <= TREES], default=1)


def may_link(percent: int) -> float:
    """The estimated similarity from which a pair is tested."""
    p = percent / 100
    return p - DEVIATIONS * math.sqrt(p * (1 - p) / (TREES * DEPTH))


def more_hashes(percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors and summands of the minhashes of the orders beyond TREES."""
    n = max(trees_at(DEPTH, percent) - TREES, 0) * DEPTH
    rng = np.random.default_rng(29)
    return rng.integers(1 << 20, 1 << 32, n, np.uint32) | np.uint32(1), rng.integers(0, 1 << 32, n, np.uint32)


def signature(s: np.ndarray, a: np.ndarray = _A, b: np.ndarray = _B) -> np.ndarray:
    """Minhashes of a non-empty set, TREES x DEPTH unless others are given."""
    x = (s >> np.uint64(32)).astype(np.uint32)
    best = np.full(len(a), 0xFFFFFFFF, np.uint32)
    step = max(2048 * len(_A) // max(len(a), 1), 1)
    for at in range(0, len(x), step):
        part = x[at:at + step]
        h = part[None, :] * a[:, None]
        h += b[:, None]
        np.minimum(best, h.min(axis=1), out=best)
    return best


def signed(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n_shingles, set_key (128 bits, null for no words), minhashes (TREES x DEPTH x 4 bytes)."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                s = shingle_set(text, k)
                out.append((doc_id, len(s), xxhash.xxh3_128_digest(s.tobytes()), signature(s).tobytes())
                           if len(s) else (doc_id, 0, None, None))
            yield pd.DataFrame(out, columns=["doc_id", "n_shingles", "set_key", "minhashes"]).astype({"doc_id": "Int64"})

    return docs.select("doc_id", "text").mapInPandas(
        sign, "doc_id bigint, n_shingles bigint, set_key binary, minhashes binary")


def _node(depth: int):
    """The forest node at ``depth`` of one order: a hash of the order and the shared prefix."""
    return F.xxhash64("tree", F.substring("path", 1, 4 * depth))


def more_trees(dense: DataFrame, docs: DataFrame, k: int, percent: int, first: int) -> DataFrame:
    """cls, tree, path, start of the orders beyond TREES for the classes ``dense``: at each depth from
    ``start`` there are as many orders as trees_at asks for."""
    a, b = more_hashes(percent)
    starts = [next(d for d in range(first, DEPTH + 1) if trees_at(d, percent) > t)
              for t in range(TREES, TREES + len(a) // DEPTH)]

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"cls": batch["cls"], "minhashes": [
                signature(np.frombuffer(x, np.uint64), a, b).tobytes() for x in batch["s"]]})

    size = 4 * DEPTH
    orders = F.explode(F.array(*[F.struct(
        F.lit(TREES + i).alias("tree"), F.lit(start).alias("start"), F.substring("minhashes", i * size + 1, size).alias("path"))
        for i, start in enumerate(starts)]))
    signed_ = full_sets(docs, dense.select(F.col("cls").alias("doc_id")), dense.count(), k).withColumnRenamed("doc_id", "cls").mapInPandas(
        sign, "cls bigint, minhashes binary")
    return staged(signed_.select("cls", orders.alias("o")).select("cls", "o.tree", "o.path", "o.start"), "more_trees")


def company(nodes: DataFrame, n: int) -> tuple[DataFrame, DataFrame | None]:
    """Of ``nodes`` (``n`` rows cls, tree, path, at) those of two classes or more: the different sets of classes
    below the small ones (g, cls), whatever orders they stand in, and the members of the large ones, if any.
    Only ids and nodes are shuffled, paths are read again for the members of large nodes."""
    counts = staged(nodes.groupBy("at").agg(F.count("*").alias("size")).where("size > 1"), "counts", tasks_for(n, NARROW))
    sets = nodes.select("cls", "at").join(counts.where(F.col("size") <= NODE).select("at"), "at").groupBy("at").agg(
        F.sort_array(F.collect_list("cls")).alias("ids")).select("ids").distinct()
    groups = staged(sets.select(F.xxhash64("ids").alias("g"), F.explode("ids").alias("cls")), "groups", tasks_for(n, NARROW))
    large = counts.where(F.col("size") > NODE).select("at")
    if large.isEmpty():
        return groups, None
    return groups, staged(nodes.join(F.broadcast(large), "at"), "large")  # at most classes x orders / NODE nodes


def mixture(named: DataFrame) -> DataFrame:
    """at, main (the largest component), n and apart (classes outside it) of nodes of two components
    or more."""
    counts = named.groupBy("at", "component").count()
    return staged(counts.groupBy("at").agg(F.max(F.struct("count", "component")).alias("m"), F.sum("count").alias("n"))
                  .select("at", F.col("m.component").alias("main"), "n", (F.col("n") - F.col("m.count")).alias("apart"))
                  .where("apart > 0"), "mixture")


def _agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated similarity of rows of one-byte signatures; chance agreement of bytes taken out."""
    same = np.empty((len(a), len(b)), np.float32)
    for i in range(len(a)):
        same[i] = (a[i] == b).sum(axis=1)
    return (same / a.shape[1] - 1 / 256) / (1 - 1 / 256)


def _spanning(ids: np.ndarray, sig: np.ndarray, bound: float) -> list[tuple[int, int]]:
    """The strongest links that may be similar enough and join what they can (a maximum forest)."""
    est = np.triu(_agreement(sig, sig), 1)
    i, j = np.nonzero(est >= bound)
    root, out = list(range(len(ids))), []

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for e in np.lexsort((ids[j], ids[i], -est[i, j])):
        a, b = find(int(i[e])), find(int(j[e]))
        if a != b:
            root[a] = b
            out.append((int(ids[i[e]]), int(ids[j[e]])))
            if len(out) == len(ids) - 1:
                break
    return out


def _frame(pairs: list[tuple[int, int]]) -> pd.DataFrame:
    return pd.DataFrame(pairs, columns=["a", "b"], dtype="int64")


def _runs(batches: Iterator[pd.DataFrame], key: list[str]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Frames of whole groups, from rows that come sorted by ``key``, and where each group begins."""
    rest = None
    for batch in batches:
        rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        k = rows[key].to_numpy()
        starts = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]).any(axis=1)]) if len(k) else np.zeros(0, int)
        if len(starts) > 1:
            yield rows.iloc[:starts[-1]], starts[:-1]
            rows = rows.iloc[starts[-1]:]
        rest = rows
    if rest is not None and len(rest):
        yield rest, np.zeros(1, int)


def _signatures(rows: pd.DataFrame) -> np.ndarray:
    return np.frombuffer(b"".join(rows["short"]), np.uint8).reshape(len(rows), -1)


def _pairs_in(rows: pd.DataFrame, starts: np.ndarray, bound: float) -> Iterator[pd.DataFrame]:
    """Groups of two at once, larger ones by their strongest links."""
    ids, sig = rows["cls"].to_numpy(), _signatures(rows)
    ends = np.r_[starts[1:], len(rows)]
    two = starts[ends - starts == 2]
    est = ((sig[two] == sig[two + 1]).mean(axis=1) - 1 / 256) / (1 - 1 / 256)
    ok = two[est >= bound]
    out = [(int(ids[i]), int(ids[i + 1])) for i in ok if ids[i] != ids[i + 1]]
    for s, e in zip(starts, ends, strict=True):
        if e - s > 2:
            out += _spanning(ids[s:e], sig[s:e], bound)
    yield _frame([(min(p), max(p)) for p in out])


def strongest(batches: Iterator[pd.DataFrame], bound: float) -> Iterator[pd.DataFrame]:
    for rows, starts in _runs(batches, ["g"]):
        yield from _pairs_in(rows, starts, bound)


def neighbours(batches: Iterator[pd.DataFrame], bound: float) -> Iterator[pd.DataFrame]:
    """The same over chunks of neighbours in the sorted order; a chunk begins with the last rows of the
    one before."""
    rest = None
    for batch in batches:
        rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        for at in range(0, len(rows), NODE - 32):
            part = rows.iloc[at:at + NODE]
            yield _frame([(min(p), max(p)) for p in _spanning(part["cls"].to_numpy(), _signatures(part), bound)])
        rest = rows.iloc[-32:]


def _may_cross(sig: np.ndarray, comp: np.ndarray, one: np.ndarray, two: np.ndarray, bound: float) -> np.ndarray:
    """Rows ``one`` x rows ``two``: in different components, and may be similar enough."""
    return (_agreement(sig[one], sig[two]) >= bound) & (comp[one][:, None] != comp[two][None, :])


def _sides(rows: pd.DataFrame, s: int, e: int) -> tuple[np.ndarray, np.ndarray]:
    asks = rows["asks"].to_numpy()[s:e]
    return np.flatnonzero(asks != 0), np.flatnonzero(asks != 1)


def worth_testing(batches: Iterator[pd.DataFrame], bound: float) -> Iterator[pd.DataFrame]:
    """The rows of each group that have a pair to be tested; groups of one component cost nothing."""
    for rows, starts in _runs(batches, ["g"]):
        comp, ends = rows["component"].to_numpy(), np.r_[starts[1:], len(rows)]
        low, high = np.minimum.reduceat(comp, starts), np.maximum.reduceat(comp, starts)
        mixed = np.flatnonzero(low != high)
        keep = np.zeros(len(rows), bool)
        if len(mixed):
            sig = _signatures(rows)
            for k in mixed:
                s, e = starts[k], ends[k]
                one, two = _sides(rows, s, e)
                for at in range(0, len(one), 256):
                    part = one[at:at + 256]
                    ok = _may_cross(sig[s:e], comp[s:e], part, two, bound)
                    keep[s + part[ok.any(axis=1)]] = True
                    keep[s + two[ok.any(axis=0)]] = True
        yield rows[keep]


def _shared(x: np.ndarray, y: np.ndarray) -> int:
    """Common values of two sorted sets."""
    if len(x) > len(y):
        x, y = y, x
    return int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())


def tested(batches: Iterator[pd.DataFrame], percent: int) -> Iterator[pd.DataFrame]:
    """Confirmed links that join different components, one for each two that a group joins.  All pairs
    that may be similar enough are tested on their full sets until a link has joined their components."""
    for rows, starts in _runs(batches, ["g"]):
        ids, comp, sig = rows["cls"].to_numpy(), rows["component"].to_numpy(), _signatures(rows)
        ends, out = np.r_[starts[1:], len(rows)], []
        for s, e in zip(starts, ends, strict=True):
            sets = [np.frombuffer(x, np.uint64) for x in rows["s"].iloc[s:e]]
            c, root = comp[s:e], {}

            def find(x: int, root=root) -> int:
                while root.get(x, x) != x:
                    x = root[x]
                return x

            one, two = _sides(rows, s, e)
            for at in range(0, len(one), 256):
                part = one[at:at + 256]
                for i, j in zip(*np.nonzero(_may_cross(sig[s:e], c, part, two, may_link(percent))), strict=True):
                    i, j = int(part[i]), int(two[j])
                    a, b = find(int(c[i])), find(int(c[j]))
                    n, m = len(sets[i]), len(sets[j])
                    if a == b or 100 * min(n, m) < percent * max(n, m):
                        continue
                    both = _shared(sets[i], sets[j])
                    if 100 * both >= percent * (n + m - both):
                        root[max(a, b)] = min(a, b)
                        out.append((int(min(ids[s + i], ids[s + j])), int(max(ids[s + i], ids[s + j]))))
        yield _frame(out)


def large_nodes(rows: DataFrame) -> DataFrame:
    """Large nodes (rows with main, n, apart) in groups: every row outside the node's largest component
    meets every row, block by block."""
    blocks = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    block = lambda n: F.pmod(F.xxhash64("cls"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    na, nb = blocks("apart"), blocks("n")
    asking = rows.where("component <> main").withColumn("i", block(na)).withColumn("j", every(nb))
    all_ = rows.withColumn("j", block(nb)).withColumn("i", every(na))
    cols = [F.xxhash64("at", "i", "j").alias("g"), "cls", "component", "short"]
    return asking.select(*cols, F.lit(1).alias("asks")).unionByName(all_.select(*cols, F.lit(0).alias("asks")))


def _by_group(groups: DataFrame, n: int | None, each: int, *order: str) -> DataFrame:
    """``groups`` whole and sorted; ``n``: their rows, if known, of which a task then takes ``each``."""
    dealt = groups.repartition("g")
    return (dealt if n is None else dealt.coalesce(tasks_for(n, each))).sortWithinPartitions("g", *order)


def joining_links(groups: DataFrame, n: int | None, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Round 2 over groups (g, cls, component, short, asks) of bounded size; ``n``: their rows, if known."""
    worth = staged(_by_group(groups, n, SIGNED, "cls", "asks").mapInPandas(
        lambda batches: worth_testing(batches, may_link(percent)), groups.schema), "worth")
    n = worth.count()
    sets = full_sets(docs, worth.select(F.col("cls").alias("doc_id")).distinct(), n, k)
    return _by_group(worth.join(sets, F.col("cls") == F.col("doc_id")), n, FULL, "cls", "asks").mapInPandas(
        lambda batches: tested(batches, percent), "a bigint, b bigint")


def full_sets(docs: DataFrame, asked: DataFrame, n: int, k: int) -> DataFrame:
    """doc_id, s (sorted 64-bit shingle hashes) of the documents asked for, at most ``n``."""

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "s": [shingle_set(t, k).tobytes() for t in batch["text"]]})

    asked = staged(asked, "asked", tasks_for(n, NARROW))
    out = staged(docs.select("doc_id", "text").join(asked, "doc_id", "left_semi").mapInPandas(
        sets, "doc_id bigint, s binary"), "sets")
    # ids alone tell whether some come twice; only then the sets are shuffled for it
    twice = out.groupBy("doc_id").count().where("count > 1")
    return out if twice.isEmpty() else staged(out.dropDuplicates(["doc_id"]), "sets")


def confirmed(pairs: DataFrame, most: int, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b), ``most`` at most, of class representatives whose full sets are similar enough."""
    pairs = staged(pairs.distinct(), "pairs", tasks_for(most, NARROW))
    n = pairs.count()
    sets = full_sets(docs, pairs.select(F.col("a").alias("doc_id")).unionByName(
        pairs.select(F.col("b").alias("doc_id"))).distinct(), 2 * n, k)
    joined = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("s").alias("x")), "a").join(
        sets.select(F.col("doc_id").alias("b"), F.col("s").alias("y")), "b")

    def test(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ok = []
            for x, y in zip(batch["x"], batch["y"], strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = _shared(x, y)
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.loc[np.array(ok, bool), ["a", "b"]]

    return staged(joined.mapInPandas(test, "a bigint, b bigint"), "confirmed", tasks_for(n, FULL))


def class_components(classes: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """(node, component) of every class (cls, minhashes) that has a link."""
    size, depth, bound = 4 * DEPTH, first_depth(percent), may_link(percent)
    orders = F.explode(F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.struct(
        t.alias("tree"), F.substring(F.col("minhashes"), t * size + 1, F.lit(size)).alias("path"))))
    # one byte a minhash is enough to tell how far two signatures agree
    short = F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(TREES * DEPTH - 1)), lambda i: F.hex(
        F.substring(F.col("minhashes"), i * 4 + 1, F.lit(1)))), ""))
    shorts = classes.select("cls", short.alias("short"))
    nodes = classes.select("cls", orders.alias("o")).select("cls", "o.tree", "o.path").withColumn("at", _node(depth))
    groups, large = company(nodes, TREES * classes.count())
    n = groups.count()

    # round 1: strongest links; neighbours in the sorted order where a node is large
    pair, order = "a bigint, b bigint", ["at", "path", "cls"]
    first = _by_group(groups.join(shorts, "cls"), n, SIGNED, "cls").mapInPandas(lambda batches: strongest(batches, bound), pair)
    if large is not None:
        first = first.unionByName(large.join(shorts, "cls").repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(
            lambda batches: neighbours(batches, bound), pair))
    most = n + (0 if large is None else 2 * large.count())  # a spanning forest has fewer links than rows
    links = confirmed(first, most, docs, k, percent)
    joins = links.count()
    found = staged(components(links), "found", tasks_for(joins, NARROW))

    # round 2: what is still apart, from depth to depth
    label = lambda df: df.join(found, F.col("cls") == F.col("node"), "left").withColumn(
        "component", F.coalesce("component", "cls")).drop("node")
    more = None
    while True:
        named = label(groups)
        apart = named.groupBy("g").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("g")
        asking = staged(named.join(apart, "g"), "mixed", tasks_for(n, NARROW))
        rows = asking.count()
        asking = asking.join(shorts, "cls").select("g", "cls", "component", "short", F.lit(-1).alias("asks"))
        mixed, direct = None, None
        if large is not None:
            mixed = staged(label(large).join(mixture(label(large)), "at"), "mixed")
            deeper = (F.col("apart") > BLOCK) & F.lit(depth < DEPTH)
            direct = mixed.where(~deeper)
            direct = None if direct.isEmpty() else large_nodes(direct.join(shorts, "cls"))
        if rows or direct is not None:
            joined = joining_links(asking if direct is None else asking.unionByName(direct),
                                   rows if direct is None else None, docs, k, percent)
            joined = staged(joined, "joined")
            if not joined.isEmpty():
                links = staged(links.unionByName(joined), "links")
                joins = links.count()
                found = staged(components(links), "found", tasks_for(joins, NARROW))
        if mixed is None:
            return found
        left = mixed.where(deeper).select("cls", "tree", "at", "path")
        if left.isEmpty():
            return found
        left = label(left)
        left = staged(left.join(mixture(left).select("at"), "at"), "left")
        if left.isEmpty():
            return found
        dense = staged(left.select("cls").distinct(), "dense")
        depth += 1
        if more is None:  # all classes of the large nodes, so that both sides of a pair have them
            more = more_trees(dense, docs, k, percent, depth)
        nodes = staged(left.select("cls", "tree", "path").unionByName(
            more.where(F.col("start") == depth).join(dense, "cls").select("cls", "tree", "path")).withColumn(
            "at", _node(depth)), "nodes")
        groups, large = company(nodes, nodes.count())
        n = groups.count()


def near_dedup(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs`` (doc_id, text).

    Words are split at blanks and the controls 9 to 13 and A-Z lower-cased; a text of fewer than k
    words is one shingle; null texts and texts without words are linked with nothing.  Rows with a
    null id are components of their own (component_id null, kept).  Rows that repeat an id with the
    same words are one document; an empty table gives an empty result; other columns are ignored.
    """
    rows = staged(signed(docs, k), "signed")
    live = rows.where("set_key IS NOT NULL AND doc_id IS NOT NULL")
    classes = staged(live.groupBy("set_key").agg(F.min("doc_id").alias("cls"), F.first("minhashes").alias("minhashes")),
                     "classes", tasks_for(rows.count(), SIGNED))
    # a class for each id: signatures are shuffled for it only where rows of different words share one
    one = classes if classes.groupBy("cls").count().where("count > 1").isEmpty() else staged(
        classes.dropDuplicates(["cls"]), "classes")
    final = class_components(one, docs, k, percent)

    named = staged(classes.select("set_key", "cls").join(final, F.col("cls") == F.col("node"), "left").select(
        "set_key", F.coalesce("component", "cls").alias("component_id")), "named", tasks_for(classes.count(), NARROW))
    lone = rows.where("set_key IS NULL OR doc_id IS NULL").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    linked = live.select("doc_id", "n_shingles", "set_key").join(named, "set_key").select(
        "doc_id", "n_shingles", "component_id")
    return linked.unionByName(lone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(read(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group stays; documents in no group stay, and rows with
    a null id.  Rows that repeat an id are one document; an empty table gives an empty one."""
    docs = docs.select(*DOC_COLUMNS)
    return without_ids(docs, near_dedup(docs, percent=STAGE_PERCENT).where("NOT kept"))
