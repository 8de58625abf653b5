"""Approximate nearest neighbours by cosine: multiprobe p-stable hashing with exact reranking.

Vectors are scaled to length one; in each of ``TABLES`` tables, ``HASHES`` Gaussian projections cut
into cells of ``WIDTH`` name a bucket.  A query visits its own bucket and ``PROBES`` perturbed ones in
the order of their estimated success (the sum of squared distances to the cell walls crossed).
Buckets are compared block by block: index blocks of at most ``INDEX_BLOCK`` rows meet query blocks
of at most ``QUERY_BLOCK``, so no bucket, however full, lands in one task, and each block pair returns
its own nearest rows only.  Scores are computed in double precision on the original vectors.

A query that finds fewer rows than it could (few rows, or none near it) is compared with all rows, in
the same blocks.

Equal vectors would fill one bucket: of each distinct vector only the smallest ``k + 1`` ids are
indexed, which is exact, as no query can return more of them.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txmon.llm.common import read, staged

TABLES, HASHES, WIDTH, PROBES, SEED = 5, 5, 1.5, 80, 7
INDEX_BLOCK, QUERY_BLOCK = 4096, 1024


class Hashes:
    def __init__(self, dim: int, tables: int, hashes: int, width: float, seed: int):
        rng = np.random.default_rng(seed)
        self.a = rng.standard_normal((tables, dim, hashes))
        self.b = rng.uniform(0, width, (tables, hashes))
        self.width = width

    def cells(self, x: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each table: its number, the cells, and the places within them (0 to 1)."""
        for t in range(len(self.a)):
            f = (x @ self.a[t] + self.b[t]) / self.width
            cell = np.floor(f)
            yield t, cell.astype(np.int64), f - cell


def bucket_key(cell: np.ndarray) -> np.ndarray:
    """Cells of rows as one number each, 12 bits a cell; far cells share the outermost."""
    key = np.zeros(len(cell), np.int64)
    for c in np.clip(cell, -2048, 2047).T:
        key = key * 4096 + (c + 2048)
    return key


def perturbations(place: np.ndarray, probes: int) -> list[np.ndarray]:
    """The first ``probes`` sets of steps to neighbouring cells, likeliest first."""
    m = len(place)
    steps = sorted([(place[i] ** 2, i, -1) for i in range(m)] + [((1 - place[i]) ** 2, i, 1) for i in range(m)])
    heap, out = [(steps[0][0], (0,))], []
    while heap and len(out) < probes:
        cost, chosen = heapq.heappop(heap)
        if len({steps[j][1] for j in chosen}) == len(chosen):
            d = np.zeros(m, np.int64)
            for j in chosen:
                d[steps[j][1]] = steps[j][2]
            out.append(d)
        last = chosen[-1]
        if last + 1 < 2 * m:
            heapq.heappush(heap, (cost + steps[last + 1][0], (*chosen, last + 1)))
            heapq.heappush(heap, (cost - steps[last][0] + steps[last + 1][0], (*chosen[:-1], last + 1)))
    return out


def usable(vectors: DataFrame) -> DataFrame:
    """(id, vector) rows that take part: no null id, no null, zero, empty or non-finite vector, and
    of the commonest dimension (the smaller of equals); repeated rows count once."""
    ok = vectors.where("vec_id IS NOT NULL AND embedding IS NOT NULL AND size(embedding) > 0 AND "
                       "forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) <= 3.4028235e38) AND "
                       "exists(embedding, x -> x <> 0)").select("vec_id", "embedding")
    dims = ok.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return ok.where(F.size("embedding") == (dims[0]["d"] if dims else 0))


def search(vectors: DataFrame, is_query: str, k: int = 5, tables: int = TABLES, hashes: int = HASHES,
           width: float = WIDTH, probes: int = PROBES, seed: int = SEED) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest of every row for which ``is_query`` (SQL) holds.

    Ties go to the smaller vec_id; a query never finds a row of its own id; fewer rows return only
    where the table has fewer.  Repeated rows count once; an empty table gives an empty result; other
    columns are ignored.
    """
    good = staged(usable(vectors), "vectors")
    first = good.limit(1).collect()
    dim = len(first[0]["embedding"]) if first else 1
    maker = Hashes(dim, tables, hashes, width, seed)

    def unit(batch: pd.DataFrame) -> np.ndarray:
        x = np.stack(batch["embedding"].to_numpy()).astype(np.float64)
        return x / np.sqrt((x * x).sum(axis=1))[:, None]

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                for t, cell, _ in maker.cells(unit(batch)):
                    yield pd.DataFrame({"t": np.int32(t), "bucket": bucket_key(cell), "vec_id": batch["vec_id"],
                                        "embedding": batch["embedding"]})

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            ids, vectors = batch["vec_id"].to_numpy(), batch["embedding"].to_numpy()
            for t, cell, place in maker.cells(unit(batch)):
                for i in range(len(batch)):
                    visits = np.stack([cell[i]] + [cell[i] + d for d in perturbations(place[i], probes)])
                    keys = np.unique(bucket_key(visits))
                    yield pd.DataFrame({"t": np.int32(t), "bucket": keys, "query_id": ids[i],
                                        "query": [vectors[i]] * len(keys)})

    def nearest(a: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(a) and len(q):
            a = a.sort_values("vec_id")
            ids = a["vec_id"].to_numpy()
            x = np.stack(a["embedding"].to_numpy()).astype(np.float64)
            length = np.sqrt((x * x).sum(axis=1))
            for query_id, y in zip(q["query_id"], q["query"], strict=True):
                y = np.asarray(y, np.float64)
                rough = (x @ y) / length
                rough[ids == query_id] = -np.inf
                top = np.argpartition(-rough, k - 1)[:k] if len(ids) > k else np.arange(len(ids))
                # scores near the last one are computed again, row by row, so that ties are exact
                near = np.flatnonzero((rough >= rough[top].min() - 1e-9 * np.sqrt((y * y).sum())) & (ids != query_id))
                exact = (x[near] * y).sum(axis=1) / (length[near] * np.sqrt((y * y).sum()))
                order = np.lexsort((ids[near], -exact))[:k]
                out += [(query_id, int(ids[near[o]]), float(exact[o])) for o in order]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    blocks = lambda df, n, name: df.groupBy("t", "bucket").agg(
        F.ceil(F.count("*") / n).cast("int").alias(name))

    def compared(rows: DataFrame, asked: DataFrame, before: DataFrame | None = None) -> DataFrame:
        """query_id, vec_id, score, rank: the k nearest among rows of the same bucket and those of ``before``."""
        # blocks of either side of each bucket that both sides touch; a table of buckets, not of rows
        plan = staged(blocks(rows, INDEX_BLOCK, "ni").join(blocks(asked, QUERY_BLOCK, "nq"), ["t", "bucket"]), "blocks")
        dealt = lambda df, key, own, n, other, m: df.join(plan, ["t", "bucket"]).withColumn(
            own, F.pmod(F.xxhash64(key), n).cast("int")).withColumn(other, F.explode(F.sequence(F.lit(0), F.col(m) - 1)))
        left = dealt(rows, "vec_id", "i", F.col("ni"), "j", "nq").select("t", "bucket", "i", "j", "vec_id", "embedding")
        right = dealt(asked, "query_id", "j", F.col("nq"), "i", "ni").select("t", "bucket", "i", "j", "query_id", "query")
        key = ["t", "bucket", "i", "j"]
        found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(
            nearest, "query_id bigint, vec_id bigint, score double")
        if before is not None:
            found = found.unionByName(before.drop("rank"))
        merged = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))  # one pair from several tables
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        return merged.withColumn("rank", rank).where(F.col("rank") <= k)

    nth = F.dense_rank().over(Window.partitionBy("embedding").orderBy("vec_id"))
    indexed = good.withColumn("nth", nth).where(F.col("nth") <= k + 1).dropDuplicates(["vec_id", "embedding"]).select(
        "vec_id", "embedding")
    queries = good.where(is_query).dropDuplicates(["vec_id", "embedding"])
    rows = staged(indexed.mapInPandas(index, "t int, bucket bigint, vec_id bigint, embedding array<float>"), "index")
    asked = staged(queries.mapInPandas(probe, "t int, bucket bigint, query_id bigint, query array<float>"), "probes")
    got = staged(compared(rows, asked), "found")

    want = min(k, good.select("vec_id").distinct().count() - 1)
    enough = got.groupBy("query_id").count().where(F.col("count") >= want).select(F.col("query_id").alias("vec_id"))
    short = queries.join(enough, "vec_id", "left_anti") if want > 0 else queries.limit(0)
    short = staged(short.select(F.lit(0).alias("t"), F.lit(0).cast("bigint").alias("bucket"),
                                F.col("vec_id").alias("query_id"), F.col("embedding").alias("query")), "short")
    if not short.isEmpty():
        every = rows.where("t = 0").withColumn("bucket", F.lit(0).cast("bigint"))
        got = compared(every, short, got)
    return got.select("query_id", "rank", "vec_id", "score")


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read(spark, sf_dir, "embeddings"), "vec_id % 50 = 0")
