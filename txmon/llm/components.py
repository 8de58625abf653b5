"""Connected components of a distributed edge list by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txmon.llm.common import staged, tasks_for

#: Edges in one task.
EDGES = 50_000


def _least(edges: DataFrame, tasks: int) -> DataFrame:
    """(u, v, m) of every edge u-v, m the least of u and its neighbours; written minima, so that the
    join has two plain exchanges and a hot node's edges can be split."""
    least = staged(edges.groupBy("u").agg(F.min("v").alias("m")), "least", tasks)
    return edges.join(least, "u").withColumn("m", F.least("u", "m"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): every node of ``edges`` (a, b) with the least node it reaches.

    Runs until nothing changes; the number of rounds grows with the logarithm of the longest path.
    """
    tasks = tasks_for(2 * edges.count(), EDGES)
    links = staged(edges.where("a <> b").select(F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u")).distinct(), "links", tasks)
    before = None
    while True:
        both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = staged(_least(both, tasks).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large", tasks)
        near = _least(large, tasks)  # here every neighbour v is smaller than u
        links = staged(near.select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .unionByName(near.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "links", tasks)
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = now
