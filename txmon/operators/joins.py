"""Join helpers: size-checked broadcast, and the time-band self-join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Spark's own default limit: the estimate is of compressed files, so a hint never goes beyond it.
DEFAULT_BROADCAST_BYTES = 10 * 1024 * 1024


def plan_size_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimized plan (from file statistics; no job runs)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``df`` only when its estimated size is within ``max_bytes``.

    Above the bound nothing is hinted: the planner keeps a shuffle join, and
    AQE may still switch to a broadcast once it has measured the real size.
    """
    return F.broadcast(df) if plan_size_bytes(df) <= max_bytes else df


def time_band_self_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    l_us: str,
    r_us: str,
    max_gap_us: int,
    min_gap_exclusive: bool = True,
) -> DataFrame:
    """Pairs with equal ``keys`` and ``0 < r_us - l_us <= max_gap_us``.

    The equi-key is extended by a time bucket of width ``max_gap_us``: the left
    side is probed in its own bucket and the next one, so a hot key is split
    into many small join groups instead of one quadratic one.  Every pair is
    kept (no cap).
    """
    lb = left.withColumn("_tb", F.floor(F.col(l_us) / F.lit(max_gap_us)).cast("bigint"))
    lb = lb.withColumn("_tb", F.explode(F.array(F.col("_tb"), F.col("_tb") + 1)))
    rb = right.withColumn("_tb", F.floor(F.col(r_us) / F.lit(max_gap_us)).cast("bigint"))
    cond = [lb[k] == rb[k] for k in keys] + [lb["_tb"] == rb["_tb"]]
    gap = rb[r_us] - lb[l_us]
    cond.append(gap > 0 if min_gap_exclusive else gap >= 0)
    cond.append(gap <= max_gap_us)
    return lb.join(rb, cond, "inner").drop(lb["_tb"]).drop(rb["_tb"])
