"""Global ordering operators without a single-partition window.

``F.ntile(100).over(Window.orderBy(x))`` moves every row into one task.
Here the rows are range-partitioned on ``x`` and a hash of the row, so that
equal values spread too, and sorted inside each partition; the partitioned
data is checkpointed (the sampled range bounds must not change between the
two passes), and the partitions' starting offsets, one small row each, are
joined back.  Ranks that ties share come from the counts of the values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txmon.session import checkpoint_dir


def _starts(ranged: DataFrame, rows) -> DataFrame:
    """(_pid, _start, _n): rows before each partition, and all rows; one row a partition."""
    sums = ranged.groupBy("_pid").agg(rows.alias("_rows"))
    upto = F.sum("_rows").over(Window.partitionBy().orderBy("_pid").rowsBetween(Window.unboundedPreceding, 0))
    return sums.select("_pid", (upto - F.col("_rows")).alias("_start"), F.sum("_rows").over(Window.partitionBy()).alias("_n"))


def _ranged(df: DataFrame, *order, partitions: int | None = None) -> DataFrame:
    spark = df.sparkSession
    checkpoint_dir(spark)
    p = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(p, *order).sortWithinPartitions(*order)
    return ranged.withColumn("_pid", F.spark_partition_id()).withColumn(
        "_mid", F.monotonically_increasing_id()).checkpoint(eager=True)


def with_global_index(df: DataFrame, order_col: str, partitions: int | None = None) -> DataFrame:
    """Add ``_gidx`` (0-based position in ``order_col`` order) and ``_n`` (row count)."""
    ranged = _ranged(df.withColumn("_tie", F.xxhash64(*df.columns)), order_col, "_tie", partitions=partitions)
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    starts = F.broadcast(_starts(ranged, F.count("*")))  # one row a partition
    return ranged.join(starts, "_pid").withColumn("_gidx", F.col("_start") + local).drop("_pid", "_mid", "_tie", "_start")


def value_ranks(df: DataFrame, value: str) -> DataFrame:
    """(value, n, before, total): the rows with each value, the rows below it, and all rows."""
    ranged = _ranged(df.groupBy(value).agg(F.count("*").alias("n")), value)
    inside = F.sum("n").over(Window.partitionBy("_pid").orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    starts = F.broadcast(_starts(ranged, F.sum("n")))  # one row a partition
    return ranged.join(starts, "_pid").select(value, "n", (F.col("_start") + inside - F.col("n")).alias("before"),
                                              F.col("_n").alias("total"))


def ntile_of_index(idx, n, buckets: int):
    """NTILE(buckets) of a 0-based index: the first ``n mod buckets`` tiles hold one row more."""
    q = F.floor(n / buckets)
    r = n % buckets
    big = r * (q + 1)
    return F.when(idx < big, F.floor(idx / (q + 1)) + 1).otherwise(
        r + F.floor((idx - big) / F.greatest(q, F.lit(1))) + 1).cast("int")


def global_ntile(df: DataFrame, order_col: str, buckets: int, name: str = "ntile") -> DataFrame:
    g = with_global_index(df, order_col)
    return g.withColumn(name, ntile_of_index(F.col("_gidx"), F.col("_n"), buckets))


def global_percent_rank(df: DataFrame, order_col: str, name: str = "percent_rank") -> DataFrame:
    """PERCENT_RANK: rows below / (n - 1), ties share it; null values stand first, as in the window."""
    ranks = value_ranks(df, order_col).select(F.col(order_col).alias("_v"), "before", "total")
    share = F.when(F.col("total") > 1, F.col("before") / (F.col("total") - 1)).otherwise(F.lit(0.0))
    return df.join(ranks, F.col(order_col).eqNullSafe(F.col("_v"))).withColumn(name, share).drop("_v", "before", "total")
