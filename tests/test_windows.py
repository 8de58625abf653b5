"""Trailing aggregates: both plans against brute force; a hot key is spread over tasks."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

AGG = {"n2": ("count", None, 20), "n9": ("count", None, 95), "s9": ("sum", "v", 95), "d2": ("sum", "m", 20)}


def rows():
    rng = random.Random(12)
    out = [(i, rng.choice(["a", "b", "hot", "hot", "hot"]), rng.randrange(0, 900), rng.randrange(-5, 50),
            Decimal(rng.randrange(0, 9999)) / 100) for i in range(500)]
    out += [(1000 + i, "hot", 333, 2, Decimal("0.01")) for i in range(60)]  # many rows at one time
    out += [(2000, "late", -50, 1, None), (2001, "late", -40, None, Decimal(1)), (2002, None, 5, 3, Decimal(2)),
            (2003, None, 6, 4, Decimal(3))]
    return out


def brute(data):
    out = {}
    for i, k, t, _, _ in data:
        frame = lambda w: [r for r in data if r[1] == k and t - w <= r[2] < t]  # noqa: E731, B023
        out[i] = (len(frame(20)), len(frame(95)), sum(r[3] or 0 for r in frame(95)), sum(r[4] or 0 for r in frame(20)))
    return out


@pytest.mark.parametrize("hot_rows", [0, 15, 10_000, None])
def test_trailing_aggregates(spark, hot_rows):
    """All keys by prefix sums (but the null key), some, none; and without a split."""
    from txmon.operators.windows import trailing_aggregates
    data = rows()
    df = spark.createDataFrame(data, "id bigint, k string, us bigint, v bigint, m decimal(18,2)")
    got = trailing_aggregates(df, "k", "us", AGG, payload=["id"], hot_rows=hot_rows)
    assert {r["id"]: (r.n2, r.n9, r.s9, r.d2) for r in got.collect()} == brute(data)
    assert got.schema["n2"].dataType.simpleString() == "bigint" and got.schema["d2"].dataType.simpleString() == "decimal(28,2)"


def test_prefix_sums_with_null_keys_and_small_sub_buckets(spark):
    from txmon.operators.windows import prefix_aggregates
    data = rows()
    df = spark.createDataFrame(data, "id bigint, k string, us bigint, v bigint, m decimal(18,2)")
    for sub in (1, 7, 5000):
        got = prefix_aggregates(df, "k", "us", AGG, sub_us=sub)
        assert {r["id"]: (r.n2, r.n9, r.s9, r.d2) for r in got.collect()} == brute(data)


def test_hot_key_is_spread(spark):
    """One key holds all 40,000 rows of a week: its rows are ranked in many tasks, none with a large share."""
    from txmon.operators.windows import prefix_aggregates
    hour = 3_600_000_000
    df = spark.range(40_000).select("id", F.lit("one").alias("k"), (F.col("id") * (168 * hour // 40_000)).alias("us"))
    out = prefix_aggregates(df, "k", "us", {"n": ("count", None, 168 * hour)})
    assert out.where(F.col("n") != F.col("id")).count() == 0
    marks = df.select("k", F.floor(F.col("us") / hour).alias("b")).repartition(64, "k", "b").groupBy(F.spark_partition_id()).count()
    assert max(r["count"] for r in marks.collect()) < 40_000 / 8
    with pytest.raises(ValueError, match="exact"):
        prefix_aggregates(df.withColumn("x", F.lit(0.5)), "k", "us", {"s": ("sum", "x", hour)})
