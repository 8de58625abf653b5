"""Trailing windows against brute force, id spaces past their first block, one rule pass per plan."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from txmon.operators.windows import trailing_aggregates
from txmon.sources.monitor import even_space, is_odd_space, odd_space


@pytest.mark.parametrize("bucket", [None, 7, 50])
def test_trailing_aggregates_equal_brute_force(spark, bucket):
    rng = random.Random(5)
    rows = [(i, rng.choice("aab"), rng.randrange(400), None if rng.random() < 0.1 else rng.randrange(100))
            for i in range(300)]
    df = spark.createDataFrame(rows, "id bigint, k string, us bigint, v bigint").withColumn(
        "d", (F.col("v") / 100).cast("decimal(18,2)"))
    got = {r["id"]: (r["n5"], r["n50"], r["s50"], float(r["d20"])) for r in trailing_aggregates(
        df, "k", "us", {"n5": ("count", None, 5), "n50": ("count", None, 50), "s50": ("sum", "v", 50),
                        "d20": ("sum", "d", 20)}, bucket_us=bucket).collect()}
    assert len(got) == len(rows)
    for i, k, t, _ in rows:
        before = {w: [v for _, k2, t2, v in rows if k2 == k and t - w <= t2 < t] for w in (5, 20, 50)}
        total = lambda w: sum(v or 0 for v in before[w])
        assert got[i][:3] == (len(before[5]), len(before[50]), total(50))
        assert got[i][3] == pytest.approx(total(20) / 100)


def test_trailing_sums_refuse_floating_values(spark):
    df = spark.createDataFrame([("a", 1, 1.5)], "k string, us bigint, v double")
    with pytest.raises(ValueError):
        trailing_aggregates(df, "k", "us", {"s": ("sum", "v", 5)})


def test_id_spaces_never_meet(spark):
    keys = [0, 1, 999, 1000, 1001, 1999, 2000, 10**12 + 7]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint").select(
        "k", even_space(F.col("k"), 1000).alias("e"), odd_space(F.col("k"), 1000).alias("o"))
    rows = df.withColumn("se", is_odd_space(F.col("e"), 1000)).withColumn("so", is_odd_space(F.col("o"), 1000)).collect()
    assert len({r["e"] for r in rows} | {r["o"] for r in rows}) == 2 * len(keys)
    assert not any(r["se"] for r in rows) and all(r["so"] for r in rows)
    assert [r["e"] for r in rows[:3]] == keys[:3] and rows[1]["o"] == 1001


@pytest.mark.parametrize("name", ["q02_customer_segmentation", "q22_top_customers", "h04_alert_detail",
                                  "x02_alerts_export"])
def test_one_velocity_window_and_two_order_scans(spark, name):
    import __spark_entry__ as E
    plan = E.queries()[name](spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("o_orderkey") > 0
    assert sum("Window [" in line for line in plan.splitlines()) <= 1
    assert sum("Relation" in line and "o_orderkey" in line for line in plan.splitlines()) <= 2


@pytest.mark.parametrize("name", ["b6_alert_checks", "h03_alerts"])
def test_the_rules_run_once_a_query(spark, name):
    """What a query returns reads stored rows: no trailing window is left in its plan, to be run again for each part."""
    from txmon.plans.registry import queries
    plan = queries()[name](spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan


def test_few_rows_of_a_bucket_go_twice(spark):
    from txmon.operators.windows import bucketed_aggregates
    rows = spark.range(0, 4000).select("id", F.lit(1).alias("k"), F.col("id").alias("us"))
    got = bucketed_aggregates(rows, "k", "us", {"n": ("count", None, 100)})
    assert got.where(F.col("n") != F.least("id", F.lit(100))).count() == 0
    exploded = [line for line in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "explode" in line]
    assert "400" in exploded[0]  # buckets of four windows
