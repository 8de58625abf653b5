"""Streaming velocity (N1), components (N5), and the rewritten plans against brute force."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF001


def _monitor(spark):
    from txmon.plans.model import load_monitor
    return load_monitor(spark, SF001)


def _streamed(spark, files, late_by="10 days"):
    """Answers of a stream of frames, one a micro-batch, and the query's progress."""
    from txmon.streaming.velocity import ANSWERS, run_to_table, stream_transactions
    d = tempfile.mkdtemp(prefix="txmon-stream-", dir="/tmp")
    for p in files:
        p.coalesce(1).write.mode("append").parquet(d + "/in")
    q = run_to_table(stream_transactions(spark, d + "/in", files[0].schema), d + "/out", d + "/state", late_by)
    return spark.read.schema(ANSWERS).parquet(d + "/out"), q.recentProgress


def _batch(spark, tx, src):
    from txmon.operators.enrich import enrich
    return {r["id"]: tuple(r)[1:] for r in enrich(tx, src.accounts, src.country_risk).select(
        "id", "velocity_1h", "velocity_24h", "velocity_7d", "amount_velocity_24h").collect()}


def _joined(tx, answers):
    from txmon.functions.timefn import micros
    from txmon.streaming.velocity import latest_velocity
    rows = tx.select("id", "account_id", micros("timestamp").alias("us")).join(latest_velocity(answers), ["account_id", "us"])
    return {r["id"]: tuple(r)[1:] for r in rows.select(
        "id", "velocity_1h", "velocity_24h", "velocity_7d", "amount_velocity_24h").collect()}


def test_streaming_velocity_with_late_rows_equals_batch(spark):
    """Rows in any order across micro-batches; times that tie; one hot account."""
    import random

    from txmon.sources.monitor import load_monitor_sources
    src = load_monitor_sources(spark, SF001)
    tx = src.transactions.where("timestamp >= '2024-01-01'").withColumn(
        "account_id", F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("account_id"))).cache()
    random.seed(4)
    late = tx.where("id % 5 = 0")
    now = tx.where("id % 5 <> 0")
    half = F.lit("2024-01-08").cast("timestamp_ntz")
    files = [now.where(F.col("timestamp") < half), late.where(F.col("timestamp") >= half),
             now.where(F.col("timestamp") >= half), late.where(F.col("timestamp") < half)]
    answers, progress = _streamed(spark, files, "40 days")
    want = _batch(spark, tx, src)
    assert len(want) > 500 and _joined(tx, answers) == want
    assert answers.groupBy("account_id", "us").count().where("count > 1").count() > 0  # corrections were given


def test_streaming_state_goes_with_the_watermark(spark):
    """Weeks behind the watermark leave the state; rows behind it change nothing."""
    from conftest import TXN_SCHEMA, txn
    frame = lambda *rows: spark.createDataFrame(list(rows), TXN_SCHEMA)
    files = [frame(*[txn(i, 1, f"2024-01-{i:02d} 10:00:00") for i in range(1, 8)]),
             frame(txn(20, 1, "2024-03-01 10:00:00"), txn(21, 2, "2024-03-01 10:00:00")),
             frame(txn(22, 1, "2024-03-02 10:00:00")),
             frame(txn(30, 1, "2024-01-03 09:00:00"), txn(31, 1, "2024-03-02 09:00:00"))]
    answers, progress = _streamed(spark, files, "3 days")
    from txmon.streaming.velocity import latest_velocity
    day = {(r.account_id, r.us): r.velocity_24h for r in latest_velocity(answers).collect()}
    at = lambda s: int(dt.datetime.fromisoformat(s + "+00:00").timestamp() * 1_000_000)
    assert (1, at("2024-01-03 09:00:00")) not in day  # later than the watermark allows
    # the rows of 24 hours before count; the one behind the watermark does not, the one within it does
    assert day[1, at("2024-01-03 10:00:00")] == 1 and day[1, at("2024-03-02 10:00:00")] == 2
    keys = [p.stateOperators[0].numRowsTotal for p in progress if p.stateOperators]
    assert max(keys) >= 5 and keys[-1] <= 4  # two accounts, a week and its next


def test_streaming_states_do_not_grow_with_the_accounts(spark):
    """600 accounts of one week share the states of its blocks, and no window reaches from one to the next."""
    from conftest import TXN_SCHEMA, txn
    from txmon.streaming.velocity import BLOCKS, latest_velocity
    files = [spark.createDataFrame([txn(1000 * k + a, a, f"2024-01-0{d} 10:00:{a % 60:02d}") for a in range(600)],
                                   TXN_SCHEMA) for k, d in enumerate((5, 4, 6))]
    answers, progress = _streamed(spark, files)
    assert max(p.stateOperators[0].numRowsTotal for p in progress if p.stateOperators) <= 2 * BLOCKS
    got = latest_velocity(answers).groupBy(F.floor(F.col("us") / 86_400_000_000).alias("d")).agg(
        F.count("*").alias("n"), F.min("velocity_7d").alias("low"), F.max("velocity_7d").alias("high"),
        F.max("amount_velocity_24h").alias("usd")).orderBy("d").collect()
    assert [(r.n, r.low, r.high, float(r.usd)) for r in got] == [(600, 0, 0, 0.0), (600, 1, 1, 100.0), (600, 2, 2, 100.0)]


def test_components_match_union_find(spark):
    from txmon.operators.graph import shared_counterparty_components
    rows = [(1, "A"), (2, "A"), (3, "B"), (2, "B"), (9, "C"), (7, "D"), (8, "D"), (5, None)]
    wide = spark.createDataFrame(rows, "account_id bigint, counterparty_account string")
    got = {r["account_id"]: r["component_id"] for r in shared_counterparty_components(wide).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 9: 9, 7: 7, 8: 7}


def test_components_long_chain(spark):
    from txmon.operators.graph import shared_counterparty_components
    rows = [(i, f"C{i + d}") for i in range(1, 71) for d in (0, 1)]
    wide = spark.createDataFrame(rows, "account_id bigint, counterparty_account string")
    assert {r["component_id"] for r in shared_counterparty_components(wide).collect()} == {1}


def test_padding_never_truncates(spark):
    from txmon.sources.report import key
    got = spark.sql("SELECT explode(array(7, 1234567, 1234568)) AS i").select(key("CUST", F.col("i"), 6)).collect()
    assert [r[0] for r in got] == ["CUST000007", "CUST1234567", "CUST1234568"]


def test_q20_closed_form_equals_pairs(spark):
    from txmon.plans.model import Monitor
    from txmon.plans.monitor_queries import q20_network_clusters
    rows = [(i, a, cp) for i, (a, cp) in enumerate(
        [(1, "A"), (1, "A"), (2, "A"), (3, "A"), (3, "A"), (1, "B"), (2, "B"), (9, "C")])]
    wide = spark.createDataFrame(rows, "id bigint, account_id bigint, counterparty_account string")
    alerts = spark.createDataFrame([(0, 1, 50.0), (6, 1, 60.0)], "transaction_id bigint, rule_id bigint, score double")
    m = Monitor(spark, None, None, None, None, None, wide, alerts, None)
    out = {r["shared_counterparty"]: (r["accounts_in_cluster"], r["total_shared_txns"], r["cluster_alerts"])
           for r in q20_network_clusters(m).collect()}
    assert out == {"A": (3, 8, 2)}


def test_broadcast_follows_the_size_estimate(spark):
    from txmon.operators.joins import broadcast_if_small, plan_size_bytes
    from txmon.sources.driver import read_table
    nations = read_table(spark, SF001, "nation")
    size = plan_size_bytes(nations)
    assert 0 < size < 1 << 20
    hinted = lambda df: "broadcast" in df._jdf.queryExecution().logical().toString()
    assert hinted(broadcast_if_small(nations, size)) and not hinted(broadcast_if_small(nations, size - 1))


def test_time_band_join_equals_brute_force(spark):
    from txmon.operators.joins import time_band_self_join
    import random
    random.seed(7)
    rows = [(i, random.choice([1, 2]), random.randrange(0, 500)) for i in range(300)]
    df = spark.createDataFrame(rows, "id bigint, k bigint, us bigint")
    a = df.select(F.col("id").alias("a_id"), "k", F.col("us").alias("a_us"))
    b = df.select(F.col("id").alias("b_id"), "k", F.col("us").alias("b_us"))
    got = {(r["a_id"], r["b_id"]) for r in time_band_self_join(a, b, ["k"], "a_us", "b_us", 37).collect()}
    want = {(x[0], y[0]) for x in rows for y in rows if x[1] == y[1] and 0 < y[2] - x[2] <= 37}
    assert got == want


def test_global_ntile_equals_window_ntile(spark):
    from txmon.operators.ranking import global_ntile
    df = spark.range(0, 1037).select((F.col("id") * 7919 % 1000).alias("v"))
    got = global_ntile(df, "v", 100, "b").groupBy("b").agg(F.min("v").alias("lo"), F.max("v").alias("hi"),
                                                           F.count("*").alias("n"))
    want = df.withColumn("b", F.ntile(100).over(Window.orderBy("v"))).groupBy("b").agg(
        F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("n"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_detectors_run_on_fixture(spark):
    from txmon.plans.detectors import detection_counts
    from txmon.sources.report import load_report
    rows = detection_counts(load_report(spark, SF001)).collect()
    assert len(rows) == 15 and sum(r["hits"] > 0 for r in rows) >= 10


def test_plan_pushdown_and_broadcast(spark):
    m = _monitor(spark)
    from txmon.plans.monitor_queries import q06_geographic_flows
    plan = q06_geographic_flows(m)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    scan = m.transactions.filter(F.col("amount") > 0).select("id")
    txt = scan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema" in txt and "o_orderdate" not in txt  # columns that are not asked for are not read


@pytest.mark.parametrize("hot_rows", [None, 10, 0])
def test_bucketed_previous_equals_lag(spark, hot_rows):
    """Plain buckets, the full ones cut, and all cut; ties, a null key and null times included."""
    import random
    from txmon.operators.windows import with_previous
    random.seed(3)
    rows = [(i, random.choice([1, 1, 1, 2, 3, None]), random.choice([None, *[random.randrange(-500, 10_000)] * 20]))
            for i in range(400)]
    rows += [(400 + i, 1, 5000 + i // 3) for i in range(60)]
    df = spark.createDataFrame(rows, "id bigint, k bigint, us bigint")
    got = {r["id"]: r["prev_id"] for r in with_previous(
        df, "k", "us", "id", ["id"], bucket_us=96, hot_rows=hot_rows, sub_us=4).collect()}
    want = {r["id"]: r["p"] for r in df.withColumn(
        "p", F.lag("id").over(Window.partitionBy("k").orderBy("us", "id"))).collect()}
    assert got == want
