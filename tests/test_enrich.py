"""Enrichment micro fixtures with hand-computed answers (FIXTURES §C)."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import TXN_SCHEMA, txn
from txmon.operators.enrich import enrich, enrich_incremental


def _run(spark, rows, dims, bucket_us=None):
    accounts, _, country = dims
    t = spark.createDataFrame(rows, TXN_SCHEMA)
    out = enrich(t, accounts, country, bucket_us=bucket_us)
    return {r["id"]: r for r in out.collect()}


@pytest.mark.parametrize("bucket_us", [None, 3_600_000_000, 7 * 86_400_000_000])
def test_velocity_edges_half_open(spark, dims, bucket_us):
    base = "2024-03-01 10:00:00"
    rows = [txn(1, 1, base), txn(2, 1, base), txn(3, 1, "2024-03-01 10:59:59"),
            txn(4, 1, "2024-03-01 11:00:00"), txn(5, 1, "2024-03-01 11:00:01"),
            txn(6, 1, "2024-03-02 10:00:00"), txn(7, 1, "2024-03-08 10:00:00")]
    r = _run(spark, rows, dims, bucket_us)
    # same-second peers are excluded from each other's windows
    assert (r[1]["velocity_1h"], r[2]["velocity_1h"]) == (0, 0)
    assert r[3]["velocity_1h"] == 2
    # exactly one hour old is inside [t-1h, t)
    assert r[4]["velocity_1h"] == 3
    assert r[5]["velocity_1h"] == 2          # 10:00:00 rows are now older than 1h
    assert r[6]["velocity_24h"] == 5         # all five earlier rows, 10:00 exactly 24h old included
    assert r[6]["velocity_1h"] == 0
    assert r[7]["velocity_7d"] == 6
    assert r[7]["velocity_24h"] == 0
    for x in r.values():
        assert x["velocity_1h"] <= x["velocity_24h"] <= x["velocity_7d"]


def test_amount_window_and_fx(spark, dims):
    rows = [txn(1, 1, "2024-03-01 10:00:00", "100.00", cur="EUR"),
            txn(2, 1, "2024-03-01 11:00:00", "1000.00", cur="JPY"),
            txn(3, 1, "2024-03-01 12:00:00", "10.00", cur="XXX")]
    r = _run(spark, rows, dims)
    assert r[1]["amount_usd"] == Decimal("109.00")
    assert r[2]["amount_usd"] == Decimal("6.70")
    assert r[3]["amount_usd"] == Decimal("10.00")   # unknown currency -> rate 1
    assert r[1]["amount_velocity_24h"] == Decimal("0.00")
    assert r[3]["amount_velocity_24h"] == Decimal("115.70")


def test_round_amounts(spark, dims):
    vals = ["500", "550", "999.99", "1000", "5050", "5025", "450"]
    rows = [txn(i + 1, 1, f"2024-03-0{i + 1} 00:00:00", v) for i, v in enumerate(vals)]
    r = _run(spark, rows, dims)
    flags = [r[i + 1]["is_round_amount"] for i in range(len(vals))]
    assert flags == [1, 0, 0, 1, 1, 0, 0]


def test_first_counterparty_order_and_empties(spark, dims):
    t = "2024-03-01 10:00:00"
    rows = [txn(1, 1, t, cp=None), txn(2, 1, t, cp=""), txn(4, 1, t, cp="A"), txn(3, 1, t, cp="A"),
            txn(5, 1, "2024-03-01 09:00:00", cp="B"), txn(6, 2, t, cp="A")]
    r = _run(spark, rows, dims)
    assert [r[i]["is_new_counterparty"] for i in (1, 2, 3, 4, 5, 6)] == [0, 0, 1, 0, 1, 1]


def test_country_risk_and_age(spark, dims):
    rows = [txn(1, 1, "2024-03-01 10:00:00", country="N05"), txn(2, 1, "2024-03-01 10:00:00", country="ZZ"),
            txn(3, 2, "2024-03-01 10:00:00")]
    r = _run(spark, rows, dims)
    assert (r[1]["country_risk_score"], r[2]["country_risk_score"], r[3]["country_risk_score"]) == (5, 1, 1)
    assert r[1]["account_age_days"] == 60
    assert r[3]["account_age_days"] == 0     # opened after the transaction: clamped


def test_large_cash(spark, dims):
    rows = [txn(1, 1, "2024-03-01 10:00:00", "10000.00", ty="cash_deposit"),
            txn(2, 1, "2024-03-01 11:00:00", "10000.00", ty="wire_out"),
            txn(3, 1, "2024-03-01 12:00:00", "9999.99", ty="cash_withdrawal")]
    r = _run(spark, rows, dims)
    assert [r[i]["is_large_cash"] for i in (1, 2, 3)] == [1, 0, 0]


def test_incremental_keeps_history(spark, dims):
    accounts, _, country = dims
    first = spark.createDataFrame([txn(1, 1, "2024-03-01 10:00:00", cp="A")], TXN_SCHEMA)
    both = spark.createDataFrame([txn(1, 1, "2024-03-01 10:00:00", cp="A"),
                                  txn(2, 1, "2024-03-01 10:30:00", cp="A")], TXN_SCHEMA)
    done = enrich(first, accounts, country)
    new = enrich_incremental(both, done, accounts, country).collect()
    assert [r["id"] for r in new] == [2]
    assert new[0]["is_new_counterparty"] == 0 and new[0]["velocity_1h"] == 1
    again = enrich_incremental(both, done.unionByName(enrich_incremental(both, done, accounts, country)),
                               accounts, country)
    assert again.count() == 0


def test_sf0001_probe_numbers(spark):
    from txmon.plans.model import load_monitor
    m = load_monitor(spark, "/root/testdata/sf0.001")
    r = m.wide.agg(F.count("*"), F.sum("amount_usd"), F.sum("velocity_1h"), F.sum("velocity_24h"),
                   F.sum("velocity_7d"), F.sum("amount_velocity_24h")).collect()[0]
    assert list(r) == [2500, Decimal("332249932.57"), 98, 2230, 13902, Decimal("20486170.32")]
