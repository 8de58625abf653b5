"""Expectations: a planted violation of every check is counted, clean rows are not."""

import datetime as dt

from pyspark.sql import functions as F

from txmon.operators import expectations as X
from txmon.operators.rules import SCORE_COLUMNS, rules_frame
from txmon.plans.model import load_monitor

SF = "/root/testdata/sf0.001"


def found(df):
    return {r["check_name"]: r["violations"] for r in df.collect() if r["violations"]}


def test_row_checks_count_false_but_not_null(spark):
    df = spark.createDataFrame([(1,), (7,), (None,)], "x int")
    assert found(X.row_checks(df, "t", {"small": F.col("x") < 5})) == {"t: small": 1}


def test_planted_domain_violations(spark):
    one = lambda row, schema: spark.createDataFrame([row], schema)
    country = one((9, 2), "risk_level int, fatf_listed int")
    customers = one(("ghost", 4, "unknown", 3), "customer_type string, risk_rating int, kyc_status string, pep_status int")
    accounts = one(("barter", "US", "lost", 0.0), "account_type string, currency string, status string, daily_limit double")
    tx = one(("gift", -1.0, "DOLLAR", "pigeon", "odd"),
             "transaction_type string, amount double, currency string, channel string, status string")
    te = one((2, 2, 0, 2), "is_round_amount int, is_large_cash int, country_risk_score int, is_new_counterparty int")
    rules = one(("other", 1.5, 3), "category string, severity double, is_active int")
    alerts = one((101.0, "closed"), "score double, status string")
    scores = one((-0.1, 1.1, 2.0, -1.0, 200.0), ", ".join(f"{c} double" for c in SCORE_COLUMNS[1:]))
    got = found(X.domain_checks(country, customers, accounts, tx, te, rules, alerts, scores))
    assert len(got) == 29 and set(got.values()) == {1}


def test_planted_orphans_keys_and_integrity(spark):
    country = spark.createDataFrame([("N01",), ("N01",)], "country_code string")
    day = dt.date(2024, 1, 1)
    customers = spark.createDataFrame([(1, "A", "individual", day), (1, "", "club", day)],
                                      "id long, name string, customer_type string, registration_date date")
    accounts = spark.createDataFrame([(5, 1, dt.date(2023, 1, 1)), (6, 9, day), (6, None, day)],
                                     "id long, customer_id long, opened_date date")
    tx = spark.createDataFrame(
        [(1, 5, "N01", "USD", 1.0, dt.datetime(2024, 5, 1)), (1, 77, "N99", "EURO", 0.0, dt.datetime(2023, 5, 1)),
         (2, 5, None, "USD", 1.0, dt.datetime(2025, 1, 1))],
        "id long, account_id long, counterparty_country string, currency string, amount double, timestamp timestamp_ntz")
    rules = spark.createDataFrame([(1, "a"), (1, "a")], "id long, name string")
    alerts = spark.createDataFrame([(1, 1, 1), (1, 1, 1), (3, 8, 8)], "alert_id long, transaction_id long, rule_id long")
    assert found(X.reference_checks(country, customers, accounts, tx, rules, alerts)) == {
        "accounts: customer_id known": 1, "transactions: account_id known": 1,
        "transactions: counterparty_country known": 1, "alerts: transaction_id known": 1, "alerts: rule_id known": 1}
    assert found(X.key_checks(country, customers, accounts, tx, rules, alerts)) == {
        "country_risk: unique country_code": 1, "customers: unique id": 1, "accounts: unique id": 1,
        "transactions: unique id": 1, "rules: unique id": 1, "rules: unique name": 1, "alerts: unique alert_id": 1,
        "alerts: unique transaction_id, rule_id": 1}
    assert found(X.integrity_checks(customers, accounts, tx)) == {
        "transactions: currency has 3 letters": 1, "transactions: amount is positive": 1,
        "transactions: dated in the year": 1, "customers: name present": 1, "customers: type valid": 1,
        "accounts: opened after registration": 2}


def test_planted_enrichment_and_alert_violations(spark):
    tx = spark.createDataFrame([(1,), (2,)], "id long")
    wide = spark.createDataFrame(
        [(1, "wire_in", "USD", 5.0, -1.0, 1, -1, 3, 2, 9, -4)],
        "transaction_id long, transaction_type string, currency string, amount double, amount_usd double, "
        "is_large_cash int, velocity_1h int, velocity_24h int, velocity_7d int, country_risk_score int, account_age_days int")
    got = found(X.enrichment_checks(tx, wide))
    assert len(got) == 9 and set(got.values()) == {1}
    rules = rules_frame(spark).where("category <> 'velocity'")
    alerts = spark.createDataFrame([(1, 1, 1, 200.0), (2, 1, 1, 50.0)],
                                   "alert_id long, transaction_id long, rule_id long, score double")
    scores = spark.createDataFrame([(1, 0.8, 0.2, 0.1, 0.0, 31.5), (1, 0.8, 0.2, 0.1, 0.0, 40.0)],
                                   "alert_id long, " + ", ".join(f"{c} double" for c in SCORE_COLUMNS[1:]))
    assert found(X.alert_checks(rules, alerts, scores)) == {
        "rules: every active rule fires": rules.count() - 1, "rules: every category has rules": 1,
        "alerts: score from 0 to 100": 1, "alerts: one breakdown each": 2, "alert_scores: formula holds": 1,
        "alerts: unique transaction_id, rule_id": 1}


def test_new_countries_and_global_ranks(spark):
    from txmon.operators.ranking import global_percent_rank
    from txmon.operators.timeliness import new_countries
    from txmon.sources.report import Report

    tx = spark.createDataFrame(
        [("N01", dt.datetime(2023, 5, 1), 1.0), ("N01", dt.datetime(2024, 1, 20), 1.0), ("N02", dt.datetime(2024, 1, 1), 2.5),
         ("N02", dt.datetime(2024, 1, 9), 2.5), ("N77", dt.datetime(2024, 1, 30), 4.0), (None, dt.datetime(2024, 1, 30), 4.0)],
        "counterparty_country string, transaction_date timestamp_ntz, amount double")
    risk = spark.createDataFrame([("N01", "low"), ("N02", "high")], "country_code string, risk_level string")
    got = new_countries(Report(risk, None, None, tx, None, None))
    assert sorted(map(tuple, got.collect())) == [("N02", "2024-01-01", 2, 5.0, "high"), ("N77", "2024-01-30", 1, 4.0, "Unknown")]
    ranks = global_percent_rank(spark.createDataFrame([(v,) for v in (1, 1, 1, 2, 5)], "v int"), "v")
    assert sorted((r["v"], r["percent_rank"]) for r in ranks.collect()) == [(1, 0.0)] * 3 + [(2, 0.75), (5, 1.0)]


def test_rapid_movement_takes_the_latest_credit(spark):
    from txmon.functions.timefn import US_PER_HOUR
    from txmon.plans.detectors import z03_rapid_movement, z13_layering

    h = US_PER_HOUR
    t = spark.createDataFrame(
        [("A", "c1", "credit", 1 * h, 100.0), ("A", "c2", "credit", 5 * h, 10.0), ("A", "o1", "wire", 7 * h, 9.0),
         ("A", "o2", "wire", 4 * h, 50.0), ("A", "o3", "wire", 5 * h, 90.0), ("A", "o4", "wire", 12 * h, 99.0),
         ("B", "o5", "wire", 7 * h, 99.0), ("A", "o6", "wire", 11 * h, 8.0)],
        "account_id string, transaction_id string, transaction_type string, us long, amount double")
    assert sorted(r["transaction_id"] for r in z03_rapid_movement(t, None).collect()) == ["o1", "o3", "o6"]
    legs = spark.createDataFrame(
        [("P", "A", "a", 1 * h, 100.0), ("P", "B", "b", 2 * h, 104.9), ("P", "C", "c", 20 * h, 100.0), ("P", "A", "d", 3 * h, 105.0),
         ("Q", "A", "e", 1 * h, 100.0), ("Q", "B", "f", 2 * h, 106.0), ("Q", "C", "g", 3 * h, 106.0)],
        "counterparty_name string, account_id string, transaction_id string, us long, amount double").withColumn(
        "transaction_type", F.lit("wire"))
    assert sorted(r["transaction_id"] for r in z13_layering(legs, None).collect()) == ["c"]
