"""Expectations (B1-B6): named checks and how many rows break each.

Row checks of a table are counted in one pass over it; a predicate that is
NULL passes, as a CHECK constraint lets it.  Key checks are one aggregate
and reference checks one anti join each.  Every function takes frames, so
planted violations can be tested on small ones.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txmon.functions.money import CASH_TYPES, LARGE_CASH_USD
from txmon.functions.timefn import ts_lit
from txmon.operators.rules import ALERT_COLUMNS, SCORE_COLUMNS, alert_rows
from txmon.plans.model import Monitor
from txmon.session import materialize

# The domains of the monitor model's columns.
CUSTOMER_TYPES = ["individual", "business", "financial_institution"]
KYC_STATUSES = ["verified", "pending", "expired", "failed"]
ACCOUNT_TYPES = ["checking", "savings", "business", "investment", "crypto"]
ACCOUNT_STATUSES = ["active", "frozen", "closed"]
TRANSACTION_TYPES = ["deposit", "withdrawal", "transfer_in", "transfer_out", "wire_in", "wire_out",
                     "cash_deposit", "cash_withdrawal", "crypto_buy", "crypto_sell"]
CHANNELS = ["online", "mobile", "branch", "atm", "wire", "api"]
TRANSACTION_STATUSES = ["completed", "pending", "failed", "reversed"]
RULE_CATEGORIES = ["structuring", "velocity", "geographic", "behavioral", "threshold"]
ALERT_STATUSES = ["open", "investigating", "closed_tp", "closed_fp", "escalated"]


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def row_checks(df: DataFrame, table: str, checks: dict[str, Column]) -> DataFrame:
    """(check_name, violations): rows of ``df`` for which a check is false, all checks in one pass."""
    names = list(checks)
    counts = df.agg(*[F.count_if(~checks[c]).alias(f"n{i}") for i, c in enumerate(names)])
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(f"{table}: {c}").alias("check_name"), F.col(f"n{i}").alias("violations"))
        for i, c in enumerate(names)])).alias("x")).select("x.*")


def duplicate_keys(df: DataFrame, table: str, *key: str) -> DataFrame:
    """Keys that more than one row carries."""
    return df.groupBy(*key).count().where("count > 1").agg(F.count("*").alias("violations")).select(
        F.lit(f"{table}: unique {', '.join(key)}").alias("check_name"), "violations")


def orphans(df: DataFrame, table: str, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose non-null ``column`` names no row of ``parent``."""
    known = parent.select(F.col(parent_key).alias("_known"))
    lost = df.where(F.col(column).isNotNull()).join(known, F.col(column) == F.col("_known"), "left_anti")
    return lost.agg(F.count("*").alias("violations")).select(
        F.lit(f"{table}: {column} known").alias("check_name"), "violations")


def domain_checks(country_risk: DataFrame, customers: DataFrame, accounts: DataFrame, transactions: DataFrame,
                  enrichment: DataFrame, rules: DataFrame, alerts: DataFrame, alert_scores: DataFrame) -> DataFrame:
    """B1: domains and ranges of every enum, flag, score and positive amount."""
    c = F.col
    flag = lambda name: c(name).isin(0, 1)
    unit = lambda name: c(name).between(0.0, 1.0)
    return _union([
        row_checks(country_risk, "country_risk", {
            "risk_level": c("risk_level").between(1, 5), "fatf_listed": flag("fatf_listed")}),
        row_checks(customers, "customers", {
            "customer_type": c("customer_type").isin(CUSTOMER_TYPES), "risk_rating": c("risk_rating").isin(1, 2, 3),
            "kyc_status": c("kyc_status").isin(KYC_STATUSES), "pep_status": flag("pep_status")}),
        row_checks(accounts, "accounts", {
            "account_type": c("account_type").isin(ACCOUNT_TYPES), "currency": F.length("currency") == 3,
            "status": c("status").isin(ACCOUNT_STATUSES), "daily_limit": c("daily_limit") > 0}),
        row_checks(transactions, "transactions", {
            "transaction_type": c("transaction_type").isin(TRANSACTION_TYPES), "amount": c("amount") > 0,
            "currency": F.length("currency") == 3, "channel": c("channel").isin(CHANNELS),
            "status": c("status").isin(TRANSACTION_STATUSES)}),
        row_checks(enrichment, "enrichment", {
            "is_round_amount": flag("is_round_amount"), "is_large_cash": flag("is_large_cash"),
            "country_risk_score": c("country_risk_score").between(1, 5),
            "is_new_counterparty": flag("is_new_counterparty")}),
        row_checks(rules, "rules", {
            "category": c("category").isin(RULE_CATEGORIES), "severity": unit("severity"),
            "is_active": flag("is_active")}),
        row_checks(alerts, "alerts", {
            "score": c("score").between(0.0, 100.0), "status": c("status").isin(ALERT_STATUSES)}),
        row_checks(alert_scores, "alert_scores", {
            **{s: unit(s) for s in ("rule_score", "customer_risk_score", "geographic_risk_score", "behavioral_score")},
            "composite_score": c("composite_score").between(0.0, 100.0)}),
    ])


def reference_checks(country_risk: DataFrame, customers: DataFrame, accounts: DataFrame, transactions: DataFrame,
                     rules: DataFrame, alerts: DataFrame) -> DataFrame:
    """B2: rows that point at nothing."""
    return _union([
        orphans(accounts, "accounts", "customer_id", customers, "id"),
        orphans(transactions, "transactions", "account_id", accounts, "id"),
        orphans(transactions, "transactions", "counterparty_country", country_risk, "country_code"),
        orphans(alerts, "alerts", "transaction_id", transactions, "id"),
        orphans(alerts, "alerts", "rule_id", rules, "id"),
    ])


def key_checks(country_risk: DataFrame, customers: DataFrame, accounts: DataFrame, transactions: DataFrame,
               rules: DataFrame, alerts: DataFrame) -> DataFrame:
    """Primary keys, rule names and (transaction, rule) pairs."""
    return _union([
        duplicate_keys(country_risk, "country_risk", "country_code"), duplicate_keys(customers, "customers", "id"),
        duplicate_keys(accounts, "accounts", "id"), duplicate_keys(transactions, "transactions", "id"),
        duplicate_keys(rules, "rules", "id"), duplicate_keys(rules, "rules", "name"),
        duplicate_keys(alerts, "alerts", "alert_id"), duplicate_keys(alerts, "alerts", "transaction_id", "rule_id"),
    ])


def integrity_checks(customers: DataFrame, accounts: DataFrame, transactions: DataFrame,
                     first_day: str = "2024-01-01", end_day: str = "2025-01-01") -> DataFrame:
    """Currencies, amounts, the year's dates (``end_day`` itself still passes), names, opening dates."""
    registered = customers.select(F.col("id").alias("_c"), "registration_date")
    owned = accounts.join(registered, F.col("customer_id") == F.col("_c"))
    return _union([
        row_checks(transactions, "transactions", {
            "currency has 3 letters": F.length("currency") == 3, "amount is positive": F.col("amount") > 0,
            "dated in the year": F.col("timestamp").between(ts_lit(first_day), ts_lit(end_day))}),
        row_checks(customers, "customers", {
            "name present": F.col("name").isNotNull() & (F.col("name") != ""),
            "type valid": F.col("customer_type").isin(CUSTOMER_TYPES)}),
        row_checks(owned, "accounts", {"opened after registration": F.col("opened_date") >= F.col("registration_date")}),
    ])


def enrichment_checks(transactions: DataFrame, enriched: DataFrame) -> DataFrame:
    """``enriched`` carries the transactions' type, currency and amount beside the enrichment."""
    c, usd = F.col, F.col("amount_usd")
    large = c("is_large_cash") == 1
    done = enriched.select(F.col("transaction_id").alias("_done"))
    missing = transactions.join(done, F.col("id") == F.col("_done"), "left_anti").agg(
        F.count("*").alias("violations")).select(F.lit("enrichment: every transaction").alias("check_name"), "violations")
    return missing.unionByName(row_checks(enriched, "enrichment", {
        "amount_usd is positive": usd > 0,
        "large cash is cash": ~large | c("transaction_type").isin(*CASH_TYPES),
        "large cash is large": ~large | (usd >= LARGE_CASH_USD),
        "dollars stay as they are": (c("currency") != "USD") | (F.abs(usd - c("amount")) <= 0.01),
        "velocities are not negative": (c("velocity_1h") >= 0) & (c("velocity_24h") >= 0) & (c("velocity_7d") >= 0),
        "velocities grow with the window": (c("velocity_1h") <= c("velocity_24h"))
                                           & (c("velocity_24h") <= c("velocity_7d")),
        "country risk from 1 to 5": c("country_risk_score").between(1, 5),
        "account age is not negative": c("account_age_days") >= 0}))


def alert_checks(rules: DataFrame, alerts: DataFrame, alert_scores: DataFrame) -> DataFrame:
    """Rules without alerts, score range, one breakdown an alert, the formula, categories, duplicates."""
    hit = alerts.select(F.col("rule_id").alias("_hit")).distinct()
    silent = rules.where("is_active = 1").join(hit, F.col("id") == F.col("_hit"), "left_anti")
    per_alert = alerts.select("alert_id", F.lit(0).alias("s")).unionByName(
        alert_scores.select("alert_id", F.lit(1).alias("s"))).groupBy("alert_id").agg(
        F.count_if(F.col("s") == 0).alias("a"), F.count_if(F.col("s") == 1).alias("b"))
    formula = 100 * (0.30 * F.col("rule_score") + 0.25 * F.col("customer_risk_score")
                     + 0.25 * F.col("geographic_risk_score") + 0.20 * F.col("behavioral_score"))
    present = F.collect_set("category")  # five categories at most pass B1
    categories = rules.agg(F.size(F.array_except(F.array(*map(F.lit, RULE_CATEGORIES)), present)).cast(
        "bigint").alias("violations"))
    named = lambda df, name: df.select(F.lit(name).alias("check_name"), "violations")
    return _union([
        named(silent.agg(F.count("*").alias("violations")), "rules: every active rule fires"),
        named(categories, "rules: every category has rules"),
        row_checks(alerts, "alerts", {"score from 0 to 100": F.col("score").between(0.0, 100.0)}),
        row_checks(per_alert, "alerts", {"one breakdown each": (F.col("a") == 1) & (F.col("b") == 1)}),
        row_checks(alert_scores, "alert_scores", {"formula holds": F.abs(formula - F.col("composite_score")) < 0.1}),
        duplicate_keys(alerts, "alerts", "transaction_id", "rule_id"),
    ])


def stored_alerts(m: Monitor) -> tuple[DataFrame, DataFrame]:
    """Alerts and their breakdowns, written once: each of the checks reads the table, none runs the rules again."""
    rows = materialize(alert_rows(m.fired), "checked")
    return rows.select(*ALERT_COLUMNS), rows.select(*SCORE_COLUMNS)


ALL: dict[str, Callable[[Monitor], DataFrame]] = {
    "b1_domain_checks": lambda m: domain_checks(m.country_risk, m.customers, m.accounts, m.transactions, m.enrichment,
                                                m.rules, *stored_alerts(m)),
    "b2_reference_checks": lambda m: reference_checks(m.country_risk, m.customers, m.accounts, m.transactions,
                                                      m.rules, stored_alerts(m)[0]),
    "b3_key_checks": lambda m: key_checks(m.country_risk, m.customers, m.accounts, m.transactions, m.rules,
                                          stored_alerts(m)[0]),
    "b4_integrity_checks": lambda m: integrity_checks(m.customers, m.accounts, m.transactions),
    "b5_enrichment_checks": lambda m: enrichment_checks(m.transactions, m.wide),
    "b6_alert_checks": lambda m: alert_checks(m.rules, *stored_alerts(m)),
}
