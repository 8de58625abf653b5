"""Customer due diligence on the report model (C1 share, C2, C4, C5 remediation, C6 detail).

Accounts, transactions and alerts are aggregated to their customer before
anything is joined, so the fan-out of the plain joins never appears.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txmon.functions.money import rnd
from txmon.plans.reports import SEVERITY_RANK, c1_risk_distribution
from txmon.sources.report import Report


def _rank(rating: Column) -> Column:
    e = F.when(rating == "critical", 1)
    for name in ("high", "medium"):
        e = e.when(rating == name, SEVERITY_RANK[name])
    return e.otherwise(4)


def _alert_counts(r: Report) -> DataFrame:
    return r.alerts.groupBy(F.col("customer_id").alias("_ca")).agg(F.count("*").alias("_alerts"))


def _account_facts(r: Report, accounts: DataFrame) -> DataFrame:
    """Per customer of ``accounts``: worst status by name, last transaction, rows and volume of the
    account-transaction join (an account without transactions is one row)."""
    per = r.transactions.groupBy(F.col("account_id").alias("_a")).agg(
        F.count("*").alias("_n"), F.sum("amount").alias("_v"), F.max("transaction_date").alias("_last"))
    j = accounts.join(per, F.col("account_id") == F.col("_a"), "left")
    return j.groupBy(F.col("customer_id").alias("_cc")).agg(
        F.max("status").alias("account_status"), F.max("_last").alias("last_transaction"),
        F.sum(F.coalesce("_n", F.lit(1))).alias("_rows"), F.sum("_v").alias("_volume"))


def _with_facts(r: Report, customers: DataFrame) -> DataFrame:
    alerts, facts = _alert_counts(r), _account_facts(r, r.accounts)
    return (customers.join(alerts, F.col("customer_id") == F.col("_ca"), "left")
            .join(facts, F.col("customer_id") == F.col("_cc"), "left")
            .withColumn("alert_count", F.coalesce("_alerts", F.lit(0))))


def c1_high_risk_share(r: Report) -> DataFrame:
    """Share of customers and volume rated high or critical."""
    upper = F.col("risk_rating").isin("high", "critical")
    part = lambda c: F.sum(F.when(upper, F.col(c)).otherwise(0))
    return c1_risk_distribution(r).agg(
        part("customers").alias("customers"), rnd(part("customers") * 100.0 / F.sum("customers"), 1).alias("customer_pct"),
        rnd(part("volume"), 2).alias("volume"), rnd(part("volume") * 100.0 / F.sum("volume"), 1).alias("volume_pct"))


def c2_high_risk_customers(r: Report) -> DataFrame:
    upper = r.customers.where(F.col("risk_rating").isin("high", "critical"))
    return _with_facts(r, upper).select(
        "customer_id", "name", "risk_rating", "kyc_status", "pep_flag", "sanctions_flag", "nationality",
        "country_of_residence", "alert_count", "account_status", "last_transaction")


def c4_enhanced_diligence(r: Report, many: int = 3) -> DataFrame:
    """Customers due for enhanced diligence with the reasons, priority and review state."""
    c, rating, n = F.col, F.col("risk_rating"), F.col("alert_count")
    rows = _with_facts(r, r.customers.where(rating.isin("high", "critical")))
    rows = rows.where((rating == "critical") | (c("pep_flag") == 1) | (n > many))
    reasons = F.concat_ws("; ", F.when(rating == "critical", "Critical risk rating"),
                          F.when(c("pep_flag") == 1, "PEP exposure"), F.when(c("sanctions_flag") == 1, "Sanctions flag"),
                          F.when(n > many, F.concat(n.cast("string"), F.lit(" alerts"))))
    note = F.when(c("kyc_status").isin("expired", "failed"), F.concat(F.lit(" + "), c("kyc_status"), F.lit(" KYC"))).otherwise("")
    return rows.select(
        "customer_id", "name", "risk_rating", "kyc_status", "pep_flag", "sanctions_flag", "nationality", "alert_count",
        "account_status", F.concat(F.when(reasons == "", "Risk threshold exceeded").otherwise(reasons), note).alias("reason"),
        F.when(rating == "critical", "Immediate").otherwise("High").alias("priority"),
        F.when(rating == "critical", "Overdue").otherwise("Due Soon").alias("review"))


def c5_kyc_remediation(r: Report, k: int = 20) -> DataFrame:
    """Customers with lapsed KYC on an active account, worst rating and latest activity first."""
    lapsed = r.customers.where(F.col("kyc_status").isin("expired", "failed"))
    facts = _account_facts(r, r.accounts.where("status = 'active'"))
    top = lapsed.join(facts, F.col("customer_id") == F.col("_cc")).orderBy(
        _rank(F.col("risk_rating")), F.desc_nulls_last("last_transaction"), "customer_id").limit(k)
    return top.select("customer_id", "name", "kyc_status", "risk_rating", "pep_flag", "account_status", "last_transaction",
                      F.when(F.col("kyc_status") == "failed", "Suspend Account").otherwise("Request Updated KYC").alias("action"))


def c6_exposed_customers(r: Report) -> DataFrame:
    """Exposed or sanctioned customers with the counts of the double join alerts x transactions, as weights:
    every alert counts once a joined row, every amount once an alert."""
    rows = _with_facts(r, r.customers.where("pep_flag = 1 OR sanctions_flag = 1"))
    return rows.select(
        "customer_id", "name", "risk_rating", "pep_flag", "sanctions_flag", "nationality", "kyc_status",
        (F.col("alert_count") * F.coalesce("_rows", F.lit(1))).cast("bigint").alias("alerts"),
        rnd(F.coalesce(F.col("_volume") * F.greatest("alert_count", F.lit(1)), F.lit(0)), 2).alias("txn_volume"))


ALL = {
    "c1_high_risk_share": c1_high_risk_share,
    "c2_high_risk_customers": c2_high_risk_customers,
    "c4_enhanced_diligence": c4_enhanced_diligence,
    "c5_kyc_remediation": c5_kyc_remediation,
    "c6_exposed_customers": c6_exposed_customers,
}
