"""Read models behind the monitor's read endpoints (H1-H11) and the exports
(X1-X4).  Serving is out of scope: each is ``fn(monitor, **filters) -> DataFrame``,
computed for all keys at once and filtered by the caller.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txmon.functions.money import rnd, safe_div
from txmon.functions.timefn import month_key, ts_lit
from txmon.operators.pages import page_directory, seek, top_per_group, write_ordered
from txmon.plans.model import Monitor
from txmon.session import checkpoint_dir, materialize

MAX_PAGE = 200
TXN_ORDER = [("timestamp", True), ("id", True)]


def h01_stats(m: Monitor) -> DataFrame:
    one = [
        m.customers.agg(F.count("*").alias("customers")),
        m.accounts.agg(F.count("*").alias("accounts")),
        m.wide.agg(F.count("*").alias("transactions"),
                   F.round(F.sum("amount_usd"), 2).cast("double").alias("total_volume_usd")),
        m.alerts.agg(F.count("*").alias("alerts"),
                     F.sum((F.col("status") == "open").cast("int")).cast("bigint").alias("open_alerts"),
                     F.sum((F.col("score") >= 60).cast("int")).cast("bigint").alias("high_score_alerts"),
                     F.countDistinct("transaction_id").alias("_alerted")),
        m.rules.agg(F.sum((F.col("is_active") == 1).cast("int")).cast("bigint").alias("rules_active")),
        m.customers.agg(*[F.sum((F.col("risk_rating") == k).cast("int")).cast("bigint").alias(f"customers_risk_{k}")
                          for k in (1, 2, 3)]),
    ]
    out = one[0]
    for d in one[1:]:
        out = out.crossJoin(d)  # every side is one row
    return out.withColumn("alert_rate_pct", F.coalesce(
        rnd(safe_div(100.0 * F.col("_alerted"), F.col("transactions")), 2), F.lit(0.0))).drop("_alerted")


def _page(df: DataFrame, order: list, page: int, per_page: int) -> DataFrame:
    if not 1 <= per_page <= MAX_PAGE or page < 1:
        raise ValueError(f"page {page} of {per_page} rows: a page holds 1 to {MAX_PAGE}")
    df = materialize(df, "page")  # counted and sorted from one run of the plan
    total = df.agg(F.count("*").alias("total"))
    rows = df.orderBy(*order).offset((page - 1) * per_page).limit(per_page)
    return rows.crossJoin(F.broadcast(total)).withColumn(  # one-row total
        "pages", F.floor((F.col("total") + per_page - 1) / per_page).cast("bigint"))


def h02_transactions(m: Monitor, page: int = 1, per_page: int = 50, account_id=None, customer_id=None,
                     txn_type=None, min_amount=None, max_amount=None, start_date=None, end_date=None,
                     alerted_only=False) -> DataFrame:
    t = m.fired.filter(F.size("hits") > 0) if alerted_only else m.wide
    conds = []
    if account_id is not None:
        conds.append(F.col("account_id") == account_id)
    if customer_id is not None:
        conds.append(F.col("customer_id") == customer_id)
    if txn_type:
        conds.append(F.col("transaction_type") == txn_type)
    if min_amount is not None:
        conds.append(F.col("amount") >= min_amount)
    if max_amount is not None:
        conds.append(F.col("amount") <= max_amount)
    if start_date:
        conds.append(F.col("timestamp") >= ts_lit(start_date))
    if end_date:
        # a bare date excludes its whole day, midnight too
        conds.append(F.col("timestamp") < ts_lit(end_date) if len(end_date) == 10 else F.col("timestamp") <= ts_lit(end_date))
    for c in conds:
        t = t.filter(c)
    c = m.customers.select(F.col("id").alias("customer_id"), F.col("name").alias("customer_name"))
    t = t.join(c, "customer_id").select(
        "id", "account_id", "transaction_type", F.col("amount").cast("double").alias("amount"), "currency",
        "timestamp", "counterparty_account", "counterparty_name", "counterparty_country", "channel", "status",
        F.col("amount_usd").cast("double").alias("amount_usd"), "velocity_1h", "velocity_24h",
        "country_risk_score", "is_round_amount", "is_large_cash", "customer_id", "customer_name")
    return _page(t, [F.desc("timestamp"), F.desc("id")], page, per_page)


def _alert_rows(m: Monitor) -> DataFrame:
    a = m.alerts_wide()
    c = m.customers.select(F.col("id").alias("customer_id"), F.col("name").alias("customer_name"),
                           "risk_rating", "pep_status", "customer_type", "kyc_status",
                           F.col("country").alias("customer_country"))
    return a.withColumn("amount", F.col("amount").cast("double")).join(c, "customer_id")


def h03_alerts(m: Monitor, page: int = 1, per_page: int = 50, status=None, min_score=None, rule_id=None,
               category=None, customer_id=None) -> DataFrame:
    a = _alert_rows(m)
    if status:
        a = a.filter(F.col("status") == status)
    if min_score is not None:
        a = a.filter(F.col("score") >= min_score)
    if rule_id is not None:
        a = a.filter(F.col("rule_id") == rule_id)
    if category:
        a = a.filter(F.col("category") == category)
    if customer_id is not None:
        a = a.filter(F.col("customer_id") == customer_id)
    a = a.select("alert_id", "transaction_id", "rule_id", "score", "status", "created_date", "resolved_date",
                 "rule_name", "category", "severity", "amount", "currency",
                 F.col("timestamp").alias("txn_timestamp"), "transaction_type", "customer_id", "customer_name",
                 "risk_rating", "pep_status")
    return _page(a, [F.desc("score"), F.desc("created_date"), "alert_id"], page, per_page)


def h04_alert_detail(m: Monitor) -> DataFrame:
    """Every alert with rule, transaction, enrichment, customer and score breakdown (filter by key)."""
    a = _alert_rows(m)
    return a.select(
        "alert_id", "transaction_id", "rule_id", "score", "status", "rule_name", "category", "severity",
        "account_id", "customer_id", "customer_name", "customer_type", "risk_rating", "kyc_status", "pep_status",
        "customer_country", "transaction_type", "amount", "currency",
        F.col("amount_usd").cast("double").alias("amount_usd"), "timestamp", "counterparty_account",
        "counterparty_country", "channel", "velocity_1h", "velocity_24h", "velocity_7d", "country_risk_score",
        "is_new_counterparty", "is_round_amount", "rule_score", "customer_risk_score", "geographic_risk_score",
        "behavioral_score", "composite_score", "created_date", "resolved_date", "notes", "rule_description",
        "counterparty_name", "is_large_cash", F.col("amount_velocity_24h").cast("double").alias("amount_velocity_24h"),
        "account_age_days")


PROFILE_ACCOUNTS, PROFILE_TXNS, PROFILE_ALERTS = 100, 20, 10


def _profile_accounts(m: Monitor) -> DataFrame:
    a = m.accounts.select("customer_id", "id", "account_type", "currency", "opened_date", "status", "daily_limit")
    return top_per_group(a, "customer_id", [("opened_date", False), ("id", False)], PROFILE_ACCOUNTS)


def _profile_transactions(m: Monitor) -> DataFrame:
    t = m.wide.select("customer_id", "id", "account_id", "transaction_type", F.col("amount").cast("double").alias("amount"),
                      "currency", "timestamp", "counterparty_country", "channel", "status",
                      F.col("amount_usd").cast("double").alias("amount_usd"), "velocity_1h")
    return top_per_group(t, "customer_id", [("timestamp", True), ("id", True)], PROFILE_TXNS)


def _profile_alerts(m: Monitor) -> DataFrame:
    a = m.alerts_wide().select("customer_id", F.col("alert_id").alias("id"), "score", "status", "created_date", "rule_name",
                               "category")
    return top_per_group(a, "customer_id", [("score", True), ("id", False)], PROFILE_ALERTS)


def h05_customer_profiles(m: Monitor) -> DataFrame:
    """One row per customer: the customer, its country, how many accounts it has and the first
    PROFILE_ACCOUNTS of them, its last PROFILE_TXNS transactions, its alert summary and its
    PROFILE_ALERTS highest alerts.

    Lists are cut before they are collected, so none is longer than its bound; the accounts beyond
    are found by ``seek`` from the last one listed.
    """
    def listed(rows: DataFrame, name: str) -> DataFrame:
        fields = F.struct("rank", *[c for c in rows.columns if c not in ("customer_id", "rank")])
        return rows.groupBy("customer_id").agg(F.sort_array(F.collect_list(fields)).alias(name))

    n_acc = m.accounts.groupBy("customer_id").agg(F.count("*").alias("n_accounts"))
    t = m.fired.groupBy("customer_id").agg(  # the alerts of a row stand on it
        F.sum(F.size("hits")).cast("bigint").alias("total_alerts"),
        F.sum(F.size(F.filter("hits", lambda h: h["composite_score"] >= 60))).cast("bigint").alias("high_alerts"),
        F.sum(F.aggregate("hits", F.lit(0).cast("decimal(20,2)"), lambda x, h: (x + h["composite_score"]).cast("decimal(20,2)"))).alias("_s"),
        F.max(F.array_max(F.transform("hits", lambda h: h["composite_score"]))).cast("double").alias("max_score"))
    cr = F.broadcast(m.country_risk.select(F.col("country_code").alias("country"), "country_name",
                                           F.col("risk_level").alias("country_risk_level")))  # bounded
    c = m.customers.join(cr, "country").withColumnRenamed("id", "customer_id")
    out = c
    for part in (n_acc, listed(_profile_accounts(m), "accounts"), listed(_profile_transactions(m), "recent_transactions"),
                 t, listed(_profile_alerts(m), "recent_alerts")):
        out = out.join(part, "customer_id", "left")
    n = F.coalesce("total_alerts", F.lit(0))
    return out.withColumn("total_alerts", n).withColumn("high_alerts", F.coalesce("high_alerts", F.lit(0))).withColumn(
        "n_accounts", F.coalesce("n_accounts", F.lit(0))).withColumn(
        "avg_score", rnd(F.try_divide(F.col("_s"), F.nullif(F.col("total_alerts"), F.lit(0))), 1)).drop("_s")


def h05_profile_summary(m: Monitor) -> DataFrame:
    """The profiles without their lists, and how long those are."""
    p = h05_customer_profiles(m)
    size = lambda c: F.coalesce(F.size(c), F.lit(0)).alias(f"n_{c}")
    return p.select("customer_id", "name", "customer_type", "risk_rating", "country", "registration_date", "kyc_status",
                    "pep_status", "country_name", "country_risk_level", F.col("n_accounts").alias("accounts_held"),
                    "total_alerts", "high_alerts", "avg_score", "max_score", size("accounts"), size("recent_transactions"),
                    size("recent_alerts"))


def _exploded(name: str):
    def rows(m: Monitor) -> DataFrame:
        return h05_customer_profiles(m).select("customer_id", F.explode(name).alias("x")).select("customer_id", "x.*")
    return rows


def b7_transaction_pages(m: Monitor, per_page: int = MAX_PAGE) -> DataFrame:
    """The directory of H2's pages, by their first keys."""
    d = page_directory(m.transactions.select("timestamp", "id"), TXN_ORDER, per_page)
    return d.select("page", F.col("timestamp").alias("first_timestamp"), F.col("id").alias("first_id"),
                    F.col("rows").alias("page_rows"), "total", "pages")


def b7_page_by_key(m: Monitor, page: int = 7, per_page: int = 100) -> DataFrame:
    """A page read from its first key in the directory."""
    t = m.transactions.select("id", "timestamp", "account_id", F.col("amount").cast("double").alias("amount"))
    key = page_directory(t, TXN_ORDER, per_page).where(F.col("page") == page).first()
    return seek(t, TXN_ORDER, per_page, key.asDict(), inclusive=True) if key else t.limit(0)


def h06_rules(m: Monitor) -> DataFrame:
    per = m.alerts.groupBy("rule_id").agg(F.count("*").alias("alert_count"),
                                          F.sum(F.col("score").cast("decimal(5,2)")).alias("_s"))
    r = m.rules
    return (r.join(per, r["id"] == per["rule_id"], "left")
            .select("id", "name", "description", "category", "severity", "is_active",
                    F.coalesce("alert_count", F.lit(0)).cast("bigint").alias("alert_count"),
                    rnd(F.col("_s") / F.col("alert_count"), 1).alias("avg_score"))
            .orderBy("category", "name"))


def h07_timeline(m: Monitor) -> DataFrame:
    t = m.weighted()
    g = t.groupBy(month_key("timestamp").alias("month")).agg(
        F.sum("w").alias("transaction_count"), F.sum(F.col("amount_usd") * F.col("w")).alias("_usd"),
        F.sum("n_alerts").alias("alert_count"), F.sum("n_alerts_60").alias("high_alerts"))
    return g.select("month", "transaction_count", rnd("_usd", 0).alias("total_volume_usd"), "alert_count",
                    "high_alerts").orderBy("month")


def h08_risk_distribution(m: Monitor) -> DataFrame:
    t = m.weighted().groupBy("customer_id").agg(
        F.count("*").alias("_n"), F.sum("n_alerts").alias("_a"), F.sum("score_sum").alias("_s"))
    c = m.customers
    j = c.join(t, c["id"] == t["customer_id"], "left")
    g = j.groupBy("risk_rating").agg(
        F.count("*").alias("customers"), F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("transactions"),
        F.coalesce(F.sum("_a"), F.lit(0)).cast("bigint").alias("alerts"), F.sum("_s").alias("_s"))
    return g.select("risk_rating", "customers", "transactions", "alerts",
                    rnd(F.try_divide(F.col("_s"), F.nullif(F.col("alerts"), F.lit(0))), 1).alias("avg_alert_score")
                    ).orderBy("risk_rating")


def h09_rule_performance(m: Monitor) -> DataFrame:
    a = m.alerts_wide()
    per = a.groupBy("rule_id").agg(
        F.count("*").alias("total_alerts"), F.sum(F.col("score").cast("decimal(5,2)")).alias("_s"),
        F.min("score").alias("_mn"), F.max("score").alias("_mx"),
        F.countDistinct("account_id").alias("unique_accounts"),
        F.sum((F.col("score") >= 60).cast("int")).cast("bigint").alias("high_score_alerts"))
    r = m.rules.filter("is_active = 1")
    return (r.join(per, r["id"] == per["rule_id"], "left")
            .select("id", "name", "category", "severity",
                    F.coalesce("total_alerts", F.lit(0)).cast("bigint").alias("total_alerts"),
                    rnd(F.col("_s") / F.col("total_alerts"), 2).alias("avg_score"), rnd("_mn", 2).alias("min_score"),
                    rnd("_mx", 2).alias("max_score"),
                    F.coalesce("unique_accounts", F.lit(0)).cast("bigint").alias("unique_accounts"),
                    F.coalesce("high_score_alerts", F.lit(0)).cast("bigint").alias("high_score_alerts"))
            .orderBy(F.desc("total_alerts"), "id"))


def h10_geographic(m: Monitor, k: int = 40) -> DataFrame:
    t = m.weighted()
    g = t.groupBy("counterparty_country").agg(
        F.sum("w").alias("transaction_count"), F.sum(F.col("amount_usd") * F.col("w")).alias("_usd"),
        F.sum("n_alerts").alias("alert_count"))
    cr = F.broadcast(m.country_risk)  # bounded: one row per country
    return (g.join(cr, g["counterparty_country"] == cr["country_code"], "left")
            .select(F.coalesce("counterparty_country", F.lit("DOMESTIC")).alias("country_code"), "country_name",
                    "risk_level", "transaction_count", rnd("_usd", 0).alias("total_usd"), "alert_count")
            .orderBy(F.desc("alert_count"), "country_code").limit(k))


def h11_top_customers(m: Monitor, k: int = 20) -> DataFrame:
    t = m.weighted()
    g = t.groupBy("customer_id").agg(
        F.sum("n_alerts").alias("total_alerts"), F.max("score_max").alias("_mx"), F.sum("score_sum").alias("_s"),
        F.count("*").alias("total_transactions"), F.sum(F.col("amount_usd") * F.col("w")).alias("_usd"))
    g = g.filter(F.col("total_alerts") > 0).withColumn("max_score", rnd("_mx", 1))
    top = g.orderBy(F.desc("max_score"), F.desc("total_alerts"), "customer_id").limit(k)
    c = m.customers
    return top.join(c, top["customer_id"] == c["id"]).select(
        "id", "name", "customer_type", "risk_rating", "country", "pep_status", "kyc_status", "total_alerts",
        "max_score", rnd(F.col("_s") / F.col("total_alerts"), 1).alias("avg_score"), "total_transactions",
        rnd("_usd", 0).alias("total_volume_usd"))


def x01_transactions_export(m: Monitor) -> DataFrame:
    c = m.customers.select(F.col("id").alias("customer_id"), F.col("name").alias("customer_name"),
                           "risk_rating", "customer_type")
    return m.wide.join(c, "customer_id").select(
        "id", "account_id", "transaction_type", F.col("amount").cast("double").alias("amount"), "currency",
        "timestamp", "counterparty_account", "counterparty_name", "counterparty_country", "channel", "status",
        F.col("amount_usd").cast("double").alias("amount_usd"), "is_round_amount", "is_large_cash",
        "velocity_1h", "velocity_24h", "velocity_7d",
        F.col("amount_velocity_24h").cast("double").alias("amount_velocity_24h"), "country_risk_score",
        "is_new_counterparty", "account_age_days", "customer_id", "customer_name", "risk_rating",
        "customer_type")


def x02_alerts_export(m: Monitor) -> DataFrame:
    a = _alert_rows(m)
    return a.select(
        "alert_id", "score", "status", "created_date", "resolved_date", "rule_name", "category", "severity",
        "transaction_id", "transaction_type", "amount", "currency", "timestamp", "counterparty_country",
        "customer_id", "customer_name", "risk_rating", "customer_type", "pep_status", "rule_score",
        "customer_risk_score", "geographic_risk_score", "behavioral_score")


def x03_customer_risk_summary(m: Monitor) -> DataFrame:
    t = m.weighted().groupBy("customer_id").agg(
        F.count("*").alias("transaction_count"), F.sum(F.col("amount_usd") * F.col("w")).alias("_usd"),
        F.sum("n_alerts").alias("total_alerts"), F.max("score_max").alias("_mx"), F.sum("score_sum").alias("_s"))
    n_acc = m.accounts.groupBy("customer_id").agg(F.count("*").alias("account_count"))
    cr = F.broadcast(m.country_risk.select(F.col("country_code").alias("country"),
                                           F.col("risk_level").alias("country_risk_level")))  # bounded
    c = m.customers.join(cr, "country").withColumnRenamed("id", "customer_id")
    j = c.join(n_acc, "customer_id", "left").join(t, "customer_id", "left")
    return j.select(
        F.col("customer_id").alias("id"), "name", "customer_type", "risk_rating", "country", "kyc_status",
        "pep_status", "registration_date", "country_risk_level",
        F.coalesce("account_count", F.lit(0)).cast("bigint").alias("account_count"),
        F.coalesce("transaction_count", F.lit(0)).cast("bigint").alias("transaction_count"),
        rnd("_usd", 2).alias("total_volume_usd"),
        F.coalesce("total_alerts", F.lit(0)).cast("bigint").alias("total_alerts"),
        rnd("_mx", 2).alias("max_alert_score"),
        rnd(F.try_divide(F.col("_s"), F.nullif(F.col("total_alerts"), F.lit(0))), 2).alias("avg_alert_score"),
    )


def x04_quick_stats(m: Monitor) -> DataFrame:
    s = h01_stats(m)
    return s.select("customers", "accounts", "transactions", "alerts",
                    rnd(F.col("total_volume_usd") / 1e9, 2).alias("volume_billions"), "open_alerts",
                    "high_score_alerts")


# The exports and the order of their rows
EXPORTS = {
    "transactions": (x01_transactions_export, [("timestamp", False), ("id", False)]),
    "alerts": (x02_alerts_export, [("score", True), ("alert_id", False)]),
    "customer_risk_summary": (x03_customer_risk_summary, [("max_alert_score", True), ("total_alerts", True), ("id", False)]),
}


def export_csv(m: Monitor, name: str, path: str, limit: int | None = None) -> str:
    """One of EXPORTS as ordered CSV files."""
    rows, order = EXPORTS[name]
    return write_ordered(rows(m), order, path, limit)


def _read_back(name: str):
    def rows(m: Monitor) -> DataFrame:
        """Written as CSV and read back with the export's own types."""
        df = EXPORTS[name][0](m)
        path = export_csv(m, name, f"{checkpoint_dir(m.spark).rstrip('/')}/export/{name}-{uuid.uuid4().hex}")
        return m.spark.read.schema(df.schema).option("header", True).option("encoding", "UTF-8").csv(path)
    return rows


ALL = {
    "h01_stats": h01_stats,
    "h02_transactions": h02_transactions,
    "h02_alerted_wires": lambda m: h02_transactions(m, txn_type="wire_out", min_amount=1000, alerted_only=True),
    "h02_before_date": lambda m: h02_transactions(m, end_date="1998-01-01", page=2, per_page=200),
    "h03_alerts": h03_alerts,
    "h03_geographic": lambda m: h03_alerts(m, min_score=50.0, category="geographic"),
    "h04_alert_detail": h04_alert_detail,
    "h05_customer_profiles": h05_customer_profiles,
    "h05_profile_summary": h05_profile_summary,
    "h05_profile_accounts": _exploded("accounts"),
    "h05_profile_transactions": _exploded("recent_transactions"),
    "h05_profile_alerts": _exploded("recent_alerts"),
    "b7_transaction_pages": b7_transaction_pages,
    "b7_page_by_key": b7_page_by_key,
    "s10_transactions_csv": _read_back("transactions"),
    "s11_alerts_csv": _read_back("alerts"),
    "s12_customer_risk_csv": _read_back("customer_risk_summary"),
    "h06_rules": h06_rules,
    "h07_timeline": h07_timeline,
    "h08_risk_distribution": h08_risk_distribution,
    "h09_rule_performance": h09_rule_performance,
    "h10_geographic": h10_geographic,
    "h11_top_customers": h11_top_customers,
    "x01_transactions_export": x01_transactions_export,
    "x02_alerts_export": x02_alerts_export,
    "x03_customer_risk_summary": x03_customer_risk_summary,
    "x04_quick_stats": x04_quick_stats,
}
