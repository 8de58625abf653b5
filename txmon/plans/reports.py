"""Report aggregates on the report model (M, G, C, V, Y families).

Every "now" is the model's ``as_of`` date, so results repeat.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txmon.functions.money import rnd
from txmon.functions.timefn import floor_days, micros, monday_week_key, month_key, ts_lit
from txmon.plans.showcase import rule_figures
from txmon.sources.report import Report

SEVERITY_RANK = {"critical": 1, "high": 2, "medium": 3, "low": 4}
ACTIVE = ("new", "under_review", "escalated")


def _sev_rank(col):
    e = None
    for k, v in SEVERITY_RANK.items():
        e = F.when(col == k, v) if e is None else e.when(col == k, v)
    return e.otherwise(5)


def _pct_change(cur, prev):
    return F.when(prev != 0, rnd((cur - prev) * 100.0 / prev, 1)).otherwise(F.lit(0.0))


def m1_month_over_month(r: Report) -> DataFrame:
    """Alerts and flagged amount in the run month against the previous month."""
    first = dt.date.fromisoformat(r.as_of).replace(day=1)
    before = (first - dt.timedelta(days=1)).replace(day=1)
    after = (first + dt.timedelta(days=31)).replace(day=1)
    bound = lambda d: F.lit(d.isoformat()).cast("timestamp_ntz")
    t = F.col("created_at")
    cur, prev = t >= bound(first), t < bound(first)
    # half-open bounds on the column itself: they reach the scan
    g = r.alerts.where((t >= bound(before)) & (t < bound(after))).agg(
        F.count(F.when(cur, 1)).alias("alerts_this_month"), F.count(F.when(prev, 1)).alias("alerts_prev_month"),
        F.coalesce(F.sum(F.when(cur, F.col("flagged_amount"))), F.lit(0)).alias("_a"),
        F.coalesce(F.sum(F.when(prev, F.col("flagged_amount"))), F.lit(0)).alias("_b"))
    return g.select("alerts_this_month", "alerts_prev_month", rnd("_a", 2).alias("amount_this_month"),
                    rnd("_b", 2).alias("amount_prev_month"),
                    _pct_change(F.col("alerts_this_month"), F.col("alerts_prev_month")).alias("alerts_change_pct"),
                    _pct_change(F.col("_a"), F.col("_b")).alias("amount_change_pct"))


def m2_filing(r: Report) -> DataFrame:
    """Filed = true_positive + escalated; filing rate; still-open remainder."""
    s = F.col("status")
    g = r.alerts.agg(F.count("*").alias("total_alerts"),
                     F.sum(s.isin("true_positive", "escalated").cast("int")).cast("bigint").alias("filed"),
                     F.sum(s.isin("new", "under_review").cast("int")).cast("bigint").alias("open_remainder"))
    return g.withColumn("filing_rate_pct", rnd(F.col("filed") * 100.0 / F.col("total_alerts"), 1))


def m3_by_severity(r: Report) -> DataFrame:
    g = r.alerts.groupBy("severity").agg(F.count("*").alias("alerts"),
                                         F.sum("flagged_amount").alias("_s"))
    return g.select(_sev_rank(F.col("severity")).alias("severity_rank"), "severity", "alerts",
                    rnd("_s", 2).alias("flagged_amount")).orderBy("severity_rank")


def m3_by_category(r: Report) -> DataFrame:
    rules = F.broadcast(r.rules.select("rule_id", "rule_category"))  # bounded catalogue
    g = r.alerts.join(rules, "rule_id").groupBy("rule_category").agg(
        F.count("*").alias("alerts"), F.sum("flagged_amount").alias("_s"))
    from pyspark.sql import Window
    total = F.sum("alerts").over(Window.partitionBy())  # a handful of categories
    return g.select("rule_category", "alerts", rnd(F.col("alerts") * 100.0 / total, 1).alias("share_pct"),
                    rnd(F.col("_s") / F.col("alerts"), 2).alias("avg_amount"), rnd("_s", 2).alias("total_amount"))


def m5_category_trend(r: Report, months: int = 6) -> DataFrame:
    """Category x month counts for the last ``months`` months up to the run month, zero filled (pivot)."""
    end = F.lit(r.as_of).cast("date")
    month_list = F.sequence(F.trunc(F.add_months(end, -(months - 1)), "month"), F.trunc(end, "month"),
                            F.expr("interval 1 month"))
    cats = r.rules.select("rule_category").distinct()
    grid = cats.crossJoin(r.alerts.sparkSession.range(1).select(
        F.explode(month_list).alias("_m"))).select("rule_category", F.date_format("_m", "yyyy-MM").alias("month"))
    rules = F.broadcast(r.rules.select("rule_id", "rule_category"))
    counts = (r.alerts.join(rules, "rule_id").groupBy("rule_category", month_key("created_at").alias("month"))
              .agg(F.count("*").alias("_n")))
    return grid.join(counts, ["rule_category", "month"], "left").select(
        "rule_category", "month", F.coalesce("_n", F.lit(0)).cast("bigint").alias("alerts"))


def g1_rule_quadrants(r: Report, cut: float = 0.65) -> DataFrame:
    p, q = F.col("precision_score"), F.col("recall_score")
    quad = (F.when((p >= cut) & (q >= cut), "Champion").when((p < cut) & (q >= cut), "Noisy")
            .when((p >= cut) & (q < cut), "Conservative").otherwise("Needs Review"))
    return rule_figures(r).select("rule_id", "rule_name", "rule_category", rnd(p, 4).alias("precision"),
                          rnd(q, 4).alias("recall"), rnd(2 * p * q / (p + q + 0.0001), 4).alias("f1"),
                          quad.alias("quadrant"))


def c1_risk_distribution(r: Report) -> DataFrame:
    acc = r.accounts.select(F.col("account_id").alias("_a"), "customer_id")
    vol = (r.transactions.join(acc, r.transactions["account_id"] == acc["_a"]).groupBy("customer_id")
           .agg(F.sum("amount").alias("_v")))
    j = r.customers.join(vol, "customer_id", "left")
    return j.groupBy("risk_rating").agg(F.count("*").alias("customers"),
                                        rnd(F.coalesce(F.sum("_v"), F.lit(0)), 2).alias("volume"))


def c3_alert_histogram(r: Report, bins: int = 12) -> DataFrame:
    """Alerts per customer, bucketed with a data-dependent width max(1, max // bins)."""
    per = r.alerts.groupBy("customer_id").agg(F.count("*").alias("n"))
    size = per.agg(F.greatest(F.lit(1), F.floor(F.max("n") / bins)).alias("_size"))
    return (per.crossJoin(F.broadcast(size))  # one row
            .groupBy((F.floor(F.col("n") / F.col("_size")) * F.col("_size")).cast("bigint").alias("bucket"))
            .agg(F.count("*").alias("customers")))


def v1_executive_kpis(r: Report) -> DataFrame:
    s = F.col("status")
    closed = s.isin("true_positive", "false_positive")
    days = (micros("updated_at") - micros("created_at")) / 86400e6
    a = r.alerts.agg(
        F.sum(s.isin(*ACTIVE).cast("int")).cast("bigint").alias("active_alerts"),
        *[F.sum((s.isin(*ACTIVE) & (F.col("severity") == k)).cast("int")).cast("bigint").alias(f"active_{k}")
          for k in SEVERITY_RANK],
        rnd(F.sum(closed.cast("int")) * 100.0 / F.count("*"), 1).alias("closure_pct"),
        rnd(F.avg(F.when(closed, days)), 1).alias("mean_days_to_close"),
        rnd(F.sum("flagged_amount"), 2).alias("flagged_total"))
    t = r.transactions.agg(F.count("*").alias("transactions"))
    c = r.customers.agg(F.sum(F.col("risk_rating").isin("high", "critical").cast("int")).cast("bigint")
                        .alias("high_risk_customers"))
    return t.crossJoin(a).crossJoin(c)  # one-row sides


def v2_weekly_series(r: Report, weeks: int = 12) -> DataFrame:
    """Transactions and alerts per Monday week in the last ``weeks`` weeks, merged with zeros."""
    lo = F.date_sub(F.lit(r.as_of).cast("date"), weeks * 7)
    tx = (r.transactions.filter(F.to_date("transaction_date") >= lo)
          .groupBy(monday_week_key("transaction_date").alias("week")).agg(F.count("*").alias("_t")))
    al = (r.alerts.filter(F.to_date("created_at") >= lo)
          .groupBy(monday_week_key("created_at").alias("week")).agg(F.count("*").alias("_a")))
    return tx.join(al, "week", "full_outer").select(
        "week", F.coalesce("_t", F.lit(0)).cast("bigint").alias("transactions"),
        F.coalesce("_a", F.lit(0)).cast("bigint").alias("alerts"))


def y1_triage_queue(r: Report, k: int = 30) -> DataFrame:
    a = r.alerts.filter(F.col("status").isin(*ACTIVE))
    return (a.select("alert_id", "customer_id", "rule_id", "severity", "status", "created_at",
                     rnd("flagged_amount", 2).alias("flagged_amount"), _sev_rank(F.col("severity")).alias("_r"))
            .orderBy("_r", F.desc("created_at"), "alert_id").limit(k).drop("_r"))


def d05_freshness(r: Report) -> DataFrame:
    """Days from the latest transaction to the run date (floored; -1 when it is later the same day)."""
    return r.transactions.agg(F.max("transaction_date").alias("latest")).select(
        "latest", floor_days(ts_lit(f"{r.as_of} 00:00:00"), "latest").alias("freshness_days"))


def m4_top_alerts(r: Report, k: int = 5) -> DataFrame:
    """The worst alerts: by severity, then flagged amount."""
    rules = F.broadcast(r.rules.select("rule_id", "rule_name", "rule_category"))  # bounded catalogue
    names = r.customers.select("customer_id", F.col("name").alias("customer_name"))
    top = r.alerts.orderBy(_sev_rank(F.col("severity")), F.desc("flagged_amount"), "alert_id").limit(k)
    return top.join(rules, "rule_id").join(names, "customer_id").select(
        "alert_id", "created_at", "customer_id", "customer_name", "rule_name", "rule_category",
        rnd("flagged_amount", 2).alias("flagged_amount"), "severity", "status")


def c5_kyc_distribution(r: Report) -> DataFrame:
    return r.customers.groupBy("kyc_status").agg(F.count("*").alias("customers"))


def c6_pep_sanctions(r: Report) -> DataFrame:
    """Counts of exposed and sanctioned customers, in all and by the two upper ratings."""
    def both(flag: str, rating: str):
        return F.sum(((F.col(flag) == 1) & (F.col("risk_rating") == rating)).cast("int")).cast("bigint")
    return r.customers.agg(
        F.sum("pep_flag").cast("bigint").alias("pep_count"), F.sum("sanctions_flag").cast("bigint").alias("sanctions_count"),
        *[both(flag, rating).alias(f"{name}_{rating}") for name, flag in (("pep", "pep_flag"), ("sanctions", "sanctions_flag"))
          for rating in ("critical", "high")])


def v5_workload(r: Report, k: int = 8) -> DataFrame:
    """Alerts per analyst, those without one together."""
    s = F.col("status")
    return (r.alerts.groupBy(F.coalesce("assigned_to", F.lit("Unassigned")).alias("analyst")).agg(
        F.count("*").alias("alerts"), F.sum((s == "true_positive").cast("int")).cast("bigint").alias("true_positives"),
        F.sum((s == "false_positive").cast("int")).cast("bigint").alias("false_positives"))
        .orderBy(F.desc("alerts"), "analyst").limit(k))


def v3_top_rules(r: Report, k: int = 10) -> DataFrame:
    rules = F.broadcast(r.rules.select("rule_id", "rule_name"))  # bounded catalogue
    return (r.alerts.groupBy("rule_id").agg(F.count("*").alias("alerts")).join(rules, "rule_id")
            .select("rule_name", "alerts").orderBy(F.desc("alerts"), "rule_name").limit(k))


ALL = {
    "m4_top_alerts": m4_top_alerts,
    "c5_kyc_distribution": c5_kyc_distribution,
    "c6_pep_sanctions": c6_pep_sanctions,
    "v3_top_rules": v3_top_rules,
    "v5_workload": v5_workload,
    "m1_month_over_month": m1_month_over_month,
    "m2_filing": m2_filing,
    "m3_by_severity": m3_by_severity,
    "m3_by_category": m3_by_category,
    "m5_category_trend": m5_category_trend,
    "g1_rule_quadrants": g1_rule_quadrants,
    "c1_risk_distribution": c1_risk_distribution,
    "c3_alert_histogram": c3_alert_histogram,
    "v1_executive_kpis": v1_executive_kpis,
    "v2_weekly_series": v2_weekly_series,
    "y1_triage_queue": y1_triage_queue,
    "d05_freshness": d05_freshness,
}
