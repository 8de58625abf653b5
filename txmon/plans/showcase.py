"""The 16 showcase queries on the report model.

Per-key windows whose key may be hot are rewritten: "rank = 1 per customer"
as a max aggregate joined back, running totals as a two-level prefix sum
(per month, then inside the month), NTILE over all rows with a
range-partitioned global index.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txmon.functions.money import rnd
from txmon.functions.timefn import julian_days, month_key, weekday_sun0
from txmon.operators.joins import broadcast_if_small
from txmon.operators.ranking import global_ntile
from txmon.plans.monitor_queries import DAY_NAMES
from txmon.sources.report import Report


def _with_customer(r: Report) -> DataFrame:
    acc = broadcast_if_small(r.accounts.select(F.col("account_id").alias("_acct"), "customer_id"))
    t = r.transactions
    return t.join(acc, t["account_id"] == acc["_acct"]).drop("_acct")


def k01_largest_transaction(r: Report) -> DataFrame:
    t = _with_customer(r)
    per = t.groupBy("customer_id").agg(F.max("amount").alias("_max"), F.count("*").alias("total_txns"),
                                       F.sum("amount").alias("_sum"))
    top = t.join(per, "customer_id").filter(F.col("amount") == F.col("_max"))  # RANK() = 1, ties kept
    c = r.customers.select("customer_id", F.col("name").alias("customer_name"))
    return (top.join(c, "customer_id")
            .select("customer_id", "customer_name", "transaction_id", F.col("amount").cast("double").alias("amount"),
                    "transaction_date", F.lit(1).alias("amount_rank"), "total_txns",
                    rnd(F.col("amount") / F.col("_sum") * 100, 2).alias("pct_of_customer_total"))
            .orderBy(F.desc("amount"), "customer_id", "transaction_id").limit(10))


def k02_rolling_velocity(r: Report) -> DataFrame:
    daily = r.transactions.groupBy("account_id", F.to_date("transaction_date").alias("txn_day")).agg(
        F.count("*").alias("daily_count"), F.sum("amount").alias("_amt"))
    w = Window.partitionBy("account_id").orderBy("txn_day").rowsBetween(-6, 0)  # active days, not calendar days
    return (daily.select("account_id", "txn_day", "daily_count",
                         F.sum("daily_count").over(w).alias("rolling_7d_count"),
                         rnd(F.sum("_amt").over(w), 2).alias("rolling_7d_amount"))
            .orderBy(F.desc("rolling_7d_count"), F.desc("rolling_7d_amount"), "account_id", "txn_day").limit(10))


def k03_mom_volume(r: Report) -> DataFrame:
    m = r.transactions.groupBy(month_key("transaction_date").alias("month")).agg(
        F.count("*").alias("txn_count"), F.round(F.sum("amount"), 2).alias("_vol"))
    prev = F.lag("_vol").over(Window.orderBy("month"))  # one row per month
    return m.select("month", "txn_count", F.col("_vol").cast("double").alias("total_volume"),
                    prev.cast("double").alias("prev_month_volume"),
                    rnd(F.try_divide(F.col("_vol") - prev, prev) * 100, 2).alias("mom_pct_change")
                    ).orderBy("month").limit(10)


def running_sum(df: DataFrame, key: str, order: list[str], value: str, bucket: str, out: str) -> DataFrame:
    """Prefix sum per ``key`` in ``order``; two levels so one hot key spans many tasks.

    Inside (key, bucket) a rows-frame window; across buckets the exclusive
    prefix of the bucket totals (a small table) is added.
    """
    inner = Window.partitionBy(key, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    d = df.withColumn("_in", F.sum(value).over(inner))
    tot = df.groupBy(key, bucket).agg(F.sum(value).alias("_bt"))
    wb = Window.partitionBy(key).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.withColumn("_off", F.coalesce(F.sum("_bt").over(wb), F.lit(0))).drop("_bt")
    return d.join(tot, [key, bucket]).withColumn(out, F.col("_in") + F.col("_off")).drop("_in", "_off")


def k04_running_total(r: Report, threshold: float = 100000) -> DataFrame:
    t = _with_customer(r).withColumn("_b", month_key("transaction_date"))
    run = running_sum(t, "customer_id", ["transaction_date", "transaction_id"], "amount", "_b", "_run")
    run = run.filter(F.col("_run") >= threshold)
    top = run.orderBy("customer_id", "transaction_date", "transaction_id").limit(10)
    c = r.customers.select("customer_id", F.col("name").alias("customer_name"))
    return top.join(c, "customer_id").select(
        "customer_id", "customer_name", "transaction_date", rnd("amount", 2).alias("txn_amount"),
        rnd("_run", 2).alias("running_total"))


def k05_percentile_buckets(r: Report, wanted=(50, 75, 90, 95, 99)) -> DataFrame:
    p = global_ntile(r.transactions.select("amount"), "amount", 100, "percentile")
    return (p.filter(F.col("percentile").isin(*wanted)).groupBy("percentile")
            .agg(rnd(F.min("amount"), 2).alias("min_in_bucket"), rnd(F.max("amount"), 2).alias("max_in_bucket"),
                 F.count("*").alias("txn_count")).orderBy("percentile"))


def k06_critical_alert_chain(r: Report) -> DataFrame:
    a = r.alerts
    crit = a.filter(F.col("severity") == "critical").select("customer_id", "flagged_amount")
    per = a.groupBy("customer_id").agg(F.count("*").alias("total_alerts"),
                                       F.round(F.sum("flagged_amount"), 2).alias("_tot"))
    n_all = a.agg(F.count("*").alias("_all"))  # one row
    c = r.customers.select("customer_id", "name", "risk_rating", "kyc_status")
    e = (crit.join(c, "customer_id").join(per, "customer_id").crossJoin(F.broadcast(n_all))
         .select("customer_id", "name", "risk_rating", "kyc_status",
                 rnd("flagged_amount", 2).alias("critical_flagged_amt"), "total_alerts",
                 F.col("_tot").cast("double").alias("total_flagged_amount"),
                 rnd(F.col("total_alerts") / F.col("_all") * 100, 2).alias("alert_rate_pct")))
    return e.distinct().orderBy(F.desc("total_alerts"), F.desc("critical_flagged_amt"), "customer_id").limit(10)


def k07_structuring_days(r: Report, lo: float = 8000, hi: float = 9999, min_count: int = 3) -> DataFrame:
    t = _with_customer(r).filter(F.col("amount").between(lo, hi))
    g = (t.groupBy("customer_id", F.to_date("transaction_date").alias("txn_day"))
         .agg(F.count("*").alias("txn_count"), F.round(F.sum("amount"), 2).alias("_tot"),
              F.min("amount").alias("_mn"), F.max("amount").alias("_mx"))
         .filter(F.col("txn_count") >= min_count))
    c = r.customers.select("customer_id", "name", "risk_rating", "kyc_status")
    return (g.join(c, "customer_id")
            .select("customer_id", "txn_day", "txn_count", F.col("_tot").cast("double").alias("day_total"),
                    rnd("_mn", 2).alias("min_amt"), rnd("_mx", 2).alias("max_amt"), "name", "risk_rating",
                    "kyc_status")
            .orderBy(F.desc("txn_count"), F.desc("day_total"), "customer_id", "txn_day").limit(10))


def k08_value_tiers(r: Report) -> DataFrame:
    t = _with_customer(r)
    vol = t.groupBy("customer_id").agg(F.round(F.sum("amount"), 2).alias("lifetime_volume"))
    v = F.col("lifetime_volume")
    tier = (F.when(v >= 500000, "Platinum").when(v >= 200000, "Gold").when(v >= 50000, "Silver")
            .otherwise("Bronze"))
    n_al = r.alerts.groupBy("customer_id").agg(F.count("*").alias("_n"))
    j = vol.join(n_al, "customer_id", "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    j = j.withColumn("_w", F.greatest(F.col("_n"), F.lit(1)))  # LEFT JOIN alerts fan-out
    g = j.groupBy(tier.alias("tier")).agg(
        F.count("*").alias("customers"), F.sum(v * F.col("_w")).alias("_vw"), F.sum("_w").alias("_w"),
        F.sum("_n").alias("total_alerts"))
    return g.select("tier", "customers", rnd(F.col("_vw") / F.col("_w"), 2).alias("avg_volume"),
                    F.col("total_alerts").cast("bigint").alias("total_alerts"),
                    rnd(F.col("total_alerts") / F.col("customers"), 2).alias("avg_alerts_per_customer")
                    ).orderBy(F.desc("avg_volume"))


def _alerts_rules(r: Report) -> DataFrame:
    rules = F.broadcast(r.rules.select("rule_id", "rule_name", "rule_category"))  # bounded catalogue
    return r.alerts.join(rules, "rule_id")


def k09_three_way(r: Report) -> DataFrame:
    a = _alerts_rules(r)
    g = a.groupBy("rule_category", "severity", "status").agg(
        F.count("*").alias("alert_count"), F.sum("flagged_amount").alias("_s"),
        F.sum((F.col("severity") == "critical").cast("int")).cast("bigint").alias("critical_count"),
        F.sum(F.col("status").isin("true_positive", "escalated").cast("int")).cast("bigint").alias("confirmed_count"))
    return g.select("rule_category", "severity", "status", "alert_count", rnd("_s", 2).alias("total_flagged"),
                    rnd(F.col("_s") / F.col("alert_count"), 2).alias("avg_flagged"), "critical_count",
                    "confirmed_count").orderBy(F.desc("total_flagged"), "rule_category", "severity", "status").limit(10)


def rule_figures(r: Report) -> DataFrame:
    """The rule catalogue with figures counted from the alerts: precision is the share of true positives
    among the decided, recall their share among the confirmed or escalated; 0 without any."""
    status = lambda s: F.sum((F.col("status") == s).cast("int")).cast("int")
    per = r.alerts.groupBy("rule_id").agg(
        F.count("*").cast("int").alias("total_alerts_generated"), status("true_positive").alias("true_positives"),
        status("false_positive").alias("false_positives"), status("escalated").alias("_escalated"))
    rules = r.rules.select("rule_id", "rule_name", "rule_category", "enabled")
    n = {c: F.coalesce(F.col(c), F.lit(0)) for c in
         ("total_alerts_generated", "true_positives", "false_positives", "_escalated")}
    tp, fp, esc = (n[c].cast("double") for c in ("true_positives", "false_positives", "_escalated"))
    share = lambda part, rest: F.coalesce(F.try_divide(part, part + rest), F.lit(0.0))
    return rules.join(per, "rule_id", "left").select(
        "rule_id", "rule_name", "rule_category", "enabled", *[n[c].alias(c) for c in list(n)[:3]],
        share(tp, fp).alias("precision_score"), share(tp, esc).alias("recall_score"))


def k10_rule_f1(r: Report) -> DataFrame:
    p, q = F.col("precision_score"), F.col("recall_score")
    tp, fp = F.col("true_positives"), F.col("false_positives")
    return (rule_figures(r).filter("enabled = 1").select(
        "rule_id", "rule_name", "rule_category", "true_positives", "false_positives", "total_alerts_generated",
        rnd(tp.cast("double") / (tp + fp + 0.0001), 4).alias("precision_sql"),
        rnd(p, 4).alias("precision_stored"), rnd(q, 4).alias("recall_stored"),
        rnd(2.0 * p * q / (p + q + 0.0001), 4).alias("f1_score")).orderBy(F.desc("f1_score"), "rule_id"))


def k11_large_weekday_hour(r: Report, min_amount: float = 10000) -> DataFrame:
    t = r.transactions.filter(F.col("amount") > min_amount)
    names = F.array(*[F.lit(d) for d in DAY_NAMES])
    g = t.groupBy(F.element_at(names, weekday_sun0("transaction_date") + 1).alias("day_of_week"),
                  F.hour("transaction_date").alias("hour_of_day")).agg(
        F.count("*").alias("txn_count"), F.sum("amount").alias("_s"), F.max("amount").alias("_mx"))
    return g.select("day_of_week", "hour_of_day", "txn_count", rnd(F.col("_s") / F.col("txn_count"), 2).alias("avg_amount"),
                    rnd("_mx", 2).alias("max_amount")
                    ).orderBy(F.desc("avg_amount"), "day_of_week", "hour_of_day").limit(10)


def k12_dormant_gaps(r: Report, min_days: float = 180) -> DataFrame:
    from txmon.functions.timefn import micros
    from txmon.operators.windows import with_previous
    g = r.transactions.select("account_id", "transaction_id", "transaction_date", "amount").withColumn(
        "_us", micros("transaction_date"))
    g = with_previous(g, "account_id", "_us", "transaction_id", ["transaction_date"]).withColumnRenamed(
        "prev_transaction_date", "prev_txn_date")
    gap = julian_days("transaction_date", "prev_txn_date")
    g = g.filter(F.col("prev_txn_date").isNotNull() & (gap >= min_days))  # unrounded test
    return (g.select("account_id", "prev_txn_date", F.col("transaction_date").alias("current_txn_date"),
                     rnd(gap, 0).alias("days_dormant"), rnd("amount", 2).alias("reactivation_amount"))
            .orderBy(F.desc("days_dormant"), "account_id", "current_txn_date").limit(10))


def k13_high_risk_exposure(r: Report) -> DataFrame:
    t = _with_customer(r)
    cr = F.broadcast(r.country_risk.filter(F.col("risk_level").isin("high", "critical")))  # bounded
    c = r.customers.select("customer_id", F.col("risk_rating").alias("_crr"))
    j = t.join(cr, t["counterparty_country"] == cr["country_code"]).join(c, "customer_id")
    g = j.groupBy("country_name", "risk_level", "fatf_status").agg(
        F.count("*").alias("txn_count"), F.sum("amount").alias("_s"),
        F.countDistinct("customer_id").alias("unique_customers"),
        F.sum(F.col("_crr").isin("high", "critical").cast("int")).cast("bigint").alias("high_risk_customers"))
    return g.select("country_name", "risk_level", "fatf_status", "txn_count", rnd("_s", 2).alias("total_exposure"),
                    rnd(F.col("_s") / F.col("txn_count"), 2).alias("avg_txn_amount"), "unique_customers",
                    "high_risk_customers").orderBy(F.desc("total_exposure"), "country_name").limit(10)


def k14_alert_attribution(r: Report) -> DataFrame:
    a = _alerts_rules(r)
    t = r.transactions.select(F.col("transaction_id").alias("_t"), "transaction_type", "channel", "amount")
    j = a.join(t, a["transaction_id"] == t["_t"])
    g = j.groupBy("rule_name", "rule_category", "severity", "transaction_type", "channel").agg(
        F.count("*").alias("alert_count"), F.sum("amount").alias("_s"), F.sum("flagged_amount").alias("_f"),
        F.min("amount").alias("_mn"), F.max("amount").alias("_mx"))
    return g.select("rule_name", "rule_category", "severity", "transaction_type", "channel", "alert_count",
                    rnd(F.col("_s") / F.col("alert_count"), 2).alias("avg_trigger_amount"),
                    rnd(F.col("_f") / F.col("alert_count"), 2).alias("avg_flagged_amount"),
                    rnd("_mn", 2).alias("min_trigger_amount"), rnd("_mx", 2).alias("max_trigger_amount")
                    ).orderBy(F.desc("alert_count"), "rule_name", "severity", "transaction_type", "channel").limit(10)


def k15_daily_zscore(r: Report) -> DataFrame:
    d = r.transactions.groupBy(F.to_date("transaction_date").alias("txn_day")).agg(
        F.count("*").alias("daily_txn_count"))
    x = F.col("daily_txn_count").cast("double")
    stats = d.agg((F.sum(x) / F.count("*")).alias("mean_count"),
                  F.sqrt(F.sum(x * x) / F.count("*") - (F.sum(x) / F.count("*")) ** 2).alias("stddev_count"))
    z = (x - F.col("mean_count")) / (F.col("stddev_count") + 0.0001)
    j = d.crossJoin(F.broadcast(stats))  # one-row statistics table
    out = j.select("txn_day", "daily_txn_count", rnd("mean_count", 2).alias("mean"),
                   rnd("stddev_count", 2).alias("stddev"), rnd(z, 2).alias("z_score"),
                   F.when(F.abs(z) > 2, "ANOMALOUS").otherwise("normal").alias("flag"))
    return out.orderBy(F.desc(F.abs("z_score")), "txn_day").limit(10)


def k16_cohorts(r: Report) -> DataFrame:
    t = _with_customer(r).withColumn("_m", month_key("transaction_date"))
    first = t.groupBy("customer_id").agg(month_key(F.min("transaction_date")).alias("cohort_month"))
    g = (t.join(first, "customer_id").groupBy("cohort_month", F.col("_m").alias("activity_month"))
         .agg(F.countDistinct("customer_id").alias("active_customers"),
              F.round(F.sum("amount"), 2).alias("_v")))

    def ym(c):
        return F.substring(c, 1, 4).cast("int") * 12 + F.substring(c, 6, 2).cast("int")
    return g.select("cohort_month", "activity_month", "active_customers", F.col("_v").cast("double").alias("cohort_volume"),
                    (ym(F.col("activity_month")) - ym(F.col("cohort_month"))).cast("bigint")
                    .alias("months_since_acquisition")).orderBy("cohort_month", "activity_month").limit(10)


ALL = {
    "k01_largest_transaction": k01_largest_transaction,
    "k02_rolling_velocity": k02_rolling_velocity,
    "k03_mom_volume": k03_mom_volume,
    "k04_running_total": k04_running_total,
    "k05_percentile_buckets": k05_percentile_buckets,
    "k06_critical_alert_chain": k06_critical_alert_chain,
    "k07_structuring_days": k07_structuring_days,
    "k08_value_tiers": k08_value_tiers,
    "k09_three_way": k09_three_way,
    "k10_rule_f1": k10_rule_f1,
    "k11_large_weekday_hour": k11_large_weekday_hour,
    "k12_dormant_gaps": k12_dormant_gaps,
    "k13_high_risk_exposure": k13_high_risk_exposure,
    "k14_alert_attribution": k14_alert_attribution,
    "k15_daily_zscore": k15_daily_zscore,
    "k16_cohorts": k16_cohorts,
}
