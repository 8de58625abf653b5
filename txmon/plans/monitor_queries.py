"""The 23 analysis queries of the monitor model (Q1-Q23) as DataFrame plans.

Conventions: counts are BIGINT, rounded money and ratios DOUBLE (rounded in
decimal, half away from zero); every LIMIT has a unique last sort key so
the cut is deterministic.  Aggregates that the reference computes after a
1:N join to alerts use fan-out weights (txmon.operators.fanout).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txmon.functions.money import rnd, safe_div
from txmon.functions.timefn import US_PER_DAY, US_PER_HOUR, julian_days, month_key, weekday_sun0
from txmon.operators.joins import time_band_self_join
from txmon.operators.precision import rule_performance
from txmon.plans.model import Monitor

DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


def _label(col, mapping: dict, default=None):
    e = None
    for k, v in mapping.items():
        e = F.when(col == k, v) if e is None else e.when(col == k, v)
    return e.otherwise(F.lit(default))


def _dsum(col: str):
    return F.sum(F.col(col).cast("decimal(18,2)"))


def q01_monthly_trends(m: Monitor) -> DataFrame:
    monthly = m.wide.groupBy(month_key("timestamp").alias("month")).agg(
        F.count("*").alias("txn_count"), F.round(_dsum("amount_usd"), 0).alias("_vol"))
    w = Window.orderBy("month")  # monthly rows only: a handful per year
    prev = F.lag("txn_count").over(w)
    return monthly.select(
        "month", "txn_count", F.col("_vol").cast("double").alias("volume_usd"),
        (F.col("txn_count") - prev).alias("mom_count_delta"),
        rnd(safe_div(100.0 * (F.col("txn_count") - prev), prev), 1).alias("mom_count_pct"),
        rnd(F.col("_vol") / 1e6, 1).alias("volume_millions"),
    ).orderBy("month")


def _per_customer_weighted(m: Monitor) -> DataFrame:
    t = m.weighted()
    return t.groupBy("customer_id").agg(
        F.count("*").alias("n_txn"), F.sum("w").alias("sum_w"),
        F.sum(F.col("amount_usd") * F.col("w")).alias("usd_w"), F.sum("n_alerts").alias("n_alerts"))


def q02_customer_segmentation(m: Monitor) -> DataFrame:
    per = _per_customer_weighted(m)
    c = m.customers
    j = c.join(per, c["id"] == per["customer_id"], "left")
    g = j.groupBy("risk_rating", "customer_type").agg(
        F.count("*").alias("customers"),
        F.coalesce(F.sum("n_txn"), F.lit(0)).cast("bigint").alias("transactions"),
        F.sum("usd_w").alias("_usd_w"), F.sum("sum_w").alias("_w"),
        F.coalesce(F.sum("n_alerts"), F.lit(0)).cast("bigint").alias("alerts"))
    return g.select(
        _label(F.col("risk_rating"), {1: "Low", 2: "Medium", 3: "High"}).alias("risk_segment"),
        "customer_type", "customers", "transactions",
        rnd(F.col("_usd_w") / F.col("_w"), 0).alias("avg_txn_usd"), "alerts",
        rnd(safe_div(100.0 * F.col("alerts"), F.col("transactions")), 2).alias("alert_rate_pct"),
    ).orderBy("risk_rating", "customer_type")


def q03_alert_funnel(m: Monitor) -> DataFrame:
    s = F.col("score")
    band = (F.when(s >= 80, "80-100 Critical").when(s >= 60, "60-79  High").when(s >= 40, "40-59  Medium")
            .when(s >= 20, "20-39  Low").otherwise("0-19   Minimal"))
    bands = m.alerts.groupBy(band.alias("band")).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    cum = F.sum("n").over(Window.orderBy(F.desc("band")))
    return bands.select("band", "n", rnd(100.0 * F.col("n") / total, 1).alias("pct_of_total"),
                        cum.alias("cumulative_n"), rnd(100.0 * cum / total, 1).alias("cumulative_pct")
                        ).orderBy(F.desc("band"))


def fraud_truth(m: Monitor) -> DataFrame:
    from txmon.sources.monitor import build_fraud_customers
    return build_fraud_customers(m.customers)


def rule_performance_table(m: Monitor) -> DataFrame:
    return rule_performance(m.alerts_wide(), m.rules, fraud_truth(m))


def q04_rule_precision(m: Monitor) -> DataFrame:
    rp = rule_performance_table(m)
    r = m.rules
    return (r.join(rp, r["id"] == rp["rule_id"])
            .select("name", "category", "severity", "total_alerts",
                    F.col("true_positives").alias("tp"), F.col("false_positives").alias("fp"),
                    rnd(F.col("precision_rate") * 100, 1).alias("precision_pct"), "avg_score", "p95_score")
            .orderBy(F.desc("precision_pct"), "name"))


def q05_structuring_detection(m: Monitor, lo: float = 9000, hi: float = 9999, min_count: int = 3) -> DataFrame:
    t = m.wide.filter((F.col("transaction_type") == "cash_deposit") & F.col("amount_usd").between(lo, hi))
    g = (t.groupBy("account_id", "customer_id", month_key("timestamp").alias("month"))
         .agg(F.count("*").alias("sub_threshold_deposits"), _dsum("amount_usd").alias("_sum"),
              F.min("amount_usd").alias("_min"), F.max("amount_usd").alias("_max"))
         .filter(F.col("sub_threshold_deposits") >= min_count))
    c = m.customers.select(F.col("id").alias("customer_id"), F.col("name").alias("customer_name"), "risk_rating")
    return (g.join(c, "customer_id")
            .select("account_id", "customer_name", "risk_rating", "month", "sub_threshold_deposits",
                    rnd("_sum", 2).alias("total_usd"),
                    rnd(F.col("_sum") / F.col("sub_threshold_deposits"), 2).alias("avg_usd"),
                    rnd("_min", 2).alias("min_deposit"), rnd("_max", 2).alias("max_deposit"))
            .orderBy(F.desc("sub_threshold_deposits"), "account_id", "month").limit(15))


RISK_LABELS = {1: "Low", 2: "Medium", 3: "High", 4: "Very High", 5: "Sanctioned"}


def q06_geographic_flows(m: Monitor, min_txns: int = 50) -> DataFrame:
    t = m.weighted()
    g = t.groupBy("counterparty_country").agg(
        F.sum("w").alias("txn_count"), F.sum(F.col("amount_usd") * F.col("w")).alias("_usd"),
        F.countDistinct("account_id").alias("unique_accounts"), F.sum("n_alerts").alias("alerts_generated"))
    g = g.filter(F.col("txn_count") > min_txns)
    cr = F.broadcast(m.country_risk)  # bounded: one row per country
    j = g.join(cr, g["counterparty_country"] == cr["country_code"], "left")
    return j.select(
        F.coalesce("counterparty_country", F.lit("DOMESTIC")).alias("country"), "country_name",
        _label(F.col("risk_level"), RISK_LABELS, "Domestic").alias("risk_label"),
        "txn_count", rnd("_usd", 0).alias("total_usd"), "unique_accounts", "alerts_generated",
    ).orderBy(F.desc("total_usd"), "country").limit(15)


def q07_time_heatmap(m: Monitor) -> DataFrame:
    dow = weekday_sun0("timestamp")
    h = m.wide.groupBy(dow.alias("dow"), F.hour("timestamp").alias("hour")).agg(
        F.count("*").alias("n"), F.round(_dsum("amount_usd"), 0).alias("vol"))
    names = F.array(*[F.lit(d) for d in DAY_NAMES])
    total = F.sum("n").over(Window.partitionBy())  # at most 168 cells
    return h.select(F.element_at(names, F.col("dow") + 1).alias("day_name"), "hour",
                    F.col("n").alias("txn_count"), F.col("vol").cast("double").alias("volume_usd"),
                    rnd(100.0 * F.col("n") / total, 3).alias("pct_of_all"), "dow"
                    ).orderBy(F.desc("txn_count"), "dow", "hour").limit(15).drop("dow")


def q08_zscore_anomalies(m: Monitor, z_min: float = 4.0, min_txns: int = 10) -> DataFrame:
    x = F.col("amount_usd").cast("double")
    stats = (m.wide.groupBy("customer_id")
             .agg(F.avg(x).alias("mean_usd"), F.stddev_pop(x).alias("stdev_usd"), F.count("*").alias("n"))
             .filter(F.col("n") >= min_txns))
    j = m.wide.join(stats, "customer_id")
    z = F.when(F.col("stdev_usd") > 0, (x - F.col("mean_usd")) / F.col("stdev_usd")).otherwise(F.lit(0.0))
    j = j.withColumn("z", z).filter(F.col("z") > z_min)
    top = j.orderBy(F.desc("z"), "id").limit(15)
    c = m.customers.select(F.col("id").alias("customer_id"), F.col("name").alias("customer_name"))
    return top.join(c, "customer_id").select(
        "customer_name", F.col("id").alias("txn_id"), "transaction_type",
        rnd("amount_usd", 0).alias("amount_usd"), rnd("mean_usd", 0).alias("customer_avg"),
        rnd("z", 1).alias("z_score"), "timestamp")


def q09_round_trip_detection(m: Monitor, max_hours: int = 48) -> DataFrame:
    cols = ["id", "account_id", "counterparty_account", "amount", "timestamp", "us"]
    o = m.wide.filter(F.col("transaction_type") == "wire_out").select(*[F.col(c).alias("o_" + c) for c in cols])
    i = m.wide.filter(F.col("transaction_type") == "wire_in").select(*[F.col(c).alias("i_" + c) for c in cols])
    o = o.withColumnRenamed("o_account_id", "account_id").withColumnRenamed(
        "o_counterparty_account", "counterparty_account")
    i = i.withColumnRenamed("i_account_id", "account_id").withColumnRenamed(
        "i_counterparty_account", "counterparty_account")
    pairs = time_band_self_join(o, i, ["account_id", "counterparty_account"], "o_us", "i_us",
                                max_hours * US_PER_HOUR)
    pairs = pairs.select(o["account_id"], o["counterparty_account"], "o_amount", "i_amount", "o_timestamp",
                         "i_timestamp", "o_us", "i_us", "o_id", "i_id")
    return pairs.select(
        "account_id", "counterparty_account",
        rnd("o_amount", 2).alias("out_amount"), rnd("i_amount", 2).alias("in_amount"),
        F.col("o_timestamp").alias("out_time"), F.col("i_timestamp").alias("in_time"),
        rnd((F.col("i_us") - F.col("o_us")) / float(US_PER_HOUR), 1).alias("hours_elapsed"),
        rnd(F.abs(F.col("o_amount") - F.col("i_amount")), 2).alias("amount_diff"), "o_id", "i_id",
    ).orderBy("out_time", "o_id", "i_id").limit(15).drop("o_id", "i_id")


def with_prev_timestamp(wide: DataFrame) -> DataFrame:
    """LAG(timestamp) per account in (timestamp, id) order (time-bucketed, skew-safe)."""
    from txmon.operators.windows import with_previous
    return with_previous(wide, "account_id", "us", "id", ["timestamp"]).withColumnRenamed(
        "prev_timestamp", "prev_ts")


def q10_dormant_activation(m: Monitor, min_gap_days: int = 180) -> DataFrame:
    g = with_prev_timestamp(m.wide.select("id", "account_id", "customer_id", "timestamp", "us", "amount_usd"))
    g = g.withColumn("gap_days", rnd(julian_days("timestamp", "prev_ts"), 0))
    g = g.filter(F.col("gap_days") >= min_gap_days)  # rounded first, then tested
    top = g.orderBy(F.desc("gap_days"), "account_id", "timestamp").limit(15)
    c = m.customers.select(F.col("id").alias("customer_id"), F.col("name").alias("customer_name"), "risk_rating")
    return top.join(c, "customer_id").select(
        "account_id", "customer_name", "risk_rating", F.col("prev_ts").alias("last_active"),
        F.col("timestamp").alias("reactivation_date"), "gap_days",
        rnd("amount_usd", 0).alias("reactivation_amount_usd"))


def q11_velocity_comparison(m: Monitor, rule_name: str = "VEL-001 Rapid transaction burst") -> DataFrame:
    accts = (m.alerts_wide().filter(F.col("rule_name") == rule_name)
             .select(F.col("account_id").alias("_acct")).distinct().withColumn("_flag", F.lit(1)))
    t = m.wide.join(accts, m.wide["account_id"] == accts["_acct"], "left")
    label = F.when(F.col("_flag").isNotNull(), "Fraud (VEL-001)").otherwise("Normal")
    return t.groupBy(label.alias("group_label")).agg(
        F.countDistinct("account_id").alias("accounts"), F.count("*").alias("transactions"),
        rnd(F.avg("velocity_1h"), 2).alias("avg_vel_1h"), rnd(F.avg("velocity_24h"), 2).alias("avg_vel_24h"),
        F.max("velocity_1h").alias("max_vel_1h"),
        rnd(F.sum("amount_usd") / F.count("*"), 0).alias("avg_amount_usd")).orderBy("group_label")


def q12_counterparty_analysis(m: Monitor) -> DataFrame:
    t = m.weighted().filter(F.col("counterparty_account").isNotNull())
    lvl1 = t.groupBy("counterparty_account", "customer_id", "account_id").agg(
        F.min("counterparty_name").alias("_name"), F.sum("w").alias("_w"),
        F.sum(F.col("amount_usd") * F.col("w")).alias("_usd"), F.sum("n_alerts").alias("_al"))
    lvl2 = lvl1.groupBy("counterparty_account", "customer_id").agg(
        F.min("_name").alias("_name"), F.count("*").alias("_accts"), F.sum("_w").alias("_w"),
        F.sum("_usd").alias("_usd"), F.sum("_al").alias("_al"))
    lvl3 = lvl2.groupBy("counterparty_account").agg(
        F.min("_name").alias("counterparty_name"), F.sum("_accts").alias("sending_accounts"),
        F.count("*").alias("distinct_customers"), F.sum("_w").alias("total_txns"),
        F.sum("_usd").alias("_usd"), F.sum("_al").alias("alerts"))
    return (lvl3.filter(F.col("distinct_customers") >= 2)
            .select("counterparty_account", "counterparty_name", "sending_accounts", "distinct_customers",
                    "total_txns", rnd("_usd", 0).alias("total_usd"), "alerts")
            .orderBy(F.desc("distinct_customers"), F.desc("total_usd"), "counterparty_account").limit(15))


def q13_currency_exposure(m: Monitor) -> DataFrame:
    t = m.weighted()
    g = t.groupBy("currency").agg(
        F.sum("w").alias("txn_count"), F.sum(F.col("amount") * F.col("w")).alias("_nat"),
        F.sum(F.col("amount_usd") * F.col("w")).alias("_usd"), F.sum("n_alerts").alias("alerts"))
    return g.select("currency", "txn_count", rnd("_nat", 0).alias("total_native"), rnd("_usd", 0).alias("total_usd"),
                    rnd(F.col("_usd") / F.col("txn_count"), 0).alias("avg_usd"), "alerts",
                    rnd(safe_div(100.0 * F.col("alerts"), F.col("txn_count")), 2).alias("alert_rate_pct")
                    ).orderBy(F.desc("total_usd"))


def q14_seasonal_patterns(m: Monitor) -> DataFrame:
    dow = weekday_sun0("timestamp")
    day_type = F.when(dow.isin(0, 6), "Weekend").otherwise("Weekday")
    g = m.wide.groupBy(day_type.alias("day_type"), "transaction_type").agg(
        F.count("*").alias("txn_count"), _dsum("amount_usd").alias("_usd"))
    return g.select("day_type", "transaction_type", "txn_count",
                    rnd(F.col("_usd") / F.col("txn_count"), 0).alias("avg_usd"), rnd("_usd", 0).alias("total_usd")
                    ).orderBy("day_type", F.desc("txn_count"))


def rule_pairs(alerts: DataFrame) -> DataFrame:
    """(rule_1, rule_2, pair score sum) per transaction, rule_2 > rule_1.

    Alerts of one transaction are at most one per rule, so the per-transaction
    list is bounded by the catalog size; pairs are generated inside the row.
    """
    return pairs_in(alerts.groupBy("transaction_id").agg(
        F.collect_list(F.struct("rule_id", F.col("score").cast("decimal(5,2)").alias("s"))).alias("a")))


def pairs_in(per: DataFrame) -> DataFrame:
    """The rule pairs inside each array ``a`` of (rule_id, s)."""
    pairs = F.flatten(F.transform("a", lambda x: F.transform(
        F.filter("a", lambda y: y["rule_id"] > x["rule_id"]),
        lambda y: F.struct(x["rule_id"].alias("r1"), y["rule_id"].alias("r2"), (x["s"] + y["s"]).alias("s")))))
    return per.select(F.explode(pairs).alias("p")).select("p.r1", "p.r2", "p.s")


def q15_rule_cooccurrence(m: Monitor, min_count: int = 5) -> DataFrame:
    per = m.fired.select(F.transform("hits", lambda h: F.struct(
        h["rule_id"].alias("rule_id"), h["composite_score"].alias("s"))).alias("a"))
    g = pairs_in(per).groupBy("r1", "r2").agg(F.count("*").alias("co_occurrences"), F.sum("s").alias("_s"))
    g = g.filter(F.col("co_occurrences") >= min_count)
    r = F.broadcast(m.rules.select("id", "name"))  # bounded: rule catalog
    r1, r2 = r.alias("r1n"), r.alias("r2n")
    return (g.join(r1, g["r1"] == F.col("r1n.id")).join(r2, g["r2"] == F.col("r2n.id"))
            .select(F.col("r1n.name").alias("rule_1"), F.col("r2n.name").alias("rule_2"), "co_occurrences",
                    rnd(F.col("_s") / F.col("co_occurrences") / 2, 1).alias("avg_combined_score"), "r1", "r2")
            .orderBy(F.desc("co_occurrences"), "r1", "r2").limit(15).drop("r1", "r2"))


def q16_customer_lifetime(m: Monitor, as_of: str = "2024-12-31") -> DataFrame:
    per = _per_customer_weighted(m)
    # customers whose accounts have no transactions still count (volume NULL, alerts 0)
    holders = m.accounts.select(F.col("customer_id").alias("_cid")).distinct()
    c = m.customers.join(holders, m.customers["id"] == holders["_cid"], "left_semi")
    j = c.join(per, c["id"] == per["customer_id"], "left")
    pep = F.when(F.col("pep_status") == 1, "PEP").otherwise("Non-PEP")
    days = F.datediff(F.lit(as_of).cast("date"), F.col("registration_date"))
    g = j.groupBy("customer_type", "kyc_status", pep.alias("pep_label")).agg(
        F.count("*").alias("customers"), F.sum(days).alias("_days"),
        F.avg("usd_w").alias("_vol"), F.avg(F.coalesce("n_alerts", F.lit(0))).alias("_al"))
    return g.select("customer_type", "kyc_status", "pep_label", "customers",
                    rnd(F.col("_days") / (F.col("customers") * 365.0), 1).alias("avg_tenure_years"),
                    rnd("_vol", 0).alias("avg_lifetime_volume_usd"), rnd("_al", 1).alias("avg_alerts")
                    ).orderBy("customer_type", "kyc_status", "pep_label")


def q17_threshold_sensitivity(m: Monitor) -> DataFrame:
    s = F.col("score")
    th = (F.when(s >= 70, ">= 70").when(s >= 60, ">= 60").when(s >= 50, ">= 50").when(s >= 40, ">= 40")
          .when(s >= 30, ">= 30").otherwise("< 30"))
    g = m.alerts.groupBy(th.alias("threshold")).agg(
        F.count("*").alias("alerts_at_or_above"), F.countDistinct("transaction_id").alias("unique_transactions"))
    total = F.sum("alerts_at_or_above").over(Window.partitionBy())  # six rows
    return g.select("threshold", "alerts_at_or_above", rnd(100.0 * F.col("alerts_at_or_above") / total, 1).alias("pct"),
                    "unique_transactions").orderBy(F.desc("threshold"))


def q18_new_customer_risk(m: Monitor, days: int = 90) -> DataFrame:
    t = m.weighted()
    phase = F.when(F.col("account_age_days") <= days, "First 90 days").otherwise("After 90 days")
    g = t.groupBy(phase.alias("tenure_phase")).agg(
        F.sum("w").alias("txn_count"), F.sum(F.col("amount_usd") * F.col("w")).alias("_usd"),
        F.sum("n_alerts").alias("alerts"), F.sum("score_sum").alias("_ss"))
    return g.select("tenure_phase", "txn_count", rnd(F.col("_usd") / F.col("txn_count"), 0).alias("avg_amount_usd"),
                    "alerts", rnd(safe_div(100.0 * F.col("alerts"), F.col("txn_count")), 2).alias("alert_rate_pct"),
                    rnd(F.try_divide(F.col("_ss"), F.nullif(F.col("alerts"), F.lit(0))), 1).alias("avg_alert_score")
                    ).orderBy("tenure_phase")


def q19_resolution_time(m: Monitor) -> DataFrame:
    r = F.broadcast(m.rules.select(F.col("id").alias("rule_id"), "category"))  # bounded: rule catalog
    a = m.alerts.join(r, "rule_id")
    g = a.groupBy("category").agg(
        F.count("*").alias("total_alerts"),
        F.sum((F.col("status") == "open").cast("int")).cast("bigint").alias("still_open"),
        F.sum(F.col("score").cast("decimal(5,2)")).alias("_s"),
        F.sum((F.col("score") >= 60).cast("int")).cast("bigint").alias("high_priority"))
    return g.select("category", "total_alerts", "still_open",
                    rnd(100.0 * F.col("still_open") / F.col("total_alerts"), 1).alias("pct_open"),
                    rnd(F.col("_s") / F.col("total_alerts"), 1).alias("avg_score"), "high_priority"
                    ).orderBy(F.desc("total_alerts"), "category")


def q20_network_clusters(m: Monitor, min_size: int = 3) -> DataFrame:
    """Closed form of the pairwise self-join: size k, pairs ((Σn)² − Σn²) / 2, alerts of all member accounts."""
    edges = (m.wide.filter(F.col("counterparty_account").isNotNull())
             .groupBy("counterparty_account", "account_id").agg(F.count("*").alias("n")))
    n = F.col("n").cast("decimal(19,0)")  # squares exceed a bigint
    clusters = edges.groupBy("counterparty_account").agg(
        F.count("*").alias("accounts_in_cluster"), F.sum(n).alias("_s"),
        F.sum((n * n).cast("decimal(38,0)")).alias("_s2"))
    clusters = clusters.filter(F.col("accounts_in_cluster") >= min_size)
    acct_alerts = (m.alerts.join(m.wide.select(F.col("id").alias("transaction_id"), "account_id"), "transaction_id")
                   .groupBy("account_id").agg(F.count("*").alias("_al")))
    member_alerts = (edges.join(clusters.select("counterparty_account"), "counterparty_account", "left_semi")
                     .join(acct_alerts, "account_id", "left")
                     .groupBy("counterparty_account").agg(F.coalesce(F.sum("_al"), F.lit(0)).alias("cluster_alerts")))
    return (clusters.join(member_alerts, "counterparty_account")
            .select(F.col("counterparty_account").alias("shared_counterparty"), "accounts_in_cluster",
                    F.expr("CAST((CAST(_s AS DECIMAL(19,0)) * CAST(_s AS DECIMAL(19,0)) - _s2) div 2 AS BIGINT)").alias("total_shared_txns"),
                    F.col("cluster_alerts").cast("bigint").alias("cluster_alerts"))
            .orderBy(F.desc("accounts_in_cluster"), F.desc("total_shared_txns"), "shared_counterparty").limit(10))


def q21_high_risk_matrix(m: Monitor) -> DataFrame:
    t = m.weighted().filter(F.col("country_risk_score") >= 2)
    c = m.customers.select(F.col("id").alias("customer_id"), "risk_rating")
    g = t.join(c, "customer_id").groupBy("risk_rating", "country_risk_score").agg(
        F.sum("w").alias("transactions"), F.sum("n_alerts").alias("alerts"), F.sum("score_sum").alias("_ss"))
    return g.select(
        _label(F.col("risk_rating"), {1: "Low", 2: "Med", 3: "High"}).alias("cust_risk"),
        _label(F.col("country_risk_score"), {1: "Low", 2: "Med", 3: "High", 4: "V.High", 5: "Sanctnd"})
        .alias("country_risk"),
        "transactions", "alerts", rnd(safe_div(100.0 * F.col("alerts"), F.col("transactions")), 1).alias("alert_rate_pct"),
        rnd(F.try_divide(F.col("_ss"), F.nullif(F.col("alerts"), F.lit(0))), 1).alias("avg_score"),
    ).orderBy("risk_rating", "country_risk_score")


def q22_top_customers(m: Monitor, min_categories: int = 3) -> DataFrame:
    a = m.alerts_wide()
    g = a.groupBy("customer_id").agg(
        F.count("*").alias("total_alerts"), F.max("score").alias("_max"),
        F.sum(F.col("score").cast("decimal(5,2)")).alias("_s"),
        F.countDistinct("category").alias("categories_triggered"))
    top = g.withColumn("max_score", rnd("_max", 1)).orderBy(
        F.desc("max_score"), F.desc("total_alerts"), "customer_id").limit(15)
    c = m.customers
    return top.join(c, top["customer_id"] == c["id"]).select(
        "id", "name", "customer_type", "risk_rating", "country", "total_alerts", "max_score",
        rnd(F.col("_s") / F.col("total_alerts"), 1).alias("avg_score"), "categories_triggered",
        F.when(F.col("categories_triggered") >= min_categories, "YES").otherwise("no").alias("multi_category_flag"))


def q23_false_positive_analysis(m: Monitor) -> DataFrame:
    low = m.customers.filter((F.col("risk_rating") == 1) & (F.col("kyc_status") == "verified")
                             & (F.col("pep_status") == 0)).select(F.col("id").alias("customer_id"))
    a = m.alerts_wide()
    on_low = a.join(low, "customer_id", "left_semi")
    g = on_low.groupBy("rule_id", "rule_name", "category").agg(
        F.count("*").alias("alerts_on_low_risk"), F.countDistinct("customer_id").alias("low_risk_customers"),
        F.sum(F.col("score").cast("decimal(5,2)")).alias("_s"))
    totals = m.alerts.groupBy("rule_id").agg(F.count("*").alias("_rule_total"))
    return g.join(totals, "rule_id").select(
        F.col("rule_name").alias("rule"), "category", "alerts_on_low_risk", "low_risk_customers",
        rnd(F.col("_s") / F.col("alerts_on_low_risk"), 1).alias("avg_score"),
        rnd(safe_div(100.0 * F.col("alerts_on_low_risk"), F.col("_rule_total")), 1).alias("pct_of_rule_alerts"),
    ).orderBy(F.desc("alerts_on_low_risk"), "rule")


ALL = {
    "q01_monthly_trends": q01_monthly_trends,
    "q02_customer_segmentation": q02_customer_segmentation,
    "q03_alert_funnel": q03_alert_funnel,
    "q04_rule_precision": q04_rule_precision,
    "q05_structuring_detection": q05_structuring_detection,
    "q06_geographic_flows": q06_geographic_flows,
    "q07_time_heatmap": q07_time_heatmap,
    "q08_zscore_anomalies": q08_zscore_anomalies,
    "q09_round_trip_detection": q09_round_trip_detection,
    "q10_dormant_activation": q10_dormant_activation,
    "q11_velocity_comparison": q11_velocity_comparison,
    "q12_counterparty_analysis": q12_counterparty_analysis,
    "q13_currency_exposure": q13_currency_exposure,
    "q14_seasonal_patterns": q14_seasonal_patterns,
    "q15_rule_cooccurrence": q15_rule_cooccurrence,
    "q16_customer_lifetime": q16_customer_lifetime,
    "q17_threshold_sensitivity": q17_threshold_sensitivity,
    "q18_new_customer_risk": q18_new_customer_risk,
    "q19_resolution_time": q19_resolution_time,
    "q20_network_clusters": q20_network_clusters,
    "q21_high_risk_matrix": q21_high_risk_matrix,
    "q22_top_customers": q22_top_customers,
    "q23_false_positive_analysis": q23_false_positive_analysis,
}
