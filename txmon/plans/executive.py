"""Executive, filing and rule reports beside the M, G and V queries of ``reports``.

Fixed categories (statuses, severities) are zero filled in their own order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txmon.functions.money import rnd
from txmon.functions.timefn import month_key, ts_lit
from txmon.plans.reports import SEVERITY_RANK, v2_weekly_series
from txmon.plans.showcase import rule_figures
from txmon.sources.report import ALERT_STATUSES, Report


def title(col: Column) -> Column:
    """Underscores to blanks, words capitalised."""
    return F.initcap(F.translate(col, "_", " "))


def initials(name: Column) -> Column:
    """Up to four first letters of the words, upper case."""
    return F.upper(F.substring(F.array_join(F.transform(F.split(name, " "), lambda w: F.substring(w, 1, 1)), ""), 1, 4))


def _zero_filled(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """(position, value, alerts, pct) of fixed values, in one aggregate."""
    counts = df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(column) == v).alias(f"n{i}") for i, v in enumerate(values)])
    share = lambda n: F.coalesce(rnd(F.try_divide(n * 100.0, F.col("_n")), 1), F.lit(0.0))
    return counts.select(F.explode(F.array(*[F.struct(
        F.lit(i + 1).alias("position"), title(F.lit(v)).alias(column), F.col(f"n{i}").alias("alerts"),
        share(F.col(f"n{i}")).alias("pct")) for i, v in enumerate(values)])).alias("x")).select("x.*")


def _run_month(r: Report) -> DataFrame:
    """Alerts of the run month, as a half-open range."""
    first = F.trunc(F.lit(r.as_of).cast("date"), "month")
    return r.alerts.where((F.col("created_at") >= first.cast("timestamp_ntz"))
                          & (F.col("created_at") < F.add_months(first, 1).cast("timestamp_ntz")))


def m3_by_status(r: Report) -> DataFrame:
    return _run_month(r).groupBy(title(F.col("status")).alias("status")).agg(F.count("*").alias("alerts"))


def m3_by_day(r: Report) -> DataFrame:
    return _run_month(r).groupBy(F.date_format("created_at", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("alerts"))


def v2_weekly_series_52(r: Report) -> DataFrame:
    return v2_weekly_series(r, 52)


def v3_severity_mix(r: Report) -> DataFrame:
    return _zero_filled(r.alerts, "severity", list(SEVERITY_RANK))


def v3_status_funnel(r: Report) -> DataFrame:
    return _zero_filled(r.alerts, "status", ALERT_STATUSES)


def v3_top_countries(r: Report, k: int = 10) -> DataFrame:
    """Countries of the alerted transactions; alerts without one are a group of their own."""
    t = r.transactions.select(F.col("transaction_id").alias("_t"), "counterparty_country")
    cc = F.broadcast(r.country_risk.select(F.col("country_code").alias("_cc"), "risk_level"))  # a row a country
    g = r.alerts.join(t, F.col("transaction_id") == F.col("_t")).groupBy("counterparty_country").agg(F.count("*").alias("alerts"))
    return (g.join(cc, F.col("counterparty_country") == F.col("_cc"), "left")
            .select(F.col("counterparty_country").alias("country"), F.coalesce("risk_level", F.lit("unknown")).alias("risk_level"),
                    "alerts").orderBy(F.desc("alerts"), F.coalesce("country", F.lit(""))).limit(k))


def v4_rule_table(r: Report) -> DataFrame:
    """Rules with initials and figures counted from their alerts; F1 is 0 where both shares are."""
    p, q = F.col("precision_score"), F.col("recall_score")
    f1 = F.when(p + q > 0, 2 * p * q / F.nullif(p + q, F.lit(0.0))).otherwise(0.0)
    return rule_figures(r).select("rule_id", "rule_name", initials(F.col("rule_name")).alias("initials"), rnd(p, 4).alias("precision"),
                                  rnd(q, 4).alias("recall"), rnd(f1, 4).alias("f1"), F.col("total_alerts_generated").alias("alerts"))


def g3_best_worst(r: Report, k: int = 3) -> DataFrame:
    """The best and the worst rules by precision, then alerts."""
    order = lambda d: Window.partitionBy().orderBy(d("precision"), d("alerts"), F.asc("rule_id"))
    ranked = v4_rule_table(r).select(  # bounded catalogue
        "rule_id", "rule_name", "precision", "alerts", F.row_number().over(order(F.desc)).alias("from_best"),
        F.row_number().over(order(F.asc)).alias("from_worst"))
    return ranked.where((F.col("from_best") <= k) | (F.col("from_worst") <= k))


def g3_totals(r: Report) -> DataFrame:
    """Averages over the rules, all alerts they raised, and how many rules have an F1 below one half."""
    return v4_rule_table(r).agg(  # bounded catalogue
        rnd(F.avg("precision"), 4).alias("avg_precision"), rnd(F.avg("recall"), 4).alias("avg_recall"),
        rnd(F.avg("f1"), 4).alias("avg_f1"), F.sum("alerts").cast("bigint").alias("total_generated"),
        F.count("*").alias("rules"), F.count(F.when(F.col("f1") < 0.5, 1)).alias("weak_rules"))


def g3_weak_rules(r: Report) -> DataFrame:
    """The rules to tune: F1 below one half."""
    t = v4_rule_table(r).join(F.broadcast(r.rules.select("rule_id", "rule_category", "threshold_value")), "rule_id")  # bounded
    return t.where(F.col("f1") < 0.5).select("rule_id", "rule_name", "rule_category", "threshold_value", "f1", "alerts")


def g4_rule_volume(r: Report) -> DataFrame:
    return r.alerts.groupBy("rule_id").agg(F.count("*").alias("alerts"), rnd(F.sum("flagged_amount"), 2).alias("total_amount"))


def g4_coverage(r: Report) -> DataFrame:
    """Estimated share of transactions under watch: 25 times the alert rate, at most 99."""
    t = r.transactions.agg(F.count("*").alias("transactions"))
    row = r.alerts.agg(F.count("*").alias("alerts")).crossJoin(t)  # one-row sides
    return row.withColumn("coverage_pct", rnd(F.least(F.lit(99.0), F.col("alerts") * 2500.0 / F.greatest(
        "transactions", F.lit(1))), 2))


def v5_recent_alerts(r: Report, k: int = 20) -> DataFrame:
    rules = F.broadcast(r.rules.select("rule_id", "rule_name"))  # bounded catalogue
    names = r.customers.select("customer_id", F.col("name").alias("customer_name"))
    top = r.alerts.join(names, "customer_id").join(rules, "rule_id").orderBy(F.desc("created_at"), "alert_id").limit(k)
    return top.select("alert_id", F.substring(F.date_format("created_at", "yyyy-MM-dd HH:mm:ss"), 1, 10).alias("date"),
                      "customer_name", rnd("flagged_amount", 2).alias("amount"), "rule_name", "severity",
                      title(F.col("status")).alias("status"), F.coalesce("assigned_to", F.lit("Unassigned")).alias("assigned_to"))


def v5_monthly_amounts(r: Report, days: int = 365) -> DataFrame:
    since = F.timestamp_add("DAY", F.lit(-days), ts_lit(r.as_of))
    return r.transactions.where(F.col("transaction_date") >= since).groupBy(month_key("transaction_date").alias("month")).agg(
        F.count("*").alias("transactions"), rnd(F.sum("amount"), 2).alias("total_amount"))


def v5_customer_risk(r: Report) -> DataFrame:
    return r.customers.groupBy("risk_rating").agg(F.count("*").alias("customers"))


ALL = {f.__name__: f for f in (
    m3_by_status, m3_by_day, v2_weekly_series_52, v3_severity_mix, v3_status_funnel, v3_top_countries, v4_rule_table,
    g3_best_worst, g3_totals, g3_weak_rules, g4_rule_volume, g4_coverage, v5_recent_alerts, v5_monthly_amounts, v5_customer_risk)}
