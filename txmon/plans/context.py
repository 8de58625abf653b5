"""Analyst context around the triage queue and the searches (Y2-Y8), on the report model.

The queue is the top ``k`` alerts of Y1, so it is small by definition;
the big tables are narrowed to its customers or accounts by
semi joins before they are aggregated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txmon.functions.money import rnd
from txmon.functions.timefn import ts_lit
from txmon.plans.reports import y1_triage_queue
from txmon.plans.showcase import rule_figures
from txmon.sources.report import Report

TIMELINE_DAYS = 30


def _queue(r: Report, k: int) -> DataFrame:
    """The queue's alerts with all their columns and the account of their transaction."""
    top = y1_triage_queue(r, k).select(F.col("alert_id").alias("_q"))
    mine = r.alerts.join(F.broadcast(top), F.col("alert_id") == F.col("_q")).drop("_q")  # k rows
    tx = r.transactions.select(F.col("transaction_id").alias("_t"), "account_id")
    return mine.join(tx, F.col("transaction_id") == F.col("_t")).drop("_t")


def _customer_transactions(r: Report, queue: DataFrame) -> DataFrame:
    """Transactions of the queue's customers with their customer."""
    who = queue.select("customer_id").distinct()
    acc = r.accounts.join(F.broadcast(who), "customer_id", "left_semi").select(  # k customers at most
        F.col("account_id").alias("_a"), "customer_id")
    return r.transactions.join(acc, F.col("account_id") == F.col("_a")).drop("_a")


def _reason(flagged: Column, threshold: Column, description: Column) -> Column:
    """How far the amount is above the rule's threshold; the rule's description where it has none."""
    money = lambda x: F.concat(F.lit("$"), F.format_number(x, 2))
    above = F.format_string("%.1f", rnd((flagged.cast("double") - threshold) * 100.0 / threshold, 1))
    return F.when((threshold > 0) & (flagged > 0), F.concat(
        F.lit("Transaction amount "), money(flagged), F.lit(" is "), above, F.lit("% above rule threshold of "),
        money(threshold))).otherwise(F.concat(F.lit("Transaction pattern matched rule: "), description))


def y2_alert_context(r: Report, k: int = 30) -> DataFrame:
    """The queue's alerts with rule, transaction, customer, account, country and the reason."""
    q = _queue(r, k)
    stats = _customer_transactions(r, q).groupBy(F.col("customer_id").alias("_sc")).agg(
        F.count("*").alias("total_txns"), rnd(F.sum("amount"), 2).alias("total_volume"))
    who = F.broadcast(q.select("customer_id").distinct())  # k customers at most
    alerts = r.alerts.join(who, "customer_id", "left_semi").groupBy(F.col("customer_id").alias("_ac")).agg(
        F.count("*").alias("alerts_count"))
    fp = F.broadcast(rule_figures(r).select(F.col("rule_id").alias("_r"), F.when(  # bounded catalogue
        F.col("total_alerts_generated") > 0, rnd(F.col("false_positives") * 100.0 / F.col("total_alerts_generated"), 1))
        .otherwise(0.0).alias("rule_fp_rate")))
    rules = F.broadcast(r.rules.select("rule_id", "rule_name", "rule_category", "threshold_value",
                                       F.concat("rule_category", F.lit(" rule "), "rule_id").alias("rule_description")))
    tx = r.transactions.select(
        F.col("transaction_id").alias("_t"), "transaction_date", "transaction_type", "amount", "currency", "channel",
        F.col("status").alias("transaction_status"), "counterparty_name", "counterparty_country")
    cust = r.customers.select(F.col("customer_id").alias("_c"), F.col("name").alias("customer_name"), "nationality",
                              "kyc_status", "risk_rating", "pep_flag", "sanctions_flag")
    acc = r.accounts.select(F.col("account_id").alias("_a"), "account_type", "balance",
                            F.col("status").alias("account_status"), "opened_at")
    cc = F.broadcast(r.country_risk.select(F.col("country_code").alias("_cc"), "country_name", "risk_level"))
    j = (q.join(rules, "rule_id").join(fp, F.col("rule_id") == F.col("_r"), "left")
         .join(tx, F.col("transaction_id") == F.col("_t"), "left").join(cust, F.col("customer_id") == F.col("_c"), "left")
         .join(acc, F.col("account_id") == F.col("_a"), "left").join(stats, F.col("customer_id") == F.col("_sc"), "left")
         .join(alerts, F.col("customer_id") == F.col("_ac"), "left")
         .join(cc, F.col("counterparty_country") == F.col("_cc"), "left"))
    return j.select(
        "alert_id", "status", "severity", F.coalesce("assigned_to", F.lit("Unassigned")).alias("assigned_to"), "created_at",
        rnd("flagged_amount", 2).alias("flagged_amount"), "rule_name", "rule_category", "rule_fp_rate",
        _reason(F.col("flagged_amount"), F.col("threshold_value"), F.col("rule_description")).alias("why_fired"),
        "transaction_id", "transaction_date", "transaction_type", "currency", "channel", "transaction_status",
        "counterparty_name", "counterparty_country",
        F.coalesce("country_name", "counterparty_country").alias("counterparty_country_name"),
        F.coalesce("risk_level", F.lit("unknown")).alias("counterparty_risk"), "customer_id", "customer_name",
        "nationality", "kyc_status", "risk_rating", "pep_flag", "sanctions_flag",
        F.coalesce("total_txns", F.lit(0)).alias("total_txns"), F.coalesce("total_volume", F.lit(0.0)).alias("total_volume"),
        F.coalesce("alerts_count", F.lit(0)).alias("alerts_count"), "account_id", "account_type",
        rnd("balance", 2).alias("balance"), "account_status", "opened_at")


def y3_daily_activity(r: Report, k: int = 30) -> DataFrame:
    """31 days up to the run date for every alert of the queue, zero filled: the customer's transactions
    and volume a day, and the place of the alert's own day (null if it lies outside)."""
    q = _queue(r, k)
    first = F.date_sub(F.lit(r.as_of).cast("date"), TIMELINE_DAYS)
    per = (_customer_transactions(r, q).where(F.col("transaction_date") >= first.cast("timestamp_ntz"))
           .groupBy(F.col("customer_id").alias("_c"), F.to_date("transaction_date").alias("_d"))
           .agg(F.count("*").alias("_n"), F.sum("amount").alias("_v")))
    place = F.datediff(F.to_date("created_at"), first)
    grid = q.select("alert_id", "customer_id", F.when(place.between(0, TIMELINE_DAYS), place).alias("alert_day_index"),
                    F.explode(F.sequence(F.lit(0), F.lit(TIMELINE_DAYS))).alias("day_index")).withColumn(
        "_day", F.date_add(first, F.col("day_index")))
    return grid.join(per, (F.col("customer_id") == F.col("_c")) & (F.col("_day") == F.col("_d")), "left").select(
        "alert_id", "customer_id", "day_index", "alert_day_index", F.date_format("_day", "yyyy-MM-dd").alias("day"),
        F.coalesce("_n", F.lit(0)).alias("transactions"), rnd(F.coalesce("_v", F.lit(0)), 2).alias("volume"))


def y4_related_alerts(r: Report, k: int = 30, newest: int = 6) -> DataFrame:
    """Up to ``newest`` - 1 related alerts: the newest of the customer without the alert itself."""
    q = _queue(r, k).select("alert_id", "customer_id")
    who = F.broadcast(q.select("customer_id").distinct())  # k customers at most
    order = Window.partitionBy("customer_id").orderBy(F.desc("created_at"), "alert_id")
    recent = (r.alerts.join(who, "customer_id", "left_semi").withColumn("_n", F.row_number().over(order))
              .where(F.col("_n") <= newest))  # cut to the newest before the shuffle as well
    rules = F.broadcast(r.rules.select("rule_id", "rule_name"))
    rel = recent.join(rules, "rule_id").select(
        F.col("customer_id").alias("_c"), "_n", F.col("alert_id").alias("related_alert_id"), "rule_name",
        rnd("flagged_amount", 2).alias("amount"), "status", F.date_format("created_at", "yyyy-MM-dd").alias("date"))
    place = F.row_number().over(Window.partitionBy("alert_id").orderBy("_n"))
    return (q.join(rel, F.col("customer_id") == F.col("_c")).where("alert_id <> related_alert_id")
            .withColumn("position", place).where(F.col("position") < newest)
            .select("alert_id", "position", "related_alert_id", "rule_name", "amount", "status", "date"))


def y5_network(r: Report, k: int = 30, nodes: int = 8) -> DataFrame:
    """The ``nodes`` most frequent counterparties of every account of the queue."""
    accounts = F.broadcast(_queue(r, k).select("account_id").distinct())  # k accounts at most
    per = (r.transactions.where("counterparty_name IS NOT NULL AND counterparty_name <> ''")
           .join(accounts, "account_id", "left_semi").groupBy("account_id", "counterparty_name")
           .agg(F.count("*").alias("transactions"), F.sum("amount").alias("_v"), F.max("counterparty_country").alias("country")))
    order = Window.partitionBy("account_id").orderBy(F.desc("transactions"), "counterparty_name")
    cc = F.broadcast(r.country_risk.select(F.col("country_code").alias("_cc"), "country_name", "risk_level"))
    return (per.withColumn("position", F.row_number().over(order)).where(F.col("position") <= nodes)
            .join(cc, F.col("country") == F.col("_cc"), "left").select(
                "account_id", "position", "counterparty_name", "country", F.coalesce("country_name", "country").alias("country_name"),
                F.coalesce("risk_level", F.lit("low")).alias("risk_level"), "transactions", rnd("_v", 2).alias("volume")))


def y6_risk_score(r: Report, k: int = 30) -> DataFrame:
    """Five-part score of the queue's alerts, without the noise; an unknown or critical level takes the default."""
    c = y2_alert_context(r, k)
    level = lambda col, table, other: F.coalesce(F.element_at(F.create_map(
        *[F.lit(x) for pair in table.items() for x in pair]), col), F.lit(other))
    base = level(F.col("risk_rating"), {"low": 25, "medium": 50, "high": 80}, 50)
    known = F.when(F.col("counterparty_risk") == "unknown", "low").otherwise(F.col("counterparty_risk"))
    s = c.select("alert_id", base.alias("transaction_behavior"),
                 level(known, {"low": 15, "medium": 35, "high": 65}, 30).alias("geographic_risk"),
                 F.least(F.lit(100), base + F.when(F.col("pep_flag") == 1, 30).otherwise(0)).alias("customer_profile"),
                 base.alias("network_risk"), base.alias("velocity_risk"))
    part = lambda name, w: F.col(name) * F.lit(w).cast("decimal(3,2)")
    total = F.bround(part("transaction_behavior", "0.25") + part("geographic_risk", "0.20") + part("customer_profile", "0.25")
                     + part("network_risk", "0.15") + part("velocity_risk", "0.15"), 0).cast("int")
    s = s.withColumn("total_risk", total)
    return s.withColumn("label", F.when(total >= 75, "HIGH RISK").when(total >= 50, "MEDIUM RISK").otherwise("LOW RISK"))


def search_rows(r: Report) -> DataFrame:
    """Transactions with customer and country, as the searches show them."""
    acc = r.accounts.select(F.col("account_id").alias("_a"), "customer_id")
    cust = r.customers.select(F.col("customer_id").alias("_c"), F.col("name").alias("customer_name"))
    cc = F.broadcast(r.country_risk.select(F.col("country_code").alias("_cc"), "country_name", "risk_level"))  # a row a country
    return (r.transactions.join(acc, F.col("account_id") == F.col("_a"), "left")
            .join(cust, F.col("customer_id") == F.col("_c"), "left")
            .join(cc, F.col("counterparty_country") == F.col("_cc"), "left").select(
                "transaction_id", "transaction_date", rnd("amount", 2).alias("amount"), "currency", "transaction_type",
                "channel", "counterparty_name", "counterparty_country",
                F.coalesce("country_name", "counterparty_country").alias("counterparty_country_name"),
                F.coalesce("risk_level", F.lit("low")).alias("counterparty_risk"), "customer_name", "customer_id", "description"))


def _newest(df: DataFrame, k: int) -> DataFrame:
    return df.orderBy(F.desc("transaction_date"), "transaction_id").limit(k)


def y7_newest_transactions(r: Report, k: int = 200) -> DataFrame:
    return _newest(search_rows(r), k)


def y8_transaction_search(r: Report, min_amount=None, max_amount=None, date_from: str | None = None,
                          date_to: str | None = None, country: str | None = None, channel: str | None = None,
                          k: int = 10) -> DataFrame:
    """The newest ``k`` transactions that match; ``date_to`` includes its day, the country's case is ignored."""
    df, at = search_rows(r), F.col("transaction_date")
    for value, cond in ((min_amount, lambda x: F.col("amount") >= x), (max_amount, lambda x: F.col("amount") <= x),
                        (date_from, lambda x: at >= ts_lit(x)),
                        (date_to, lambda x: at < F.timestamp_add("DAY", F.lit(1), ts_lit(x))),
                        (country, lambda x: F.col("counterparty_country") == x.strip().upper()),
                        (channel, lambda x: F.col("channel") == x)):
        if value:
            df = df.where(cond(value))
    return _newest(df, k)


def y8_queue_search(r: Report, search: str = "", status: str | None = None, severity: str | None = None,
                    rule_id: int | None = None) -> DataFrame:
    """Alerts whose id, customer's name or id contains ``search`` in any case, and that match the filters."""
    names = r.customers.select(F.col("customer_id").alias("_c"), F.col("name").alias("customer_name"))
    df = r.alerts.join(names, F.col("customer_id") == F.col("_c"))
    for column, value in (("status", status), ("severity", severity), ("rule_id", rule_id)):
        if value:
            df = df.where(F.col(column) == value)
    if search:
        df = df.where(F.contains(F.lower(F.concat_ws(" ", "alert_id", "customer_name", "customer_id")), F.lit(search.lower())))
    return df.select("alert_id", "customer_id", "customer_name", "rule_id", "status", "severity", "created_at")


ALL = {
    "y2_alert_context": y2_alert_context,
    "y3_daily_activity": y3_daily_activity,
    "y4_related_alerts": y4_related_alerts,
    "y5_network": y5_network,
    "y6_risk_score": y6_risk_score,
    "y7_newest_transactions": y7_newest_transactions,
    "y8_transaction_search": lambda r: y8_transaction_search(
        r, 100, 200_000, "1996-01-01", "2024-01-20", " n03", "wire"),
    "y8_queue_search": lambda r: y8_queue_search(r, "Customer#", "escalated", "high"),
}
