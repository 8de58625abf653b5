"""Enrichment spot checks, the data profile, and totals of the monitor model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txmon.functions.money import CASH_TYPES, FX_RATES, rnd
from txmon.functions.timefn import month_key
from txmon.operators.ranking import value_ranks
from txmon.operators.rules import score_bands
from txmon.plans.model import Monitor


def e11_enrichment_checks(m: Monitor) -> DataFrame:
    """(check_name, detail, value) of the enrichment, all in one pass over the enriched rows."""
    c = F.col
    n = F.count("*")
    share = lambda cond: rnd(F.count_if(cond) * 100.0 / F.nullif(n, F.lit(0)), 1)
    number = lambda x: x.cast("double")
    rate = rnd(F.try_divide(c("amount_usd"), c("amount")), 4)
    checks = [("coverage_pct", None, share(c("amount_usd").isNotNull())),
              ("large_cash", None, number(F.count_if(c("is_large_cash") == 1))),
              ("large_cash_not_cash", None, number(F.count_if((c("is_large_cash") == 1) & ~c("transaction_type").isin(*CASH_TYPES)))),
              ("round_amounts", None, number(F.count_if(c("is_round_amount") == 1))),
              ("round_amount_pct", None, share(c("is_round_amount") == 1)),
              ("structuring_deposits", None, number(F.count_if((c("transaction_type") == "cash_deposit")
                                                               & c("amount").between(9000, 9999)))),
              ("new_counterparties", None, number(F.count_if(c("is_new_counterparty") == 1))),
              ("new_counterparty_pct", None, share(c("is_new_counterparty") == 1)),
              ("account_age_min", None, number(F.min("account_age_days"))),
              ("account_age_avg", None, rnd(F.avg("account_age_days"), 0)),
              ("account_age_max", None, number(F.max("account_age_days")))]
    for w in ("1h", "24h", "7d"):
        checks += [("velocity_avg", w, rnd(F.avg(f"velocity_{w}"), 2)), ("velocity_max", w, number(F.max(f"velocity_{w}")))]
    checks += [("country_risk", str(k), number(F.count_if(c("country_risk_score") == k))) for k in (2, 3, 4, 5)]
    for cur in FX_RATES:  # a fixed list
        if cur != "USD":
            own = F.when(c("currency") == cur, rate)
            checks += [("implied_rate_min", cur, F.min(own)), ("implied_rate_max", cur, F.max(own))]
    row = m.wide.agg(*[x.alias(f"v{i}") for i, (_, _, x) in enumerate(checks)])
    return row.select(F.explode(F.array(*[F.struct(
        F.lit(name).alias("check_name"), F.lit(detail).cast("string").alias("detail"), F.col(f"v{i}").alias("value"))
        for i, (name, detail, _) in enumerate(checks)])).alias("x")).select("x.*").where("value IS NOT NULL")


def e11_fast_accounts(m: Monitor, at_least: int = 15, k: int = 10) -> DataFrame:
    """Accounts with the largest one-hour velocity."""
    g = m.wide.groupBy("account_id").agg(F.max("velocity_1h").cast("bigint").alias("max_velocity_1h"))
    return g.where(F.col("max_velocity_1h") >= at_least).orderBy(F.desc("max_velocity_1h"), "account_id").limit(k)


def e12_by_type(m: Monitor) -> DataFrame:
    return m.transactions.groupBy("transaction_type").agg(
        F.count("*").alias("n"), rnd(F.sum("amount") / F.count("*"), 2).alias("avg_amount"),
        rnd(F.min("amount"), 2).alias("min_amount"), rnd(F.max("amount"), 2).alias("max_amount"))


def e12_by_month(m: Monitor) -> DataFrame:
    return m.transactions.groupBy(month_key("timestamp").alias("month")).agg(
        F.count("*").alias("n"), rnd(F.sum("amount"), 0).alias("total_volume"))


def e12_by_channel(m: Monitor) -> DataFrame:
    g = m.transactions.groupBy("channel").agg(F.count("*").alias("n"))
    total = g.agg(F.sum("n").alias("_n"))
    return g.crossJoin(F.broadcast(total)).select("channel", "n", rnd(F.col("n") * 100.0 / F.col("_n"), 1).alias("pct"))  # one row


def e12_by_risk(m: Monitor) -> DataFrame:
    """Customers and transactions by risk rating; transactions are counted to their account first."""
    tx = m.transactions.groupBy("account_id").agg(F.count("*").alias("_n"))
    owner = m.accounts.select(F.col("id").alias("_a"), F.col("customer_id").alias("_c"))
    per = tx.join(owner, F.col("account_id") == F.col("_a")).groupBy("_c").agg(F.sum("_n").alias("_t"))
    return m.customers.join(per, F.col("id") == F.col("_c"), "left").groupBy("risk_rating").agg(
        F.count("*").alias("customers"), F.coalesce(F.sum("_t"), F.lit(0)).alias("transactions"))


def e12_amount_levels(m: Monitor) -> DataFrame:
    """Smallest and largest amount, and the averages of the rows up to a percent rank (A14); ranks come from
    the counts of the different amounts."""
    v = value_ranks(m.transactions.select("amount"), "amount")
    pct = F.when(F.col("total") > 1, F.col("before") / (F.col("total") - 1)).otherwise(0.0)
    v = v.withColumn("_p", pct)

    def lower(cut: float):
        inside = F.col("_p") <= cut
        return rnd(F.sum(F.when(inside, F.col("amount") * F.col("n"))) / F.sum(F.when(inside, F.col("n"))), 2)

    return v.agg(rnd(F.min("amount"), 2).alias("p0"), lower(0.25).alias("p25"), lower(0.50).alias("p50"),
                 lower(0.75).alias("p75"), lower(0.95).alias("p95"), rnd(F.max("amount"), 2).alias("p100"))


def rule_totals(m: Monitor) -> DataFrame:
    """Alerts, and the transactions and customers that have any."""
    hit = m.fired.where(F.size("hits") > 0)
    return hit.agg(F.coalesce(F.sum(F.size("hits")), F.lit(0)).cast("bigint").alias("alerts"),
                   F.count("*").alias("transactions"), F.countDistinct("customer_id").alias("customers"))


def row_counts(m: Monitor) -> DataFrame:
    """The rows of every table."""
    tables = {"country_risk": m.country_risk, "customers": m.customers, "accounts": m.accounts,
              "transactions": m.transactions, "transaction_enrichment": m.enrichment, "rules": m.rules,
              "alerts": m.alerts, "alert_scores": m.alert_scores}
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


ALL = {
    "e11_enrichment_checks": e11_enrichment_checks,
    "e11_fast_accounts": lambda m: e11_fast_accounts(m, at_least=2),
    **{f.__name__: f for f in (e12_by_type, e12_by_month, e12_by_channel, e12_by_risk, e12_amount_levels, rule_totals, row_counts)},
    "score_bands": lambda m: score_bands(m.alerts),
}
