"""Typology detectors (Z1-Z15) on the report model, and the recommended
extensions N2-N4 on the monitor model.

The report model declares these 15 typologies by name and threshold only;
each chosen reading is written next to its detector and every threshold is a
parameter.  Each detector returns ``(rule_id, transaction_id)`` hits; they are
unioned into one detections table.  Time-window detectors use the bucketed
trailing-window operator, pair detectors the time-band join, so no single
account's history is gathered into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txmon.functions.money import is_round_usd, rnd, to_usd
from txmon.functions.timefn import US_PER_DAY, US_PER_HOUR, micros, ts_lit
from txmon.operators.chains import third_legs
from txmon.operators.joins import broadcast_if_small
from txmon.operators.windows import HOT_ROWS, trailing_aggregates
from txmon.plans.model import Monitor
from txmon.session import materialize
from txmon.sources.report import Report

PERSONAL_DESCRIPTIONS = ("groceries", "rent", "travel")
CASH_CHANNELS = ("branch", "atm")


def _tx(r: Report) -> DataFrame:
    acc = broadcast_if_small(r.accounts.select(
        F.col("account_id").alias("_a"), "customer_id", "account_type", "opened_at"))
    cust = broadcast_if_small(r.customers.select(
        F.col("customer_id").alias("_c"), "pep_flag", "country_of_residence"))
    t = r.transactions.withColumn("us", micros("transaction_date"))
    return (t.join(acc, t["account_id"] == acc["_a"]).join(cust, F.col("customer_id") == F.col("_c"))
            .drop("_a", "_c"))


def _hits(df: DataFrame, rule_id: int) -> DataFrame:
    return df.select(F.lit(rule_id).alias("rule_id"), "transaction_id")


def z01_large_cash(t, r, threshold=10000):
    return _hits(t.filter(F.col("channel").isin(*CASH_CHANNELS) & (F.col("amount") >= threshold)), 1)


def z02_structuring_24h(t, r, lo=9500, hi=10000, min_count=2):
    """Rows in [lo, hi) with at least ``min_count`` such rows in [t-24h, t] on the account."""
    near = t.filter((F.col("amount") >= lo) & (F.col("amount") < hi)).withColumn("_one", F.lit(1))
    w = trailing_aggregates(near, "account_id", "us", {"_prev": ("sum", "_one", 24 * US_PER_HOUR)}, hot_rows=HOT_ROWS)
    return _hits(w.filter(F.col("_prev") + 1 >= min_count), 2)


def z03_rapid_movement(t, r, hours=6, share=0.8):
    """Outflow within ``hours`` after the latest earlier credit on the account, amount >= share of it.

    Credits stand in their own time bucket and the next, so the latest one before an outflow is a
    running maximum inside a bucket; of credits at one time the one with the largest id counts.
    """
    width = hours * US_PER_HOUR
    bucket = F.floor(F.col("us") / F.lit(width)).cast("bigint")
    credit = F.col("transaction_type") == "credit"
    rows = t.withColumn("_b", F.explode(F.when(credit, F.array(bucket, bucket + 1)).otherwise(F.array(bucket)))).select(
        "account_id", "_b", "us", "transaction_id", "amount", credit.alias("_credit"))
    before = Window.partitionBy("account_id", "_b").orderBy("us").rangeBetween(Window.unboundedPreceding, -1)
    last = F.max(F.when(F.col("_credit"), F.struct("us", "transaction_id", "amount"))).over(before)
    out = rows.withColumn("_last", last).where(~F.col("_credit") & (F.col("us") - F.col("_last.us") <= width))
    return _hits(out.where(F.col("amount") >= F.col("_last.amount") * share), 3)


def z04_listed_country_wire(t, r):
    listed = F.broadcast(r.country_risk.filter(F.col("fatf_status").isin("black_list", "grey_list"))
                         .select(F.col("country_code").alias("counterparty_country")))  # bounded
    return _hits(t.filter(F.col("transaction_type") == "wire").join(listed, "counterparty_country", "left_semi"), 4)


def z05_round_amount(t, r):
    return _hits(t.filter(is_round_usd(F.col("amount"))), 5)


def z06_dormant(t, r, days=180):
    """Gap to the previous transaction on the account above ``days`` (previous row via a time-bucket-free lag)."""
    from txmon.operators.windows import with_previous
    g = with_previous(t.select("account_id", "transaction_id", "us"), "account_id", "us", "transaction_id",
                      ["us"], out_prefix="_p_")
    return _hits(g.filter((F.col("us") - F.col("_p_us")) > days * US_PER_DAY), 6)


def z07_small_deposits(t, r, under=3000, days=3, min_count=5):
    small = t.filter((F.col("transaction_type") == "credit") & (F.col("amount") < under)).withColumn("_one", F.lit(1))
    w = trailing_aggregates(small, "account_id", "us", {"_prev": ("sum", "_one", days * US_PER_DAY)}, hot_rows=HOT_ROWS)
    return _hits(w.filter(F.col("_prev") + 1 >= min_count), 7)


def z08_cross_border_wire(t, r, threshold=5000):
    return _hits(t.filter((F.col("transaction_type") == "wire") & (F.col("amount") >= threshold)
                          & F.col("counterparty_country").isNotNull()
                          & (F.col("counterparty_country") != F.coalesce("country_of_residence", F.lit("")))), 8)


def z09_velocity_24h(t, r, min_count=10):
    w = trailing_aggregates(t.select("account_id", "transaction_id", "us"), "account_id", "us",
                            {"_prev": ("count", None, 24 * US_PER_HOUR)}, hot_rows=HOT_ROWS)
    return _hits(w.filter(F.col("_prev") + 1 >= min_count), 9)


def z10_new_account_high_value(t, r, days=30, threshold=50000):
    age = F.col("us") - micros("opened_at")
    return _hits(t.filter((age < days * US_PER_DAY) & (F.col("amount") > threshold)), 10)


def z11_pep(t, r):
    return _hits(t.filter(F.col("pep_flag") == 1), 11)


def z12_sanctioned_country(t, r):
    crit = F.broadcast(r.country_risk.filter(F.col("risk_level") == "critical")
                       .select(F.col("country_code").alias("counterparty_country")))  # bounded
    return _hits(t.join(crit, "counterparty_country", "left_semi"), 12)


def z13_layering(t, r, hours=24, tolerance=0.05):
    """Third leg of a chain of outgoing transfers/wires to the same counterparty from different
    accounts, each leg within ``hours`` of the previous one and within ``tolerance`` of its amount."""
    legs = t.filter(F.col("transaction_type").isin("transfer", "wire")).select(
        F.col("counterparty_name").alias("party"), F.col("transaction_id").alias("id"),
        F.col("account_id").alias("account"), "us", "amount")
    third = third_legs(legs, hours * US_PER_HOUR, tolerance)
    return _hits(third.select(F.col("id").alias("transaction_id")).distinct(), 13)


def z14_smurfing(t, r, under=3000, min_accounts=2):
    small = t.filter((F.col("transaction_type") == "credit") & (F.col("amount") < under)).withColumn(
        "_day", F.to_date("transaction_date"))
    days = (small.groupBy("customer_id", "_day").agg(F.countDistinct("account_id").alias("_n"))
            .filter(F.col("_n") >= min_accounts))
    return _hits(small.join(days, ["customer_id", "_day"], "left_semi"), 14)


def z15_business_personal(t, r, personal=PERSONAL_DESCRIPTIONS):
    return _hits(t.filter((F.col("account_type") == "business") & F.col("description").isin(*personal)), 15)


DETECTORS = [z01_large_cash, z02_structuring_24h, z03_rapid_movement, z04_listed_country_wire, z05_round_amount,
             z06_dormant, z07_small_deposits, z08_cross_border_wire, z09_velocity_24h, z10_new_account_high_value,
             z11_pep, z12_sanctioned_country, z13_layering, z14_smurfing, z15_business_personal]


#: What the detectors read of a transaction, its account and its customer.
COLUMNS = ["transaction_id", "account_id", "customer_id", "us", "transaction_date", "transaction_type", "amount", "channel",
           "counterparty_name", "counterparty_country", "description", "account_type", "opened_at", "pep_flag",
           "country_of_residence"]


def detections(r: Report) -> DataFrame:
    t = materialize(_tx(r).select(*COLUMNS), "detected")  # joined once, not once a detector
    out = None
    for fn in DETECTORS:
        h = fn(t, r)
        out = h if out is None else out.unionByName(h)
    return out


def z_detections(r: Report) -> DataFrame:
    """The hits themselves: (rule_id, transaction_id)."""
    return detections(r)


def detection_counts(r: Report) -> DataFrame:
    d = detections(r).groupBy("rule_id").agg(F.count("*").alias("hits"))
    rules = r.rules.select("rule_id", "rule_name")
    return rules.join(d, "rule_id", "left").select("rule_id", "rule_name",
                                                   F.coalesce("hits", F.lit(0)).cast("bigint").alias("hits"))


# ---- N2-N4 on the monitor model -------------------------------------------------------------

def n2_rolling_cash_deposits(m: Monitor, days: int = 7, threshold: float = 25000) -> DataFrame:
    """Per customer, cash deposits whose trailing ``days`` total (current included) exceeds ``threshold``."""
    owner = broadcast_if_small(m.accounts.select(F.col("id").alias("account_id"), "customer_id"))
    cash = m.transactions.filter(F.col("transaction_type") == "cash_deposit").join(owner, "account_id", "left").select(
        "id", "customer_id", micros("timestamp").alias("us"), "timestamp", to_usd("amount", "currency").alias("amount_usd"))
    w = trailing_aggregates(cash, "customer_id", "us", {"_prev": ("sum", "amount_usd", days * US_PER_DAY)}, hot_rows=HOT_ROWS)
    tot = F.col("_prev") + F.col("amount_usd")
    return w.filter(tot > threshold).select(F.col("id").alias("transaction_id"), "customer_id", "timestamp",
                                            rnd(tot, 2).alias("rolling_cash_usd"))


def n3_tuned_dormant(m: Monitor, idle_days: int = 14, min_age_days: int = 90) -> DataFrame:
    """Dormant rule, tuned: idle at least ``idle_days`` and account at least ``min_age_days`` old."""
    from txmon.operators.windows import with_previous
    g = with_previous(m.wide.select("id", "account_id", "us", "timestamp", "account_age_days", "amount_usd"),
                      "account_id", "us", "id", ["us"], out_prefix="_p_").withColumnRenamed("_p_us", "_prev")
    gap = (F.col("us") - F.col("_prev")) / float(US_PER_DAY)
    return g.filter((gap >= idle_days) & (F.col("account_age_days") >= min_age_days)).select(
        F.col("id").alias("transaction_id"), "account_id", "timestamp", rnd(gap, 1).alias("idle_days"),
        F.col("amount_usd").cast("double").alias("amount_usd"))


def n4_score_decay(m: Monitor, as_of: str = "2025-01-01 00:00:00", half_life_days: float = 30.0) -> DataFrame:
    """Alert score decayed by transaction age: score * 0.5 ** (age_days / half_life)."""
    a = m.alerts_wide()
    age = (micros(ts_lit(as_of)) - F.col("us")) / float(US_PER_DAY)
    return a.select("alert_id", "transaction_id", "rule_id", "score",
                    rnd(F.col("score") * F.pow(F.lit(0.5), F.greatest(age, F.lit(0.0)) / half_life_days), 2)
                    .alias("decayed_score"))
