"""Transaction enrichment (E01-E10) and its incremental form.

Plan shape: one scan of transactions -> narrow projection (USD, flags,
micros) -> trailing windows on (account, time bucket) -> join with the
first-seen counterparty per (account, counterparty), an aggregate with
map-side combine -> dimension joins (country risk: bounded, broadcast;
accounts: broadcast only if its estimated size is small).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txmon.functions.money import CASH_TYPES, LARGE_CASH_USD, MONEY, is_round_usd, to_usd
from txmon.functions.timefn import US_PER_DAY, US_PER_HOUR, micros
from txmon.operators.joins import broadcast_if_small
from txmon.operators.windows import trailing_aggregates

ENRICHMENT_COLUMNS = [
    "transaction_id", "amount_usd", "is_round_amount", "is_large_cash", "velocity_1h",
    "velocity_24h", "velocity_7d", "amount_velocity_24h", "country_risk_score",
    "is_new_counterparty", "account_age_days",
]

WINDOWS = {
    "velocity_1h": ("count", None, US_PER_HOUR),
    "velocity_24h": ("count", None, 24 * US_PER_HOUR),
    "velocity_7d": ("count", None, 7 * US_PER_DAY),
    "amount_velocity_24h": ("sum", "amount_usd", 24 * US_PER_HOUR),
}


def first_seen_counterparty(txns: DataFrame) -> DataFrame:
    """(account_id, counterparty_account) -> id of its first row in (time, id) order."""
    cp = F.col("counterparty_account")
    return (txns.filter(cp.isNotNull() & (cp != ""))
            .groupBy("account_id", "counterparty_account")
            .agg(F.min(F.struct("us", "id"))["id"].alias("_first_id")))


def enrich(transactions: DataFrame, accounts: DataFrame, country_risk: DataFrame,
           bucket_us: int | None = None, first: DataFrame | None = None,
           hot_rows: int | None = None) -> DataFrame:
    """Wide enriched transactions: every transaction column plus E01-E10, ``us`` and ``customer_id``.

    ``first`` (account_id, counterparty_account, _first_id) replaces the look through all rows for the
    first of each counterparty, where it is kept from run to run.  ``hot_rows``: accounts with more rows in
    a week go by prefix sums (see ``trailing_aggregates``)."""
    base = transactions.withColumn("us", micros("timestamp")).withColumn(
        "amount_usd", to_usd("amount", "currency"))
    payload = [c for c in base.columns if c not in ("id", "account_id", "us", "amount_usd")]
    windowed = trailing_aggregates(base, "account_id", "us", WINDOWS, bucket_us=bucket_us, payload=payload,
                                   hot_rows=hot_rows)
    windowed = windowed.withColumn("amount_velocity_24h",
                                   F.round(F.col("amount_velocity_24h"), 2).cast(MONEY))

    first = first if first is not None else first_seen_counterparty(base)
    cr = F.broadcast(country_risk.select(  # bounded: one row per country code
        F.col("country_code").alias("_cc"), F.col("risk_level").alias("_risk")))
    acc = broadcast_if_small(accounts.select(
        F.col("id").alias("_acc_id"), "customer_id", F.col("opened_date").alias("_opened")))

    out = (windowed
           .join(first, ["account_id", "counterparty_account"], "left")
           .join(cr, F.col("counterparty_country") == F.col("_cc"), "left")
           .join(acc, F.col("account_id") == F.col("_acc_id"), "left"))
    usd = F.col("amount_usd")
    return out.select(
        *transactions.columns, "us", "customer_id",
        F.col("id").alias("transaction_id"),
        usd.alias("amount_usd"),
        is_round_usd(usd).cast("int").alias("is_round_amount"),
        (F.col("transaction_type").isin(*CASH_TYPES) & (usd >= LARGE_CASH_USD)).cast("int").alias("is_large_cash"),
        "velocity_1h", "velocity_24h", "velocity_7d", "amount_velocity_24h",
        F.coalesce(F.col("_risk"), F.lit(1)).cast("int").alias("country_risk_score"),
        F.coalesce((F.col("_first_id") == F.col("id")).cast("int"), F.lit(0)).alias("is_new_counterparty"),
        F.greatest(F.lit(0), F.datediff(F.to_date("timestamp"), F.col("_opened"))).cast("int")
        .alias("account_age_days"),
    )


def enrichment_table(wide: DataFrame) -> DataFrame:
    """The ``transaction_enrichment`` projection (1:1 with transactions)."""
    return wide.select(*ENRICHMENT_COLUMNS)


def enrich_incremental(transactions: DataFrame, already: DataFrame, accounts: DataFrame,
                       country_risk: DataFrame, bucket_us: int | None = None) -> DataFrame:
    """Enrichment rows for transactions not yet in ``already`` (keyed by transaction_id).

    History comes from all transactions, so windows and first-seen counterparties
    see old rows; only new keys are emitted (``left_anti``).  Re-running with the
    output appended to ``already`` yields nothing: the job is idempotent.
    """
    full = enrich(transactions, accounts, country_risk, bucket_us=bucket_us)
    done = already.select(F.col("transaction_id").alias("_done"))
    return full.join(done, full["transaction_id"] == done["_done"], "left_anti")
