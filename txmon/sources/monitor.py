"""The monitor model (country_risk, customers, accounts, transactions) derived
from the input tables.

The mapping is fixed by FIXTURES.md §B.2 and mirrored one-to-one by the
oracle's SQL views (txmon/oracle/monitor_sql.py).  Every column is a pure
function of one input row, so each view is a narrow projection of one scan:
no joins, no shuffles.  Account attributes are functions of the account key,
which is why transactions carry their currency without a join to accounts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txmon.functions.money import MONEY
from txmon.functions.timefn import trunc_seconds
from txmon.sources.driver import read_table

# Two sources share one id space: its blocks of this many ids belong to them in turn.
LEDGER_BASE = 1_000_000          # accounts: even blocks from events, odd blocks from the ledger
ORDER_TXN_BASE = 1_000_000_000   # transactions: even blocks from events, odd blocks from orders

ACCOUNT_TYPES = ["checking", "savings", "business", "investment", "crypto"]
EVENT_TYPE_MAP = {"purchase": "wire_out", "view": "wire_in", "signup": "cash_deposit",
                  "click": "transfer_out", "error": "withdrawal"}
PRIORITY_TYPE_MAP = {"1": "wire_out", "2": "wire_in", "3": "deposit", "4": "cash_deposit",
                     "5": "cash_withdrawal"}
COUNTERPARTY_TYPES = ("wire_out", "wire_in", "transfer_out")


def even_space(key: Column, block: int) -> Column:
    """``key`` moved to the even blocks; keys of the first block stay as they are."""
    k = key.cast("bigint")
    return k * 2 - F.pmod(k, F.lit(block).cast("bigint"))


def odd_space(key: Column, block: int) -> Column:
    """``key`` moved to the odd blocks, which no ``even_space`` key reaches."""
    return even_space(key, block) + F.lit(block).cast("bigint")


def is_odd_space(moved: Column, block: int) -> Column:
    return F.pmod(moved, F.lit(2 * block).cast("bigint")) >= block


def padded(key: Column, width: int) -> Column:
    """The number with leading zeros up to ``width`` digits; longer numbers stay whole."""
    text = key.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def country_code(key: Column) -> Column:
    return F.concat(F.lit("N"), padded(key, 2))


def _case(col: Column, mapping: dict, default=None) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    return expr.otherwise(F.lit(default))


def currency_of(src_key: Column) -> Column:
    m = src_key % 5
    return F.when(m == 0, "EUR").when(m == 1, "GBP").when(m == 2, "JPY").otherwise("USD")


def build_country_risk(nation: DataFrame) -> DataFrame:
    k = F.col("n_nationkey")
    level = (F.when(k < 12, 1).when(k < 18, 2).when(k < 22, 3).when(k < 24, 4).otherwise(5)).cast("int")
    return nation.select(
        country_code(k).alias("country_code"),
        F.col("n_name").alias("country_name"),
        level.alias("risk_level"),
        (level >= 4).cast("int").alias("fatf_listed"),
        F.lit(None).cast("string").alias("notes"),
    )


def build_customers(customer: DataFrame) -> DataFrame:
    cid = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    reg = F.date_add(F.lit("1985-01-01").cast("date"), (cid % 3650).cast("int"))
    return customer.select(
        cid.alias("id"),
        F.col("c_name").alias("name"),
        F.when(seg == "BUILDING", "business").when(seg == "MACHINERY", "financial_institution")
        .otherwise("individual").alias("customer_type"),
        (F.lit(1) + cid % 3).cast("int").alias("risk_rating"),
        country_code(F.col("c_nationkey")).alias("country"),
        reg.alias("registration_date"),
        F.when(cid % 10 < 8, "verified").when(cid % 20 == 8, "pending").when(cid % 20 == 9, "expired")
        .otherwise("failed").alias("kyc_status"),
        (cid % 25 == 0).cast("int").alias("pep_status"),
        reg.cast("timestamp_ntz").alias("created_at"),
    )


def _account_cols(aid: Column, cust: Column, src: Column, opened: Column) -> list[Column]:
    types = F.array(*[F.lit(t) for t in ACCOUNT_TYPES])
    return [
        aid.alias("id"),
        cust.alias("customer_id"),
        F.element_at(types, (aid % 5 + 1).cast("int")).alias("account_type"),
        currency_of(src).alias("currency"),
        opened.alias("opened_date"),
        F.when(aid % 20 == 0, "frozen").when(aid % 20 == 1, "closed").otherwise("active").alias("status"),
        (F.lit(5000.0) * (aid % 5 + 1)).cast("double").alias("daily_limit"),
        opened.cast("timestamp_ntz").alias("created_at"),
    ]


def build_accounts(events: DataFrame, customer: DataFrame) -> DataFrame:
    """Event accounts (one per user_id) and ledger accounts (one per customer)."""
    users = events.select("user_id").distinct()
    uid = F.col("user_id")
    event_acc = users.select(*_account_cols(
        even_space(uid, LEDGER_BASE), F.floor(uid / 2).cast("bigint"), uid,
        F.date_add(F.lit("2023-11-01").cast("date"), (uid % 60).cast("int"))))
    ck = F.col("c_custkey")
    aid = odd_space(ck, LEDGER_BASE)
    ledger = customer.select(*_account_cols(
        aid, ck, ck, F.date_add(F.lit("1994-10-01").cast("date"), (aid % 400).cast("int"))))
    return event_acc.unionByName(ledger)


def _with_counterparty_and_channel(df: DataFrame) -> DataFrame:
    ty, k, tid = F.col("transaction_type"), F.col("_k"), F.col("id")
    has_cp = ty.isin(*COUNTERPARTY_TYPES)
    channel = (F.when(ty.isin("cash_deposit", "cash_withdrawal"),
                      F.when(tid % 2 == 0, "branch").otherwise("atm"))
               .when(ty.isin("wire_out", "wire_in"), "wire")
               .when(tid % 3 == 0, "online").when(tid % 3 == 1, "mobile").otherwise("api"))
    return df.select(
        "id", "account_id", "transaction_type", "amount", "currency", "timestamp",
        F.when(has_cp, F.concat(F.lit("CP-"), padded(k, 3))).alias("counterparty_account"),
        F.when(has_cp, F.concat(F.lit("Party "), k.cast("string"))).alias("counterparty_name"),
        F.when(has_cp, country_code(k % 25)).alias("counterparty_country"),
        channel.alias("channel"),
        "status",
        F.col("timestamp").alias("created_at"),
    )


def build_transactions(events: DataFrame, orders: DataFrame) -> DataFrame:
    eid = F.col("event_id")
    ev = events.select(
        even_space(eid, ORDER_TXN_BASE).alias("id"),
        even_space(F.col("user_id"), LEDGER_BASE).alias("account_id"),
        _case(F.col("event_type"), EVENT_TYPE_MAP).alias("transaction_type"),
        (F.col("value").cast(MONEY) * 200).cast(MONEY).alias("amount"),
        currency_of(F.col("user_id")).alias("currency"),
        trunc_seconds("ts").alias("timestamp"),
        F.get_json_object("props", "$.k").cast("int").alias("_k"),
        F.when(eid % 50 == 0, "pending").when(eid % 50 == 1, "failed").when(eid % 50 == 2, "reversed")
        .otherwise("completed").alias("status"),
    )
    ok = F.col("o_orderkey")
    price = F.col("o_totalprice")
    od = orders.select(
        odd_space(ok, ORDER_TXN_BASE).alias("id"),
        odd_space(F.col("o_custkey"), LEDGER_BASE).alias("account_id"),
        _case(F.substring("o_orderpriority", 1, 1), PRIORITY_TYPE_MAP).alias("transaction_type"),
        F.when(ok % 20 == 0, F.floor(price / 1000) * 1000 + 1000).otherwise(price.cast(MONEY))
        .cast(MONEY).alias("amount"),
        currency_of(F.col("o_custkey")).alias("currency"),
        F.col("o_orderdate").alias("timestamp"),
        (ok % 100).cast("int").alias("_k"),
        F.when(F.col("o_orderstatus") == "P", "pending").otherwise("completed").alias("status"),
    )
    return _with_counterparty_and_channel(ev.unionByName(od))


@dataclass
class MonitorSources:
    country_risk: DataFrame
    customers: DataFrame
    accounts: DataFrame
    transactions: DataFrame


def load_monitor_sources(spark: SparkSession, sf_dir: str) -> MonitorSources:
    nation = read_table(spark, sf_dir, "nation")
    customer = read_table(spark, sf_dir, "customer")
    events = read_table(spark, sf_dir, "events")
    orders = read_table(spark, sf_dir, "orders")
    return MonitorSources(
        country_risk=build_country_risk(nation),
        customers=build_customers(customer),
        accounts=build_accounts(events, customer),
        transactions=build_transactions(events, orders),
    )


# The eight ground-truth pattern keys of the data_loaded metadata.
FRAUD_PATTERNS = ["structuring", "rapid_velocity", "round_trip", "geo_risk", "layering",
                  "dormant_activation", "unusual_amounts", "cross_acct_smurf"]


def build_fraud_customers(customers: DataFrame) -> DataFrame:
    """Ground truth (pattern, customer_id): customers with id % 20 = 0, spread over the 8 patterns."""
    cid = F.col("id")
    pats = F.array(*[F.lit(p) for p in FRAUD_PATTERNS])
    return customers.filter(cid % 20 == 0).select(
        F.element_at(pats, ((cid / 20).cast("bigint") % len(FRAUD_PATTERNS) + 1).cast("int")).alias("pattern"),
        cid.alias("customer_id"))
