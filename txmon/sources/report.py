"""The report model (string keys, text risk levels, analyst alerts) derived
from the monitor model's source views (FIXTURES.md §B.3).

Mirrored by txmon/oracle/report_sql.py.  Money stays decimal(18,2); it is
cast to double only in query outputs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txmon.operators.joins import broadcast_if_small
from txmon.sources.driver import read_table
from txmon.sources.monitor import ORDER_TXN_BASE, is_odd_space, load_monitor_sources, padded

AS_OF = "2024-01-31"

ALERT_STATUSES = ["new", "under_review", "escalated", "true_positive", "false_positive"]
SEVERITIES = ["low", "medium", "high", "critical"]
DESCRIPTIONS = ["groceries", "rent", "payroll", "invoice", "supplier payment", "travel", "utilities"]
TYPE_MAP = {"deposit": "credit", "cash_deposit": "credit", "wire_in": "credit", "withdrawal": "debit",
            "cash_withdrawal": "debit", "transfer_out": "transfer", "wire_out": "wire"}

# The report model's rule catalogue (id, name, category, threshold).
REPORT_RULES = [
    (1, "Large Cash Transaction", "structuring", 10000),
    (2, "Structuring Detection", "structuring", 9500),
    (3, "Rapid Fund Movement", "velocity", 0),
    (4, "High-Risk Country Transfer", "geographic", 0),
    (5, "Round Dollar Amounts", "behavior", 0),
    (6, "Dormant Account Activity", "behavior", 180),
    (7, "Multiple Small Deposits", "structuring", 3000),
    (8, "Cross-Border Wire", "geographic", 5000),
    (9, "Velocity Check 24h", "velocity", 10),
    (10, "New Account High Value", "behavior", 50000),
    (11, "PEP Transaction", "network", 0),
    (12, "Sanctions Country", "geographic", 0),
    (13, "Layering Pattern", "network", 0),
    (14, "Smurfing Detection", "structuring", 3000),
    (15, "Business Account Personal Use", "behavior", 0),
]


def report_rule_rows() -> list[tuple]:
    """Stored quality figures by a rule spanning all four precision/recall quadrants."""
    rows = []
    for rid, name, cat, thr in REPORT_RULES:
        i = rid - 1
        precision = round(0.30 + 0.04 * i, 4)
        recall = round(0.40 + 0.03 * ((i * 7) % 15), 4)
        total = 50 + 50 * i
        tp = int(total * precision)
        rows.append((rid, name, cat, f"{cat} rule {rid}", float(thr), 1, precision, recall, total, tp, total - tp))
    return rows


REPORT_RULE_SCHEMA = T.StructType([
    T.StructField("rule_id", T.IntegerType()), T.StructField("rule_name", T.StringType()),
    T.StructField("rule_category", T.StringType()), T.StructField("description", T.StringType()),
    T.StructField("threshold_value", T.DoubleType()), T.StructField("enabled", T.IntegerType()),
    T.StructField("precision_score", T.DoubleType()), T.StructField("recall_score", T.DoubleType()),
    T.StructField("total_alerts_generated", T.IntegerType()), T.StructField("true_positives", T.IntegerType()),
    T.StructField("false_positives", T.IntegerType()),
])


def key(prefix: str, col: Column, width: int) -> Column:
    return F.concat(F.lit(prefix), padded(col, width))


def _pick(values: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


@dataclass
class Report:
    country_risk: DataFrame
    customers: DataFrame
    accounts: DataFrame
    transactions: DataFrame
    rules: DataFrame
    alerts: DataFrame
    as_of: str = AS_OF


def load_report(spark: SparkSession, sf_dir: str) -> Report:
    src = load_monitor_sources(spark, sf_dir)
    lvl = F.col("risk_level")
    country = src.country_risk.select(
        "country_code", "country_name",
        F.when(lvl == 1, "low").when(lvl == 2, "medium").when(lvl <= 4, "high").otherwise("critical")
        .alias("risk_level"),
        F.when(lvl <= 2, "member").when(lvl == 3, "grey_list").otherwise("black_list").alias("fatf_status"),
        F.lit(None).cast("string").alias("comments"))

    cid = F.col("id")
    customers = src.customers.select(
        key("CUST", cid, 6).alias("customer_id"), "name",
        F.when(cid % 41 == 0, "").otherwise(
            F.concat(F.lower(F.regexp_replace("name", "#", ".")), F.lit("@example.com"))).alias("email"),
        F.date_add(F.lit("1950-01-01").cast("date"), (cid % 15000).cast("int")).alias("date_of_birth"),
        F.when(cid % 33 == 0, F.lit(None)).otherwise(F.col("country")).alias("nationality"),
        "kyc_status",
        F.when(cid % 10 < 5, "low").when(cid % 10 < 8, "medium").when(cid % 10 == 8, "high")
        .otherwise("critical").alias("risk_rating"),
        (cid % 25 == 0).cast("int").alias("pep_flag"),
        (cid % 100 == 1).cast("int").alias("sanctions_flag"),
        "created_at",
        F.col("country").alias("country_of_residence"),
        cid.alias("_cid"))

    bal = broadcast_if_small(read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("_ck"), F.col("c_acctbal").alias("balance")))
    acc = src.accounts.join(bal, src.accounts["customer_id"] == bal["_ck"], "left")
    aid = F.col("id")
    opened = F.col("opened_date").cast("timestamp_ntz")
    closed = (F.col("status") == "closed") | ((F.col("status") == "active") & (aid % 199 == 0))
    accounts = acc.select(
        key("ACCT", aid, 8).alias("account_id"), key("CUST", F.col("customer_id"), 6).alias("customer_id"),
        "account_type", "currency", "balance", "status", opened.alias("opened_at"),
        F.when(closed, F.timestamp_add("DAY", F.lit(800), opened)).alias("closed_at"),
        aid.alias("_aid"), F.col("customer_id").alias("_cid"))

    tid = F.col("id")
    tdate = F.when(is_odd_space(tid, ORDER_TXN_BASE), F.timestamp_add("MINUTE", (tid * 37) % 1440, F.col("timestamp"))
                   ).otherwise(F.col("timestamp"))
    tx = src.transactions.withColumn("_td", tdate)
    ttype = None
    for k, v in TYPE_MAP.items():
        ttype = F.when(F.col("transaction_type") == k, v) if ttype is None else ttype.when(
            F.col("transaction_type") == k, v)
    transactions = tx.select(
        key("TXN", tid, 12).alias("transaction_id"), key("ACCT", F.col("account_id"), 8).alias("account_id"),
        ttype.alias("transaction_type"), "amount", "currency", "counterparty_name", "counterparty_country",
        F.when(tid % 53 == 0, "").otherwise(_pick(DESCRIPTIONS, tid % 7)).alias("description"),
        F.col("_td").alias("transaction_date"),
        F.when(tid % 97 == 0, F.timestamp_add("HOUR", F.lit(-1), F.col("_td")))
        .otherwise(F.timestamp_add("HOUR", tid % 49, F.col("_td"))).alias("processing_date"),
        "status", "channel", tid.alias("_tid"), F.col("account_id").alias("_aid"))

    acc_cust = broadcast_if_small(accounts.select(F.col("_aid").alias("_a2"), F.col("customer_id").alias("_c")))
    a = transactions.filter(F.col("_tid") % 25 == 0).join(acc_cust, F.col("_aid") == F.col("_a2"))
    t = F.col("_tid")
    created = F.timestamp_add("HOUR", t % 200, F.col("transaction_date"))
    status = _pick(ALERT_STATUSES, F.floor(t / 375) % 5)  # every rule has alerts of every status
    alerts = a.select(
        key("ALRT", t, 12).alias("alert_id"), "transaction_id",
        (F.lit(1) + F.floor(t / 25) % 15).cast("int").alias("rule_id"),
        F.col("_c").alias("customer_id"), status.alias("status"), _pick(SEVERITIES, t % 4).alias("severity"),
        created.alias("created_at"), F.timestamp_add("HOUR", t % 240, created).alias("updated_at"),
        F.when(status == "new", F.lit(None)).otherwise(F.concat(F.lit("Analyst "), (t % 8).cast("string")))
        .alias("assigned_to"),
        F.lit(None).cast("string").alias("notes"), F.col("amount").alias("flagged_amount"))

    rules = spark.createDataFrame(report_rule_rows(), REPORT_RULE_SCHEMA).withColumn(
        "last_updated", F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"))
    return Report(country, customers, accounts, transactions, rules, alerts)
