"""Data-quality scoring on the report model (D01-D04, D06) and expectations.

Each table is scanned once: all null-or-empty rates of a table come from one
aggregate, then ``stack`` turns the one wide row into check rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txmon.functions.money import rnd
from txmon.functions.timefn import month_key, ts_lit
from txmon.sources.report import Report

COMPLETENESS = {
    "transactions": ["counterparty_name", "counterparty_country", "description", "channel", "currency"],
    "customers": ["nationality", "date_of_birth", "email"],
    "alerts": ["assigned_to", "notes"],
}


def _null_or_empty(c: str):
    return F.col(c).isNull() | (F.col(c).cast("string") == "")


def _status(pct, good: float, warn: float):
    return F.when(pct < good, "good").when(pct < warn, "warning").otherwise("critical")


def completeness(r: Report) -> DataFrame:
    """One row per checked column (plus closed dates on active accounts)."""
    frames = {"transactions": r.transactions, "customers": r.customers, "alerts": r.alerts}
    parts = []
    for table, cols in COMPLETENESS.items():
        agg = frames[table].agg(F.count("*").alias("total"),
                                *[F.sum(_null_or_empty(c).cast("int")).alias(f"n_{c}") for c in cols])
        stack = "stack({}, {}) as (field, null_count)".format(
            len(cols), ", ".join(f"'{c}', n_{c}" for c in cols))
        parts.append(agg.selectExpr(f"'{table}' as table_name", "total", stack)
                     .withColumn("good_pct", F.lit(5.0)).withColumn("warn_pct", F.lit(15.0)))
    acc = r.accounts.filter(F.col("status") == "active").agg(
        F.count("*").alias("total"), F.sum(F.col("closed_at").isNotNull().cast("int")).alias("null_count"))
    parts.append(acc.select(F.lit("accounts").alias("table_name"), "total",
                            F.lit("closed_at (active accts w/ close date)").alias("field"), "null_count",
                            F.lit(1.0).alias("good_pct"), F.lit(5.0).alias("warn_pct")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    pct = F.when(F.col("total") > 0, F.col("null_count") * 100.0 / F.col("total")).otherwise(F.lit(0.0))
    return out.select("table_name", "field", F.col("total").cast("bigint").alias("total"),
                      F.coalesce("null_count", F.lit(0)).cast("bigint").alias("null_count"),
                      rnd(pct, 2).alias("null_pct"), _status(pct, F.col("good_pct"), F.col("warn_pct")).alias("status"))


def completeness_score(r: Report) -> DataFrame:
    """D01/D02 section: score = mean of max(0, 100 - pct); transactions missing counterparty data."""
    c = completeness(r).agg(rnd(F.avg(F.greatest(F.lit(0.0), 100 - F.col("null_pct"))), 1).alias("score"))
    t = r.transactions.agg(
        F.sum((F.col("counterparty_country").isNull() | _null_or_empty("counterparty_name")).cast("int"))
        .cast("bigint").alias("unenriched_count"), F.count("*").alias("_n"))
    return c.crossJoin(t).select("score", "unenriched_count",
                                 rnd(F.col("unenriched_count") * 100.0 / F.col("_n"), 2).alias("unenriched_pct"))


def consistency(r: Report) -> DataFrame:
    """Issue counts with status (0 good, <= critical threshold warning, else critical)."""
    t = r.transactions
    end_of_run = ts_lit(f"{r.as_of} 23:59:59")
    closed = r.accounts.filter(F.col("closed_at").isNotNull()).select(F.col("account_id").alias("_a"), "closed_at")
    on_closed = t.join(closed, t["account_id"] == closed["_a"]).filter(F.col("transaction_date") > F.col("closed_at"))
    counts = t.agg(
        F.sum((F.col("amount") < 0.01).cast("int")).alias("zero"),
        F.sum((F.col("transaction_date") > end_of_run).cast("int")).alias("future"),
        F.sum((F.col("status") == "failed").cast("int")).alias("failed"),
        F.sum(((F.col("amount") > 1000000) & (F.col("currency") != "USD")).cast("int")).alias("big_fx"),
        F.sum((F.col("processing_date") < F.col("transaction_date")).cast("int")).alias("proc_before"))
    dup = t.groupBy("transaction_id").count().filter("count > 1").agg(F.count("*").alias("dups"))
    oc = on_closed.agg(F.count("*").alias("closed"))
    row = counts.crossJoin(dup).crossJoin(oc)  # one-row sides
    rows = row.selectExpr("""stack(7,
        'Zero / Negative-Amount Transactions', zero, 10,
        'Future-Dated Transactions', future, 5,
        'Transactions on Closed Accounts', closed, 10,
        'Failed Transactions (No Reversal)', failed, 100,
        'Duplicate Transaction IDs', dups, -1,
        'Large Non-USD Transactions (>$1M)', big_fx, 5,
        'Processing Before Transaction Date', proc_before, 10) as (label, cnt, crit)""")
    n = F.coalesce(F.col("cnt"), F.lit(0)).cast("bigint")
    status = (F.when(n == 0, "good").when(F.col("crit") < 0, "critical").when(n <= F.col("crit"), "warning")
              .otherwise("critical"))
    return rows.select("label", n.alias("count"), status.alias("status"))


def consistency_score(r: Report) -> DataFrame:
    """Good 100, warning 60, critical 0, averaged."""
    s = F.col("status")
    pts = F.when(s == "good", 100.0).when(s == "warning", 60.0).otherwise(0.0)
    return consistency(r).agg(rnd(F.avg(pts), 1).alias("score"))


def missing_months(r: Report) -> DataFrame:
    """Months between the first month seen and the run month that have no transactions."""
    t = r.transactions
    first = t.agg(F.trunc(F.min("transaction_date").cast("date"), "month").alias("lo"))
    months = first.select(F.explode(F.sequence("lo", F.trunc(F.lit(r.as_of).cast("date"), "month"),
                                               F.expr("interval 1 month"))).alias("m"))
    present = t.select(month_key("transaction_date").alias("month")).distinct()
    return (months.select(F.date_format("m", "yyyy-MM").alias("month"))
            .join(present, "month", "left_anti"))
