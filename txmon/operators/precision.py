"""Rule precision against ground truth (R23) with nearest-rank quantiles.

Quantiles: the reference takes ``sorted(scores)[n // 2]`` and
``sorted(scores)[int(0.95 * n)]``.  Scores have two decimals, so each rule has
at most 10,001 distinct values: count per (rule, score), cumulate over that
small table, and pick the value whose cumulative range covers the index.
Exact, and no rule's alerts are ever gathered into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txmon.functions.money import rnd


def nearest_rank(values: DataFrame, key: str, value: str, quantiles: dict[str, str]) -> DataFrame:
    """Per ``key``: for each ``name -> index_expr`` (SQL over ``n``) the value at that zero-based index."""
    counts = values.groupBy(key, value).agg(F.count("*").alias("_c"))
    w = Window.partitionBy(key).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    cum = counts.withColumn("_hi", F.sum("_c").over(w)).withColumn("_lo", F.col("_hi") - F.col("_c"))
    cum = cum.withColumn("n", F.sum("_c").over(Window.partitionBy(key)))
    aggs = []
    for name, idx in quantiles.items():
        i = F.expr(idx)
        aggs.append(F.max(F.when((F.col("_lo") <= i) & (i < F.col("_hi")), F.col(value))).alias(name))
    return cum.groupBy(key).agg(*aggs)


def ground_truth_from_audit(audit_log: DataFrame) -> DataFrame:
    """``data_loaded`` metadata JSON -> distinct (customer_id) with its pattern."""
    schema = T.StructType([
        T.StructField("n_customers", T.LongType()), T.StructField("n_accounts", T.LongType()),
        T.StructField("n_transactions", T.LongType()),
        T.StructField("fraud_customers", T.MapType(T.StringType(), T.ArrayType(T.LongType())))])
    meta = audit_log.filter(F.col("event_type") == "data_loaded").select(
        F.from_json("metadata", schema).alias("m"))
    return (meta.select(F.explode("m.fraud_customers").alias("pattern", "ids"))
            .select("pattern", F.explode("ids").alias("customer_id")))


def rule_performance(alerts_wide: DataFrame, rules: DataFrame, fraud_customers: DataFrame,
                     evaluation_date: str = "2024-12-31") -> DataFrame:
    """Per active rule with alerts: totals, TP/FP, precision, avg, median, p95, notes."""
    truth = fraud_customers.select("customer_id").distinct()
    n_truth = truth.agg(F.count("*").alias("n_truth"))
    flagged = alerts_wide.join(truth.withColumn("_tp", F.lit(1)), "customer_id", "left")
    base = flagged.groupBy("rule_id").agg(
        F.count("*").alias("total_alerts"),
        F.sum(F.coalesce("_tp", F.lit(0))).cast("bigint").alias("true_positives"),
        F.sum(F.col("score").cast("decimal(5,2)")).alias("_sum"))
    q = nearest_rank(alerts_wide.select("rule_id", "score"), "rule_id", "score",
                     {"median_score": "n div 2", "p95_score": "cast(floor(0.95 * n) as bigint)"})
    active = rules.filter("is_active = 1").select(F.col("id").alias("rule_id"))
    return (base.join(active, "rule_id").join(q, "rule_id").crossJoin(F.broadcast(n_truth))  # one row
            .select("rule_id", F.lit(evaluation_date).cast("date").alias("evaluation_date"),
                    "total_alerts", "true_positives",
                    (F.col("total_alerts") - F.col("true_positives")).alias("false_positives"),
                    rnd(F.col("true_positives") / F.col("total_alerts"), 4).alias("precision_rate"),
                    rnd(F.col("_sum") / F.col("total_alerts"), 2).alias("avg_score"),
                    "median_score", "p95_score",
                    F.concat(F.lit("Ground truth: "), F.col("n_truth").cast("string"),
                             F.lit(" known fraud customers")).alias("notes")))
