"""Alert fan-out weights (§2.4).

Many reference aggregates run after ``LEFT JOIN alerts``, so a transaction
counts once per alert (once if it has none).  Instead of multiplying rows,
alerts are aggregated per transaction (bounded: at most one per rule) and
joined back once; every aggregate becomes a weighted one:

  count      -> sum(w)                      w = greatest(n_alerts, 1)
  sum(x)     -> sum(x * w)
  avg(x)     -> sum(x * w) / sum(w)
  count(DISTINCT alert) -> sum(n_alerts)
  avg(alert score)      -> sum(score_sum) / sum(n_alerts)

``dedupe=True`` gives the de-duplicated numbers (w = 1).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def alerts_per_transaction(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("transaction_id").agg(
        F.count("*").alias("n_alerts"),
        F.sum(F.col("score").cast("decimal(5,2)")).alias("score_sum"),
        F.max("score").alias("score_max"),
        F.sum((F.col("score") >= 60).cast("int")).alias("n_alerts_60"))


def with_alert_weights(wide: DataFrame, alerts: DataFrame, dedupe: bool = False) -> DataFrame:
    per = alerts_per_transaction(alerts).withColumnRenamed("transaction_id", "_atid")
    out = wide.join(per, wide["id"] == per["_atid"], "left").drop("_atid")
    n = F.coalesce(F.col("n_alerts"), F.lit(0)).cast("bigint")
    return (out.withColumn("n_alerts", n)
            .withColumn("score_sum", F.coalesce(F.col("score_sum"), F.lit(0).cast("decimal(5,2)")))
            .withColumn("n_alerts_60", F.coalesce(F.col("n_alerts_60"), F.lit(0)).cast("bigint"))
            .withColumn("w", F.lit(1).cast("bigint") if dedupe else F.greatest(n, F.lit(1).cast("bigint"))))


def with_hit_weights(fired: DataFrame) -> DataFrame:
    """The same columns from the ``hits`` on the row itself (txmon.operators.rules.fire): no join, no shuffle."""
    n = F.size("hits").cast("bigint")
    score = lambda x: x["composite_score"]
    return fired.select(
        "*", n.alias("n_alerts"),
        F.aggregate("hits", F.lit(0).cast("decimal(15,2)"), lambda acc, x: (acc + score(x)).cast("decimal(15,2)"))
        .alias("score_sum"),
        F.array_max(F.transform("hits", score)).cast("double").alias("score_max"),
        F.size(F.filter("hits", lambda x: score(x) >= 60)).cast("bigint").alias("n_alerts_60"),
        F.greatest(n, F.lit(1).cast("bigint")).alias("w"))
