"""The monitor model as one object: sources, enrichment and rule output.

Everything is lazy.  ``materialized=True`` writes the enriched table and the
alerts under the checkpoint folder (what the batch pipeline does), so the
analysis queries read tables instead of re-running windows and rules.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txmon.operators.enrich import enrich, enrichment_table
from txmon.operators.fanout import with_hit_weights
from txmon.operators.rules import ALERT_COLUMNS, SCORE_COLUMNS, alert_rows, fire, rules_frame
from txmon.session import materialize
from txmon.sources.monitor import load_monitor_sources


@dataclass
class Monitor:
    spark: SparkSession
    country_risk: DataFrame
    customers: DataFrame
    accounts: DataFrame
    transactions: DataFrame
    rules: DataFrame
    wide: DataFrame            # transactions + enrichment + customer_id + us
    alerts: DataFrame
    alert_scores: DataFrame
    skipped_rules: list = field(default_factory=list)
    fired: DataFrame | None = None  # wide + component scores + hits: rules are evaluated once, on the row

    @property
    def enrichment(self) -> DataFrame:
        return enrichment_table(self.wide)

    def weighted(self) -> DataFrame:
        """``wide`` with alert counts and fan-out weights, read off the hits of each row."""
        return with_hit_weights(self.fired)

    def alerts_wide(self) -> DataFrame:
        """Alerts with score breakdown, rule and transaction attributes; the hits carry them, so only the
        rule catalogue is joined."""
        r = F.broadcast(self.rules.select(F.col("id").alias("_rid"), F.col("name").alias("rule_name"),
                                          F.col("description").alias("rule_description"), "category", "severity"))  # bounded: rule catalog
        keep = [c for c in self.wide.columns if c not in ("id", "transaction_id", "status", "created_at")]
        a = alert_rows(self.fired, *keep)
        return a.join(r, a["rule_id"] == r["_rid"]).drop("_rid")


def load_monitor(spark: SparkSession, sf_dir: str, include_scaled: bool = True,
                 materialized: bool = False, bucket_us: int | None = None,
                 hot_rows: int | None = None) -> Monitor:
    src = load_monitor_sources(spark, sf_dir)
    rules = rules_frame(spark, include_scaled)
    wide = enrich(src.transactions, src.accounts, src.country_risk, bucket_us=bucket_us, hot_rows=hot_rows)
    columns = wide.columns
    fired, skipped = fire(wide, src.accounts, src.customers, rules)
    if materialized:
        fired = materialize(fired, "enriched")
        wide = fired.select(*columns)
    rows = alert_rows(fired)
    alerts, scores = rows.select(*ALERT_COLUMNS), rows.select(*SCORE_COLUMNS)
    if materialized:
        alerts = materialize(alerts, "alerts")
        scores = materialize(scores, "alert_scores")
    return Monitor(spark, src.country_risk, src.customers, src.accounts, src.transactions, rules,
                   wide, alerts, scores, skipped, fired)
