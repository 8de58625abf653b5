"""Named queries: ``name -> fn(spark, sf_dir) -> DataFrame`` and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txmon.operators.rules import rule_summary
from txmon.plans import monitor_queries as MQ
from txmon.operators import expectations as BX
from txmon.operators import quality as DQ
from txmon.operators import timeliness as TQ
from txmon.operators.windows import HOT_ROWS
from txmon.operators.graph import shared_counterparty_components
from txmon.plans import context as YQ
from txmon.plans import detectors as ZQ
from txmon.plans import diligence as CQ
from txmon.plans import executive as VQ
from txmon.plans import incremental as SQ
from txmon.plans import profile as PQ
from txmon.plans import readmodels as HQ
from txmon.plans import reports as RQ
from txmon.plans import showcase as KQ
from txmon.plans.model import Monitor, load_monitor
from txmon.sources.report import Report, load_report
from txmon.streaming.velocity import n1_streaming_velocity

Query = Callable[[SparkSession, str], DataFrame]


def _m(fn: Callable[[Monitor], DataFrame], hot_rows: int | None = None) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(load_monitor(spark, sf_dir, hot_rows=hot_rows))
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def _r(fn: Callable[[Report], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(load_report(spark, sf_dir))
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def enrichment_totals(m: Monitor) -> DataFrame:
    w = m.wide
    return w.agg(
        F.count("*").alias("n"), F.sum("amount_usd").cast("double").alias("sum_usd"),
        F.sum("velocity_1h").cast("bigint").alias("v1h"), F.sum("velocity_24h").cast("bigint").alias("v24h"),
        F.sum("velocity_7d").cast("bigint").alias("v7d"),
        F.sum("amount_velocity_24h").cast("double").alias("sum_av24h"),
        F.sum("is_new_counterparty").cast("bigint").alias("new_cp"),
        F.sum("is_round_amount").cast("bigint").alias("round_amt"),
        F.sum("is_large_cash").cast("bigint").alias("large_cash"),
        F.sum("country_risk_score").cast("bigint").alias("sum_risk"),
        F.sum("account_age_days").cast("bigint").alias("sum_age"))


def transaction_enrichment(m: Monitor) -> DataFrame:
    return m.enrichment.withColumn("amount_usd", F.col("amount_usd").cast("double")).withColumn(
        "amount_velocity_24h", F.col("amount_velocity_24h").cast("double"))


def alerts(m: Monitor) -> DataFrame:
    return m.alerts.select("alert_id", "transaction_id", "rule_id", "score", "status")


def alert_scores(m: Monitor) -> DataFrame:
    return m.alert_scores


def rule_summary_q(m: Monitor) -> DataFrame:
    return rule_summary(m.rules, m.alerts)


MONITOR: dict[str, Callable[[Monitor], DataFrame]] = {
    "enrichment_totals": enrichment_totals,
    "transaction_enrichment": transaction_enrichment,
    "alerts": alerts,
    "alert_scores": alert_scores,
    "rule_summary": rule_summary_q,
    "rule_performance": MQ.rule_performance_table,
    **MQ.ALL,
    **HQ.ALL,
    **BX.ALL,
    **PQ.ALL,
    "n2_rolling_cash_deposits": ZQ.n2_rolling_cash_deposits,
    "n3_tuned_dormant": ZQ.n3_tuned_dormant,
    "n4_score_decay": ZQ.n4_score_decay,
    "n5_counterparty_components": lambda m: shared_counterparty_components(m.wide),
}


REPORT: dict[str, Callable[[Report], DataFrame]] = {
    **KQ.ALL,
    "z_detections": ZQ.z_detections,
    "z_detection_counts": ZQ.detection_counts,
    "dq_completeness": DQ.completeness,
    "dq_completeness_score": DQ.completeness_score,
    "dq_consistency": DQ.consistency,
    "dq_consistency_score": DQ.consistency_score,
    "dq_missing_months": DQ.missing_months,
    **RQ.ALL,
    **TQ.ALL,
    **CQ.ALL,
    **YQ.ALL,
    **VQ.ALL,
}


def queries() -> dict[str, Query]:
    # enrichment itself splits hot accounts; the analyses read few of its columns, or a stored table of it
    hot = {"enrichment_totals", "transaction_enrichment"}
    out: dict[str, Query] = {name: _m(fn, HOT_ROWS if name in hot else None) for name, fn in MONITOR.items()}
    out.update({name: _r(fn) for name, fn in REPORT.items()})
    out.update(SQ.ALL)
    out["n1_streaming_velocity"] = n1_streaming_velocity
    return out


def oracle_sql() -> dict[str, str]:
    from txmon.oracle.monitor_queries_sql import Q
    from txmon.oracle.context_sql import Y
    from txmon.oracle.detector_sql import D
    from txmon.oracle.diligence_sql import DD
    from txmon.oracle.executive_sql import V
    from txmon.oracle.expectations_sql import B
    from txmon.oracle.profile_sql import PF
    from txmon.oracle.quality_sql import DQ as DQS
    from txmon.oracle.readmodel_sql import H
    from txmon.oracle.report_sql import K
    from txmon.oracle.reports_sql import RP
    from txmon.oracle.store_sql import S
    from txmon.oracle.timeliness_sql import T
    return {**Q, **K, **H, **D, **DQS, **RP, **B, **T, **DD, **Y, **V, **PF, **S}


# Queries timed by bench.py (monitor model, over materialized tables).
BENCH_QUERIES: dict[str, Callable[[Monitor], DataFrame]] = {
    "rule_summary": rule_summary_q,
    "rule_performance": MQ.rule_performance_table,
    **MQ.ALL,
}
