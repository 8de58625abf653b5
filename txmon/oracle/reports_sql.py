"""DuckDB oracle SQL for the report aggregates (M, G, C, V, Y, D05)."""

from __future__ import annotations

from txmon.oracle.monitor_sql import R
from txmon.oracle.report_sql import RULE_FIGURES, rsql

SEV = "CASE severity WHEN 'critical' THEN 1 WHEN 'high' THEN 2 WHEN 'medium' THEN 3 WHEN 'low' THEN 4 ELSE 5 END"
ACTIVE = "('new', 'under_review', 'escalated')"


def _chg(cur: str, prev: str) -> str:
    return f"CASE WHEN {prev} <> 0 THEN {R(f'({cur} - {prev}) * 100.0 / {prev}', 1)} ELSE 0.0 END"


RP = {}

RP["m1_month_over_month"] = rsql(f"""
, g AS (
  SELECT CAST(SUM(CASE WHEN strftime(created_at, '%Y-%m') = '2024-01' THEN 1 ELSE 0 END) AS BIGINT) AS cur_n,
         CAST(SUM(CASE WHEN strftime(created_at, '%Y-%m') = '2023-12' THEN 1 ELSE 0 END) AS BIGINT) AS prev_n,
         COALESCE(SUM(CASE WHEN strftime(created_at, '%Y-%m') = '2024-01' THEN flagged_amount END), 0) AS a,
         COALESCE(SUM(CASE WHEN strftime(created_at, '%Y-%m') = '2023-12' THEN flagged_amount END), 0) AS b
  FROM r_alerts)
SELECT cur_n AS alerts_this_month, prev_n AS alerts_prev_month, {R('a', 2)} AS amount_this_month,
       {R('b', 2)} AS amount_prev_month, {_chg('cur_n', 'prev_n')} AS alerts_change_pct,
       {_chg('a', 'b')} AS amount_change_pct FROM g""")

RP["m2_filing"] = rsql(f"""
SELECT COUNT(*) AS total_alerts,
       CAST(SUM(CASE WHEN status IN ('true_positive', 'escalated') THEN 1 ELSE 0 END) AS BIGINT) AS filed,
       CAST(SUM(CASE WHEN status IN ('new', 'under_review') THEN 1 ELSE 0 END) AS BIGINT) AS open_remainder,
       {R("SUM(CASE WHEN status IN ('true_positive', 'escalated') THEN 1 ELSE 0 END) * 100.0 / COUNT(*)", 1)}
         AS filing_rate_pct
FROM r_alerts""")

RP["m3_by_severity"] = rsql(f"""
SELECT {SEV} AS severity_rank, severity, COUNT(*) AS alerts, {R('SUM(flagged_amount)', 2)} AS flagged_amount
FROM r_alerts GROUP BY severity""")

RP["m3_by_category"] = rsql(f"""
, g AS (SELECT r.rule_category, COUNT(*) AS alerts, SUM(a.flagged_amount) AS s
        FROM r_alerts a JOIN r_rules r ON r.rule_id = a.rule_id GROUP BY 1)
SELECT rule_category, alerts, {R('alerts * 100.0 / SUM(alerts) OVER ()', 1)} AS share_pct,
       {R('s / alerts', 2)} AS avg_amount, {R('s', 2)} AS total_amount FROM g""")

RP["m5_category_trend"] = rsql("""
, months AS (SELECT strftime(m, '%Y-%m') AS month
             FROM range(TIMESTAMP '2023-08-01', TIMESTAMP '2024-01-02', INTERVAL 1 MONTH) t(m)),
grid AS (SELECT DISTINCT r.rule_category, months.month FROM r_rules r CROSS JOIN months),
c AS (SELECT r.rule_category, strftime(a.created_at, '%Y-%m') AS month, COUNT(*) AS n
      FROM r_alerts a JOIN r_rules r ON r.rule_id = a.rule_id GROUP BY 1, 2)
SELECT g.rule_category, g.month, CAST(COALESCE(c.n, 0) AS BIGINT) AS alerts
FROM grid g LEFT JOIN c ON c.rule_category = g.rule_category AND c.month = g.month""")

RP["g1_rule_quadrants"] = rsql(RULE_FIGURES + f"""
SELECT rule_id, rule_name, rule_category, {R('precision_score', 4)} AS precision, {R('recall_score', 4)} AS recall,
       {R('2 * precision_score * recall_score / (precision_score + recall_score + 0.0001)', 4)} AS f1,
       CASE WHEN precision_score >= 0.65 AND recall_score >= 0.65 THEN 'Champion'
            WHEN precision_score < 0.65 AND recall_score >= 0.65 THEN 'Noisy'
            WHEN precision_score >= 0.65 AND recall_score < 0.65 THEN 'Conservative' ELSE 'Needs Review' END AS quadrant
FROM figures""")

RP["c1_risk_distribution"] = rsql(f"""
, vol AS (SELECT customer_id, SUM(amount) AS v FROM r_txc GROUP BY 1)
SELECT c.risk_rating, COUNT(*) AS customers, {R('COALESCE(SUM(vol.v), 0)', 2)} AS volume
FROM r_customers c LEFT JOIN vol ON vol.customer_id = c.customer_id GROUP BY 1""")

RP["c3_alert_histogram"] = rsql("""
, per AS (SELECT customer_id, COUNT(*) AS n FROM r_alerts GROUP BY 1),
sz AS (SELECT greatest(1, MAX(n) // 12) AS size FROM per)
SELECT CAST((per.n // sz.size) * sz.size AS BIGINT) AS bucket, COUNT(*) AS customers FROM per, sz GROUP BY 1""")

RP["v1_executive_kpis"] = rsql(f"""
SELECT (SELECT COUNT(*) FROM r_transactions) AS transactions,
       CAST(SUM(CASE WHEN status IN {ACTIVE} THEN 1 ELSE 0 END) AS BIGINT) AS active_alerts,
       CAST(SUM(CASE WHEN status IN {ACTIVE} AND severity = 'critical' THEN 1 ELSE 0 END) AS BIGINT) AS active_critical,
       CAST(SUM(CASE WHEN status IN {ACTIVE} AND severity = 'high' THEN 1 ELSE 0 END) AS BIGINT) AS active_high,
       CAST(SUM(CASE WHEN status IN {ACTIVE} AND severity = 'medium' THEN 1 ELSE 0 END) AS BIGINT) AS active_medium,
       CAST(SUM(CASE WHEN status IN {ACTIVE} AND severity = 'low' THEN 1 ELSE 0 END) AS BIGINT) AS active_low,
       {R("SUM(CASE WHEN status IN ('true_positive', 'false_positive') THEN 1 ELSE 0 END) * 100.0 / COUNT(*)", 1)}
         AS closure_pct,
       {R("AVG(CASE WHEN status IN ('true_positive', 'false_positive') THEN (epoch_us(updated_at) - epoch_us(created_at)) / 86400e6 END)", 1)}
         AS mean_days_to_close,
       {R('SUM(flagged_amount)', 2)} AS flagged_total,
       (SELECT CAST(SUM(CASE WHEN risk_rating IN ('high', 'critical') THEN 1 ELSE 0 END) AS BIGINT) FROM r_customers)
         AS high_risk_customers
FROM r_alerts""")

RP["v2_weekly_series"] = rsql("""
, tx AS (SELECT strftime(CAST(transaction_date AS DATE), '%Y-W%W') AS week, COUNT(*) AS t FROM r_transactions
         WHERE CAST(transaction_date AS DATE) >= DATE '2024-01-31' - 84 GROUP BY 1),
al AS (SELECT strftime(CAST(created_at AS DATE), '%Y-W%W') AS week, COUNT(*) AS a FROM r_alerts
       WHERE CAST(created_at AS DATE) >= DATE '2024-01-31' - 84 GROUP BY 1)
SELECT COALESCE(tx.week, al.week) AS week, CAST(COALESCE(tx.t, 0) AS BIGINT) AS transactions,
       CAST(COALESCE(al.a, 0) AS BIGINT) AS alerts
FROM tx FULL OUTER JOIN al ON al.week = tx.week""")

RP["y1_triage_queue"] = rsql(f"""
SELECT alert_id, customer_id, rule_id, severity, status, created_at, {R('flagged_amount', 2)} AS flagged_amount
FROM r_alerts WHERE status IN {ACTIVE}
ORDER BY {SEV}, created_at DESC, alert_id LIMIT 30""")

RP["d05_freshness"] = rsql("""
SELECT MAX(transaction_date) AS latest,
       CAST(floor((epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(MAX(transaction_date))) / 86400000000.0)
            AS BIGINT) AS freshness_days
FROM r_transactions""")

RP["m4_top_alerts"] = rsql(f"""
, place AS (SELECT *, row_number() OVER (ORDER BY {SEV}, flagged_amount DESC, alert_id) AS i FROM r_alerts)
SELECT p.alert_id, p.created_at, p.customer_id, (SELECT name FROM r_customers c WHERE c.customer_id = p.customer_id) AS customer_name,
       r.rule_name, r.rule_category, {R('p.flagged_amount', 2)} AS flagged_amount, p.severity, p.status
FROM place p JOIN r_rules r USING (rule_id) WHERE i <= 5""")

RP["c5_kyc_distribution"] = rsql("""
SELECT DISTINCT kyc_status, COUNT(*) OVER (PARTITION BY kyc_status) AS customers FROM r_customers""")

RP["c6_pep_sanctions"] = rsql("""
SELECT COUNT(*) FILTER (WHERE pep_flag = 1) AS pep_count, COUNT(*) FILTER (WHERE sanctions_flag = 1) AS sanctions_count,
       COUNT(*) FILTER (WHERE pep_flag = 1 AND risk_rating = 'critical') AS pep_critical,
       COUNT(*) FILTER (WHERE pep_flag = 1 AND risk_rating = 'high') AS pep_high,
       COUNT(*) FILTER (WHERE sanctions_flag = 1 AND risk_rating = 'critical') AS sanctions_critical,
       COUNT(*) FILTER (WHERE sanctions_flag = 1 AND risk_rating = 'high') AS sanctions_high
FROM r_customers""")

RP["v3_top_rules"] = rsql("""
, n AS (SELECT r.rule_name, (SELECT COUNT(*) FROM r_alerts a WHERE a.rule_id = r.rule_id) AS alerts FROM r_rules r)
SELECT rule_name, alerts FROM n WHERE alerts > 0 ORDER BY alerts DESC, rule_name LIMIT 10""")

RP["v5_workload"] = rsql("""
, named AS (SELECT CASE WHEN assigned_to IS NULL THEN 'Unassigned' ELSE assigned_to END AS analyst, status FROM r_alerts)
SELECT analyst, COUNT(*) AS alerts, COUNT(*) FILTER (WHERE status = 'true_positive') AS true_positives,
       COUNT(*) FILTER (WHERE status = 'false_positive') AS false_positives
FROM named GROUP BY analyst ORDER BY alerts DESC, analyst LIMIT 8""")
