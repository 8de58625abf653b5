"""DuckDB oracle SQL for the executive, filing and rule reports."""

from __future__ import annotations

from txmon.oracle.monitor_sql import R
from txmon.oracle.report_sql import RULE_FIGURES, rsql

MONTH = "created_at >= TIMESTAMP '2024-01-01' AND created_at < TIMESTAMP '2024-02-01'"
TITLES = {"new": "New", "under_review": "Under Review", "escalated": "Escalated", "true_positive": "True Positive",
          "false_positive": "False Positive"}
TITLED = "CASE status " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TITLES.items()) + " END"


def _fixed(column: str, values: dict[str, str]) -> str:
    rows = ", ".join(f"({i + 1}, '{k}', '{v}')" for i, (k, v) in enumerate(values.items()))
    return rsql(f"""
, wanted(position, raw, shown) AS (VALUES {rows})
SELECT w.position, w.shown AS {column}, COUNT(a.alert_id) AS alerts,
       {R('COUNT(a.alert_id) * 100.0 / (SELECT COUNT(*) FROM r_alerts)', 1)} AS pct
FROM wanted w LEFT JOIN r_alerts a ON a.{column} = w.raw GROUP BY w.position, w.shown""")


RULES = RULE_FIGURES + f"""
, shown AS (
  SELECT rule_id, rule_name, upper(left(array_to_string([left(w, 1) FOR w IN string_split(rule_name, ' ')], ''), 4)) AS initials,
         {R('precision_score', 4)} AS precision, {R('recall_score', 4)} AS recall,
         coalesce({R('2 * precision_score * recall_score / nullif(precision_score + recall_score, 0)', 4)}, 0.0) AS f1,
         total_alerts_generated AS alerts FROM figures)"""

V = {}
V["m3_by_status"] = rsql(f"SELECT {TITLED} AS status, COUNT(*) AS alerts FROM r_alerts WHERE {MONTH} GROUP BY 1")
V["m3_by_day"] = rsql(f"SELECT strftime(created_at, '%Y-%m-%d') AS day, COUNT(*) AS alerts FROM r_alerts WHERE {MONTH} GROUP BY 1")
V["v2_weekly_series_52"] = rsql("""
, both_ AS (SELECT transaction_date AS moment, 1 AS t, 0 AS a FROM r_transactions UNION ALL SELECT created_at, 0, 1 FROM r_alerts)
SELECT strftime(moment, '%Y-W%W') AS week, CAST(SUM(t) AS BIGINT) AS transactions, CAST(SUM(a) AS BIGINT) AS alerts
FROM both_ WHERE CAST(moment AS DATE) >= DATE '2024-01-31' - 364 GROUP BY 1""")
V["v3_severity_mix"] = _fixed("severity", {"critical": "Critical", "high": "High", "medium": "Medium", "low": "Low"})
V["v3_status_funnel"] = _fixed("status", TITLES)
V["v3_top_countries"] = rsql("""
SELECT t.counterparty_country AS country, coalesce(ANY_VALUE(c.risk_level), 'unknown') AS risk_level, COUNT(*) AS alerts
FROM r_alerts a JOIN r_transactions t ON t.transaction_id = a.transaction_id
     LEFT JOIN r_country c ON c.country_code = t.counterparty_country
GROUP BY 1 ORDER BY alerts DESC, coalesce(country, '') LIMIT 10""")
V["v4_rule_table"] = rsql(RULES + "\nSELECT * FROM shown")
V["g3_best_worst"] = rsql(RULES + """
, placed AS (SELECT rule_id, rule_name, precision, alerts,
                    CAST(row_number() OVER (ORDER BY precision DESC, alerts DESC, rule_id) AS INTEGER) AS from_best,
                    CAST(row_number() OVER (ORDER BY precision, alerts, rule_id) AS INTEGER) AS from_worst FROM shown)
SELECT * FROM placed WHERE least(from_best, from_worst) <= 3""")
V["g3_totals"] = rsql(RULES + f"""
SELECT {R('AVG(precision)', 4)} AS avg_precision, {R('AVG(recall)', 4)} AS avg_recall, {R('AVG(f1)', 4)} AS avg_f1,
       CAST(SUM(alerts) AS BIGINT) AS total_generated, COUNT(*) AS rules, COUNT(*) FILTER (WHERE f1 < 0.5) AS weak_rules FROM shown""")
V["g3_weak_rules"] = rsql(RULES + """
SELECT s.rule_id, s.rule_name, r.rule_category, r.threshold_value, s.f1, s.alerts
FROM shown s JOIN r_rules r ON r.rule_id = s.rule_id WHERE s.f1 < 0.5""")
V["g4_rule_volume"] = rsql(f"SELECT rule_id, COUNT(*) AS alerts, {R('SUM(flagged_amount)', 2)} AS total_amount FROM r_alerts GROUP BY 1")
V["g4_coverage"] = rsql(f"""
, n AS (SELECT (SELECT COUNT(*) FROM r_alerts) AS alerts, (SELECT COUNT(*) FROM r_transactions) AS transactions)
SELECT alerts, transactions, {R('least(99.0, alerts * 2500.0 / greatest(transactions, 1))', 2)} AS coverage_pct FROM n""")
V["v5_recent_alerts"] = rsql(f"""
SELECT a.alert_id, strftime(a.created_at, '%Y-%m-%d') AS date, c.name AS customer_name, {R('a.flagged_amount', 2)} AS amount,
       u.rule_name, a.severity, {TITLED.replace('status', 'a.status', 1)} AS status, coalesce(a.assigned_to, 'Unassigned') AS assigned_to
FROM r_alerts a JOIN r_customers c ON c.customer_id = a.customer_id JOIN r_rules u ON u.rule_id = a.rule_id
ORDER BY a.created_at DESC, a.alert_id LIMIT 20""")
V["v5_monthly_amounts"] = rsql(f"""
SELECT strftime(transaction_date, '%Y-%m') AS month, COUNT(*) AS transactions, {R('SUM(amount)', 2)} AS total_amount
FROM r_transactions WHERE transaction_date >= TIMESTAMP '2024-01-31' - INTERVAL 365 DAY GROUP BY 1""")
V["v5_customer_risk"] = rsql("SELECT risk_rating, COUNT(*) AS customers FROM r_customers GROUP BY 1")
