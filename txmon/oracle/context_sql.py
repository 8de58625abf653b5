"""DuckDB oracle SQL for the analyst context and the searches."""

from __future__ import annotations

from txmon.oracle.monitor_sql import R
from txmon.oracle.report_sql import rsql
from txmon.oracle.reports_sql import ACTIVE, SEV

QUEUE = f"""
, queue AS (
  SELECT a.*, t.account_id FROM (SELECT * FROM r_alerts WHERE status IN {ACTIVE} ORDER BY {SEV}, created_at DESC, alert_id LIMIT 30) a
  JOIN r_transactions t ON t.transaction_id = a.transaction_id)"""

CONTEXT = QUEUE + f"""
, ctx AS (
  SELECT q.alert_id, q.status, q.severity, coalesce(q.assigned_to, 'Unassigned') AS assigned_to, q.created_at,
         {R('q.flagged_amount', 2)} AS flagged_amount, u.rule_name, u.rule_category,
         coalesce((SELECT {R("COUNT(*) FILTER (WHERE f.status = 'false_positive') * 100.0 / COUNT(*)", 1)}
                   FROM r_alerts f WHERE f.rule_id = q.rule_id), 0.0) AS rule_fp_rate,
         CASE WHEN u.threshold_value > 0 AND q.flagged_amount > 0
              THEN format('Transaction amount ${{:,.2f}} is {{:.1f}}% above rule threshold of ${{:,.2f}}', CAST(q.flagged_amount AS DOUBLE),
                          {R('(CAST(q.flagged_amount AS DOUBLE) - u.threshold_value) * 100.0 / u.threshold_value', 1)}, u.threshold_value)
              ELSE 'Transaction pattern matched rule: ' || u.rule_category || ' rule ' || u.rule_id END AS why_fired,
         t.transaction_id, t.transaction_date, t.transaction_type, t.currency, t.channel, t.status AS transaction_status,
         t.counterparty_name, t.counterparty_country, coalesce(k.country_name, t.counterparty_country) AS counterparty_country_name,
         coalesce(k.risk_level, 'unknown') AS counterparty_risk, c.customer_id, c.name AS customer_name, c.nationality,
         c.kyc_status, c.risk_rating, c.pep_flag, c.sanctions_flag,
         (SELECT COUNT(*) FROM r_txc x WHERE x.customer_id = q.customer_id) AS total_txns,
         {R('(SELECT SUM(amount) FROM r_txc x WHERE x.customer_id = q.customer_id)', 2)} AS total_volume,
         (SELECT COUNT(*) FROM r_alerts x WHERE x.customer_id = q.customer_id) AS alerts_count,
         a.account_id, a.account_type, {R('a.balance', 2)} AS balance, a.status AS account_status, a.opened_at
  FROM queue q JOIN r_rules u ON u.rule_id = q.rule_id JOIN r_transactions t ON t.transaction_id = q.transaction_id
       JOIN r_customers c ON c.customer_id = q.customer_id JOIN r_accounts a ON a.account_id = q.account_id
       LEFT JOIN r_country k ON k.country_code = t.counterparty_country)"""

SEARCH = f"""
, search AS (
  SELECT t.transaction_id, t.transaction_date, {R('t.amount', 2)} AS amount, t.currency, t.transaction_type, t.channel,
         t.counterparty_name, t.counterparty_country, coalesce(k.country_name, t.counterparty_country) AS counterparty_country_name,
         coalesce(k.risk_level, 'low') AS counterparty_risk, c.name AS customer_name, t.customer_id, t.description
  FROM r_txc t LEFT JOIN r_customers c ON c.customer_id = t.customer_id
       LEFT JOIN r_country k ON k.country_code = t.counterparty_country)"""

Y = {}
Y["y2_alert_context"] = rsql(CONTEXT + "\nSELECT * FROM ctx")

Y["y3_daily_activity"] = rsql(QUEUE + f"""
, days AS (SELECT CAST(i AS INTEGER) AS day_index, CAST(DATE '2024-01-01' + CAST(i AS INTEGER) AS DATE) AS d FROM range(31) x(i))
SELECT q.alert_id, q.customer_id, days.day_index,
       CASE WHEN CAST(q.created_at AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'
            THEN CAST(date_diff('day', DATE '2024-01-01', CAST(q.created_at AS DATE)) AS INTEGER) END AS alert_day_index,
       strftime(days.d, '%Y-%m-%d') AS day,
       (SELECT COUNT(*) FROM r_txc t WHERE t.customer_id = q.customer_id AND CAST(t.transaction_date AS DATE) = days.d) AS transactions,
       {R('coalesce((SELECT SUM(amount) FROM r_txc t WHERE t.customer_id = q.customer_id AND CAST(t.transaction_date AS DATE) = days.d), 0)', 2)}
         AS volume
FROM queue q, days""")

Y["y4_related_alerts"] = rsql(QUEUE + f"""
, newest AS (SELECT *, rank() OVER (PARTITION BY customer_id ORDER BY created_at DESC, alert_id) AS n FROM r_alerts),
near AS (SELECT q.alert_id, b.alert_id AS related_alert_id, b.rule_id, b.flagged_amount, b.status, b.created_at,
                CAST(b.n - (CASE WHEN own.n < b.n THEN 1 ELSE 0 END) AS INTEGER) AS position
         FROM queue q JOIN newest own ON own.alert_id = q.alert_id
              JOIN newest b ON b.customer_id = q.customer_id AND b.alert_id <> q.alert_id AND b.n <= 6)
SELECT n.alert_id, n.position, n.related_alert_id, u.rule_name, {R('n.flagged_amount', 2)} AS amount, n.status,
       strftime(n.created_at, '%Y-%m-%d') AS date
FROM near n JOIN r_rules u ON u.rule_id = n.rule_id WHERE n.position <= 5""")

Y["y5_network"] = rsql(QUEUE + f"""
, links AS (SELECT account_id, counterparty_name, COUNT(*) AS transactions, SUM(amount) AS v, MAX(counterparty_country) AS country
            FROM r_transactions WHERE counterparty_name <> '' AND account_id IN (SELECT account_id FROM queue) GROUP BY 1, 2)
SELECT l.account_id, CAST(1 + (SELECT COUNT(*) FROM links o WHERE o.account_id = l.account_id AND (o.transactions > l.transactions
         OR o.transactions = l.transactions AND o.counterparty_name < l.counterparty_name)) AS INTEGER) AS position,
       l.counterparty_name, l.country, coalesce(k.country_name, l.country) AS country_name, coalesce(k.risk_level, 'low') AS risk_level,
       l.transactions, {R('l.v', 2)} AS volume
FROM links l LEFT JOIN r_country k ON k.country_code = l.country
WHERE (SELECT COUNT(*) FROM links o WHERE o.account_id = l.account_id AND (o.transactions > l.transactions
         OR o.transactions = l.transactions AND o.counterparty_name < l.counterparty_name)) < 8""")

Y["y6_risk_score"] = rsql(CONTEXT + """
, parts AS (SELECT alert_id, CASE risk_rating WHEN 'low' THEN 25 WHEN 'high' THEN 80 ELSE 50 END AS base, pep_flag,
                   CASE counterparty_risk WHEN 'low' THEN 15 WHEN 'unknown' THEN 15 WHEN 'medium' THEN 35 WHEN 'high' THEN 65
                                          ELSE 30 END AS geo FROM ctx),
whole AS (SELECT *, least(100, base + 30 * pep_flag) AS profile FROM parts),
scored AS (SELECT *, CAST(round_even((55 * base + 20 * geo + 25 * profile) / 100.0, 0) AS INTEGER) AS total FROM whole)
SELECT alert_id, base AS transaction_behavior, geo AS geographic_risk, profile AS customer_profile, base AS network_risk,
       base AS velocity_risk, total AS total_risk,
       CASE WHEN total >= 75 THEN 'HIGH RISK' WHEN total >= 50 THEN 'MEDIUM RISK' ELSE 'LOW RISK' END AS label FROM scored""")

Y["y7_newest_transactions"] = rsql(SEARCH + "\nSELECT * FROM search ORDER BY transaction_date DESC, transaction_id LIMIT 200")
Y["y8_transaction_search"] = rsql(SEARCH + """
SELECT * FROM search WHERE amount BETWEEN 100 AND 200000 AND CAST(transaction_date AS DATE) BETWEEN DATE '1996-01-01'
  AND DATE '2024-01-20' AND counterparty_country = 'N03' AND channel = 'wire'
ORDER BY transaction_date DESC, transaction_id LIMIT 10""")
Y["y8_queue_search"] = rsql("""
SELECT a.alert_id, a.customer_id, c.name AS customer_name, a.rule_id, a.status, a.severity, a.created_at
FROM r_alerts a JOIN r_customers c ON c.customer_id = a.customer_id
WHERE a.status = 'escalated' AND a.severity = 'high'
  AND (a.alert_id ILIKE '%customer#%' OR c.name ILIKE '%customer#%' OR c.customer_id ILIKE '%customer#%')""")
