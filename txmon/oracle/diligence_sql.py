"""DuckDB oracle SQL for customer due diligence: correlated subqueries and the plain fan-out joins."""

from __future__ import annotations

from txmon.oracle.monitor_sql import R
from txmon.oracle.report_sql import rsql

ALERTS = "(SELECT COUNT(*) FROM r_alerts a WHERE a.customer_id = c.customer_id)"
STATUS = "(SELECT MAX(status) FROM r_accounts x WHERE x.customer_id = c.customer_id)"
LAST = "(SELECT MAX(transaction_date) FROM r_txc t WHERE t.customer_id = c.customer_id)"

DD = {}
DD["c1_high_risk_share"] = rsql(f"""
, v AS (SELECT c.risk_rating IN ('high', 'critical') AS up, SUM(t.amount) AS v FROM r_customers c
        JOIN r_txc t ON t.customer_id = c.customer_id GROUP BY 1),
n AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE risk_rating IN ('high', 'critical')) AS k FROM r_customers)
SELECT k AS customers, {R('k * 100.0 / n', 1)} AS customer_pct, {R('(SELECT v FROM v WHERE up)', 2)} AS volume,
       {R('(SELECT v FROM v WHERE up) * 100.0 / (SELECT SUM(v) FROM v)', 1)} AS volume_pct FROM n""")

DD["c2_high_risk_customers"] = rsql(f"""
SELECT customer_id, name, risk_rating, kyc_status, pep_flag, sanctions_flag, nationality, country_of_residence,
       {ALERTS} AS alert_count, {STATUS} AS account_status, {LAST} AS last_transaction
FROM r_customers c WHERE risk_rating = 'high' OR risk_rating = 'critical'""")

DD["c4_enhanced_diligence"] = rsql(f"""
, d AS (SELECT c.*, {ALERTS} AS alert_count, {STATUS} AS account_status FROM r_customers c),
e AS (SELECT *, list_filter([CASE WHEN risk_rating = 'critical' THEN 'Critical risk rating' END,
                             CASE WHEN pep_flag = 1 THEN 'PEP exposure' END, CASE WHEN sanctions_flag = 1 THEN 'Sanctions flag' END,
                             CASE WHEN alert_count > 3 THEN alert_count || ' alerts' END], lambda x: x IS NOT NULL) AS why
      FROM d WHERE risk_rating = 'critical' OR risk_rating = 'high' AND (pep_flag = 1 OR alert_count > 3))
SELECT customer_id, name, risk_rating, kyc_status, pep_flag, sanctions_flag, nationality, alert_count, account_status,
       CASE WHEN len(why) = 0 THEN 'Risk threshold exceeded' ELSE array_to_string(why, '; ') END
         || CASE WHEN kyc_status IN ('expired', 'failed') THEN ' + ' || kyc_status || ' KYC' ELSE '' END AS reason,
       CASE risk_rating WHEN 'critical' THEN 'Immediate' ELSE 'High' END AS priority,
       CASE risk_rating WHEN 'critical' THEN 'Overdue' ELSE 'Due Soon' END AS review FROM e""")

DD["c5_kyc_remediation"] = rsql("""
SELECT customer_id, name, kyc_status, risk_rating, pep_flag, 'active' AS account_status,
       (SELECT MAX(t.transaction_date) FROM r_transactions t JOIN r_accounts x ON x.account_id = t.account_id
        WHERE x.customer_id = c.customer_id AND x.status = 'active') AS last_transaction,
       CASE kyc_status WHEN 'failed' THEN 'Suspend Account' ELSE 'Request Updated KYC' END AS action
FROM r_customers c
WHERE kyc_status IN ('expired', 'failed') AND customer_id IN (SELECT customer_id FROM r_accounts WHERE status = 'active')
ORDER BY list_position(['critical', 'high', 'medium', 'low'], risk_rating), last_transaction DESC NULLS LAST, customer_id
LIMIT 20""")

DD["c6_exposed_customers"] = rsql(f"""
SELECT c.customer_id, c.name, c.risk_rating, c.pep_flag, c.sanctions_flag, c.nationality, c.kyc_status,
       COUNT(a.alert_id) AS alerts, {R('COALESCE(SUM(t.amount), 0)', 2)} AS txn_volume
FROM r_customers c LEFT JOIN r_alerts a ON a.customer_id = c.customer_id
     LEFT JOIN r_accounts x ON x.customer_id = c.customer_id LEFT JOIN r_transactions t ON t.account_id = x.account_id
WHERE c.pep_flag = 1 OR c.sanctions_flag = 1 GROUP BY ALL""")
