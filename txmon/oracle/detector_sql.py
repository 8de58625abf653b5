"""DuckDB oracle SQL for the typology detectors (per-rule hit counts) and N2-N4."""

from __future__ import annotations

from txmon.oracle.monitor_sql import R, sql
from txmon.oracle.report_sql import REPORT_CTES

H6 = 6 * 3600000000
H24 = 24 * 3600000000
D1 = 86400000000

ZT = """
, zt AS (
  SELECT t.*, epoch_us(t.transaction_date) AS us, a.customer_id, a.account_type, a.opened_at,
         c.pep_flag, c.country_of_residence
  FROM r_transactions t JOIN r_accounts a ON a.account_id = t.account_id
  JOIN r_customers c ON c.customer_id = a.customer_id)"""

_Z = {
    1: "SELECT transaction_id FROM zt WHERE channel IN ('branch', 'atm') AND amount >= 10000",
    2: f"""SELECT transaction_id FROM (
             SELECT transaction_id, COUNT(*) OVER (PARTITION BY account_id ORDER BY us
                    RANGE BETWEEN {H24} PRECEDING AND 1 PRECEDING) AS prev
             FROM zt WHERE amount >= 9500 AND amount < 10000) WHERE prev + 1 >= 2""",
    3: f"""SELECT o.transaction_id FROM zt o JOIN zt c
             ON c.account_id = o.account_id AND c.transaction_type = 'credit' AND o.transaction_type <> 'credit'
            AND o.us > c.us AND o.us - c.us <= {H6}
           GROUP BY o.transaction_id, o.amount HAVING o.amount >= arg_max(c.amount, row(c.us, c.transaction_id)) * 0.8""",
    4: """SELECT transaction_id FROM zt WHERE transaction_type = 'wire'
           AND counterparty_country IN (SELECT country_code FROM r_country WHERE fatf_status IN ('black_list', 'grey_list'))""",
    5: """SELECT transaction_id FROM zt WHERE (amount >= 1000 AND amount % 1000 = 0) OR (amount >= 500 AND amount % 100 = 0)
           OR (amount >= 5000 AND amount % 50 = 0)""",
    6: f"""SELECT transaction_id FROM (
             SELECT transaction_id, us - LAG(us) OVER (PARTITION BY account_id ORDER BY us, transaction_id) AS gap
             FROM zt) WHERE gap > 180 * {D1}""",
    7: f"""SELECT transaction_id FROM (
             SELECT transaction_id, COUNT(*) OVER (PARTITION BY account_id ORDER BY us
                    RANGE BETWEEN {3 * D1} PRECEDING AND 1 PRECEDING) AS prev
             FROM zt WHERE transaction_type = 'credit' AND amount < 3000) WHERE prev + 1 >= 5""",
    8: """SELECT transaction_id FROM zt WHERE transaction_type = 'wire' AND amount >= 5000
           AND counterparty_country IS NOT NULL AND counterparty_country <> COALESCE(country_of_residence, '')""",
    9: f"""SELECT transaction_id FROM (
             SELECT transaction_id, COUNT(*) OVER (PARTITION BY account_id ORDER BY us
                    RANGE BETWEEN {H24} PRECEDING AND 1 PRECEDING) AS prev FROM zt) WHERE prev + 1 >= 10""",
    10: f"SELECT transaction_id FROM zt WHERE us - epoch_us(opened_at) < 30 * {D1} AND amount > 50000",
    11: "SELECT transaction_id FROM zt WHERE pep_flag = 1",
    12: """SELECT transaction_id FROM zt
            WHERE counterparty_country IN (SELECT country_code FROM r_country WHERE risk_level = 'critical')""",
    13: f"""SELECT DISTINCT c.transaction_id FROM legs a
            JOIN legs b ON b.counterparty_name = a.counterparty_name AND b.us > a.us AND b.us - a.us <= {H24}
                       AND b.account_id <> a.account_id AND abs(b.amount - a.amount) <= a.amount * 0.05
            JOIN legs c ON c.counterparty_name = b.counterparty_name AND c.us > b.us AND c.us - b.us <= {H24}
                       AND c.account_id <> b.account_id AND c.account_id <> a.account_id
                       AND abs(c.amount - b.amount) <= b.amount * 0.05""",
    14: """SELECT s.transaction_id FROM small s JOIN (
              SELECT customer_id, d FROM small GROUP BY 1, 2 HAVING COUNT(DISTINCT account_id) >= 2) g
            ON g.customer_id = s.customer_id AND g.d = s.d""",
    15: "SELECT transaction_id FROM zt WHERE account_type = 'business' AND description IN ('groceries', 'rent', 'travel')",
}

D = {}

HITS = REPORT_CTES + ZT + """
, legs AS (SELECT * FROM zt WHERE transaction_type IN ('transfer', 'wire') AND counterparty_name IS NOT NULL),
small AS (SELECT *, CAST(transaction_date AS DATE) AS d FROM zt WHERE transaction_type = 'credit' AND amount < 3000),
hits AS (""" + " UNION ALL ".join(f"SELECT {k} AS rule_id, transaction_id FROM ({q})" for k, q in _Z.items()) + ")"

D["z_detections"] = sql(HITS + "\nSELECT rule_id, transaction_id FROM hits")
D["z_detection_counts"] = sql(HITS + """
SELECT r.rule_id, r.rule_name, CAST(COUNT(h.transaction_id) AS BIGINT) AS hits
FROM r_rules r LEFT JOIN hits h ON h.rule_id = r.rule_id GROUP BY 1, 2""")

D["n2_rolling_cash_deposits"] = sql(f"""
, cash AS (SELECT id, customer_id, us, timestamp, amount_usd FROM wide_m WHERE transaction_type = 'cash_deposit'),
w AS (SELECT *, coalesce(SUM(amount_usd) OVER (PARTITION BY customer_id ORDER BY us
             RANGE BETWEEN {7 * D1} PRECEDING AND 1 PRECEDING), 0) + amount_usd AS tot FROM cash)
SELECT id AS transaction_id, customer_id, timestamp, {R('tot', 2)} AS rolling_cash_usd FROM w WHERE tot > 25000""")

D["n3_tuned_dormant"] = sql(f"""
, g AS (SELECT id, account_id, us, timestamp, account_age_days, amount_usd,
               (us - LAG(us) OVER (PARTITION BY account_id ORDER BY us, id)) / {float(D1)} AS gap FROM wide_m)
SELECT id AS transaction_id, account_id, timestamp, {R('gap', 1)} AS idle_days,
       CAST(amount_usd AS DOUBLE) AS amount_usd
FROM g WHERE gap >= 14 AND account_age_days >= 90""")

D["n4_score_decay"] = sql(f"""
SELECT a.alert_id, a.transaction_id, a.rule_id, a.score,
       {R(f"a.score * pow(0.5, greatest((epoch_us(TIMESTAMP '2025-01-01 00:00:00') - w.us) / {float(D1)}, 0.0) / 30.0)", 2)}
         AS decayed_score
FROM alerts_m a JOIN wide_m w ON w.id = a.transaction_id""")
