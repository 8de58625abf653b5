"""DuckDB oracle SQL for the read models (H1-H11, not H5's nested lists) and exports."""

from __future__ import annotations

from txmon.oracle.monitor_sql import DIV, R, sql

H = {}

ALERT_ROWS = """
, ar AS (
  SELECT al.alert_id, al.transaction_id, al.rule_id, al.score, al.status,
         TIMESTAMP '2025-01-01 00:00:00' AS created_date, CAST(NULL AS TIMESTAMP) AS resolved_date,
         r.name AS rule_name, r.category, CAST(r.severity AS DOUBLE) AS severity,
         t.account_id, t.customer_id, c.name AS customer_name, c.risk_rating, c.pep_status, c.customer_type,
         c.kyc_status, c.country AS customer_country, t.transaction_type, CAST(t.amount AS DOUBLE) AS amount,
         t.currency, CAST(t.amount_usd AS DOUBLE) AS amount_usd, t.timestamp, t.counterparty_account,
         t.counterparty_country, t.channel, t.velocity_1h, t.velocity_24h, t.velocity_7d, t.country_risk_score,
         t.is_new_counterparty, t.is_round_amount,
         al.rule_score, al.customer_risk_score, al.geographic_risk_score, al.behavioral_score,
         al.score AS composite_score
  FROM alerts_m al JOIN rules_m r ON r.id = al.rule_id JOIN wide_m t ON t.id = al.transaction_id
  JOIN customers_m c ON c.id = t.customer_id)"""

H["h01_stats"] = sql(f"""
SELECT (SELECT COUNT(*) FROM customers_m) AS customers, (SELECT COUNT(*) FROM accounts_m) AS accounts,
       (SELECT COUNT(*) FROM wide_m) AS transactions,
       (SELECT CAST(round(SUM(amount_usd), 2) AS DOUBLE) FROM wide_m) AS total_volume_usd,
       (SELECT COUNT(*) FROM alerts_m) AS alerts,
       (SELECT CAST(COUNT(*) AS BIGINT) FROM alerts_m WHERE status = 'open') AS open_alerts,
       (SELECT CAST(COUNT(*) AS BIGINT) FROM alerts_m WHERE score >= 60) AS high_score_alerts,
       (SELECT CAST(COUNT(*) AS BIGINT) FROM rules_m WHERE is_active = 1) AS rules_active,
       (SELECT CAST(COUNT(*) AS BIGINT) FROM customers_m WHERE risk_rating = 1) AS customers_risk_1,
       (SELECT CAST(COUNT(*) AS BIGINT) FROM customers_m WHERE risk_rating = 2) AS customers_risk_2,
       (SELECT CAST(COUNT(*) AS BIGINT) FROM customers_m WHERE risk_rating = 3) AS customers_risk_3,
       {R(DIV('100.0 * (SELECT COUNT(DISTINCT transaction_id) FROM alerts_m)', '(SELECT COUNT(*) FROM wide_m)'), 2)}
         AS alert_rate_pct""")

H["h02_alerted_wires"] = sql("""
, f AS (
  SELECT t.id, t.account_id, t.transaction_type, CAST(t.amount AS DOUBLE) AS amount, t.currency, t.timestamp,
         t.counterparty_account, t.counterparty_name, t.counterparty_country, t.channel, t.status,
         CAST(t.amount_usd AS DOUBLE) AS amount_usd, t.velocity_1h, t.velocity_24h, t.country_risk_score,
         t.is_round_amount, t.is_large_cash, c.id AS customer_id, c.name AS customer_name
  FROM wide_m t JOIN customers_m c ON c.id = t.customer_id
  WHERE t.transaction_type = 'wire_out' AND t.amount >= 1000
    AND EXISTS (SELECT 1 FROM alerts_m al WHERE al.transaction_id = t.id)),
tot AS (SELECT COUNT(*) AS total FROM f)
SELECT f.*, tot.total, CAST(floor((tot.total + 49) / 50) AS BIGINT) AS pages
FROM f CROSS JOIN tot ORDER BY f.timestamp DESC, f.id DESC LIMIT 50 OFFSET 0""")

H["h02_transactions"] = sql("""
, f AS (
  SELECT t.id, t.account_id, t.transaction_type, CAST(t.amount AS DOUBLE) AS amount, t.currency, t.timestamp,
         t.counterparty_account, t.counterparty_name, t.counterparty_country, t.channel, t.status,
         CAST(t.amount_usd AS DOUBLE) AS amount_usd, t.velocity_1h, t.velocity_24h, t.country_risk_score,
         t.is_round_amount, t.is_large_cash, c.id AS customer_id, c.name AS customer_name
  FROM wide_m t JOIN customers_m c ON c.id = t.customer_id),
tot AS (SELECT COUNT(*) AS total FROM f)
SELECT f.*, tot.total, CAST(floor((tot.total + 49) / 50) AS BIGINT) AS pages
FROM f CROSS JOIN tot ORDER BY f.timestamp DESC, f.id DESC LIMIT 50 OFFSET 0""")

H["h02_before_date"] = sql("""
, f AS (
  SELECT t.id, t.account_id, t.transaction_type, CAST(t.amount AS DOUBLE) AS amount, t.currency, t.timestamp,
         t.counterparty_account, t.counterparty_name, t.counterparty_country, t.channel, t.status,
         CAST(t.amount_usd AS DOUBLE) AS amount_usd, t.velocity_1h, t.velocity_24h, t.country_risk_score,
         t.is_round_amount, t.is_large_cash, c.id AS customer_id, c.name AS customer_name
  FROM wide_m t JOIN customers_m c ON c.id = t.customer_id
  WHERE t.timestamp < TIMESTAMP '1998-01-01 00:00:00'),
tot AS (SELECT COUNT(*) AS total FROM f)
SELECT f.*, tot.total, CAST(floor((tot.total + 199) / 200) AS BIGINT) AS pages
FROM f CROSS JOIN tot ORDER BY f.timestamp DESC, f.id DESC LIMIT 200 OFFSET 200""")

H["h03_geographic"] = sql(ALERT_ROWS + """
, f AS (
  SELECT alert_id, transaction_id, rule_id, score, status, created_date, resolved_date, rule_name, category,
         severity, amount, currency, timestamp AS txn_timestamp, transaction_type, customer_id, customer_name,
         risk_rating, pep_status
  FROM ar WHERE score >= 50.0 AND category = 'geographic'),
tot AS (SELECT COUNT(*) AS total FROM f)
SELECT f.*, tot.total, CAST(floor((tot.total + 49) / 50) AS BIGINT) AS pages
FROM f CROSS JOIN tot ORDER BY score DESC, created_date DESC, alert_id LIMIT 50 OFFSET 0""")

H["h03_alerts"] = sql(ALERT_ROWS + """
, f AS (
  SELECT alert_id, transaction_id, rule_id, score, status, created_date, resolved_date, rule_name, category,
         severity, amount, currency, timestamp AS txn_timestamp, transaction_type, customer_id, customer_name,
         risk_rating, pep_status
  FROM ar),
tot AS (SELECT COUNT(*) AS total FROM f)
SELECT f.*, tot.total, CAST(floor((tot.total + 49) / 50) AS BIGINT) AS pages
FROM f CROSS JOIN tot ORDER BY score DESC, created_date DESC, alert_id LIMIT 50 OFFSET 0""")

H["h04_alert_detail"] = sql(ALERT_ROWS + """
, more AS (SELECT id, counterparty_name, is_large_cash, CAST(amount_velocity_24h AS DOUBLE) AS amount_velocity_24h, account_age_days
           FROM wide_m),
described AS (SELECT id AS rid, description AS rule_description FROM rules_m)
SELECT ar.*, d.rule_description, w.* EXCLUDE (id) FROM (
SELECT alert_id, transaction_id, rule_id, score, status, rule_name, category, severity, account_id, customer_id,
       customer_name, customer_type, risk_rating, kyc_status, pep_status, customer_country, transaction_type, amount,
       currency, amount_usd, timestamp, counterparty_account, counterparty_country, channel, velocity_1h,
       velocity_24h, velocity_7d, country_risk_score, is_new_counterparty, is_round_amount, rule_score,
       customer_risk_score, geographic_risk_score, behavioral_score, composite_score,
       TIMESTAMP '2025-01-01' AS created_date, CAST(NULL AS TIMESTAMP) AS resolved_date, CAST(NULL AS VARCHAR) AS notes FROM ar) ar
JOIN more w ON w.id = ar.transaction_id JOIN described d ON d.rid = ar.rule_id""")

H["h06_rules"] = sql(f"""
SELECT r.id, r.name, r.description, r.category, CAST(r.severity AS DOUBLE) AS severity, r.is_active,
       CAST(COUNT(a.alert_id) AS BIGINT) AS alert_count, {R('AVG(CAST(a.score AS DECIMAL(5,2)))', 1)} AS avg_score
FROM rules_m r LEFT JOIN alerts_m a ON a.rule_id = r.id
GROUP BY r.id, r.name, r.description, r.category, r.severity, r.is_active""")

H["h07_timeline"] = sql(f"""
SELECT strftime(t.timestamp, '%Y-%m') AS month, CAST(COUNT(t.id) AS BIGINT) AS transaction_count,
       {R('SUM(t.amount_usd)', 0)} AS total_volume_usd, CAST(COUNT(DISTINCT al.alert_id) AS BIGINT) AS alert_count,
       CAST(COUNT(DISTINCT CASE WHEN al.score >= 60 THEN al.alert_id END) AS BIGINT) AS high_alerts
FROM wide_m t LEFT JOIN alerts_m al ON al.transaction_id = t.id
GROUP BY 1""")

H["h08_risk_distribution"] = sql(f"""
SELECT c.risk_rating, CAST(COUNT(DISTINCT c.id) AS BIGINT) AS customers,
       CAST(COUNT(DISTINCT t.id) AS BIGINT) AS transactions, CAST(COUNT(DISTINCT al.alert_id) AS BIGINT) AS alerts,
       {R('AVG(CAST(al.score AS DECIMAL(5,2)))', 1)} AS avg_alert_score
FROM customers_m c LEFT JOIN accounts_m a ON a.customer_id = c.id LEFT JOIN wide_m t ON t.account_id = a.id
LEFT JOIN alerts_m al ON al.transaction_id = t.id
GROUP BY c.risk_rating""")

H["h09_rule_performance"] = sql(f"""
SELECT r.id, r.name, r.category, CAST(r.severity AS DOUBLE) AS severity,
       CAST(COUNT(al.alert_id) AS BIGINT) AS total_alerts, {R('AVG(CAST(al.score AS DECIMAL(5,2)))', 2)} AS avg_score,
       {R('MIN(al.score)', 2)} AS min_score, {R('MAX(al.score)', 2)} AS max_score,
       CAST(COUNT(DISTINCT t.account_id) AS BIGINT) AS unique_accounts,
       CAST(SUM(CASE WHEN al.score >= 60 THEN 1 ELSE 0 END) AS BIGINT) AS high_score_alerts
FROM rules_m r LEFT JOIN alerts_m al ON al.rule_id = r.id LEFT JOIN wide_m t ON t.id = al.transaction_id
WHERE r.is_active = 1
GROUP BY r.id, r.name, r.category, r.severity""")

H["h10_geographic"] = sql(f"""
SELECT COALESCE(t.counterparty_country, 'DOMESTIC') AS country_code, cr.country_name, cr.risk_level,
       CAST(COUNT(t.id) AS BIGINT) AS transaction_count, {R('SUM(t.amount_usd)', 0)} AS total_usd,
       CAST(COUNT(DISTINCT al.alert_id) AS BIGINT) AS alert_count
FROM wide_m t LEFT JOIN country_risk_m cr ON cr.country_code = t.counterparty_country
LEFT JOIN alerts_m al ON al.transaction_id = t.id
GROUP BY t.counterparty_country, cr.country_name, cr.risk_level
ORDER BY alert_count DESC, country_code LIMIT 40""")

H["h11_top_customers"] = sql(f"""
SELECT c.id, c.name, c.customer_type, c.risk_rating, c.country, c.pep_status, c.kyc_status,
       CAST(COUNT(DISTINCT al.alert_id) AS BIGINT) AS total_alerts, {R('MAX(al.score)', 1)} AS max_score,
       {R('AVG(CAST(al.score AS DECIMAL(5,2)))', 1)} AS avg_score,
       CAST(COUNT(DISTINCT t.id) AS BIGINT) AS total_transactions, {R('SUM(t.amount_usd)', 0)} AS total_volume_usd
FROM customers_m c JOIN wide_m t ON t.customer_id = c.id LEFT JOIN alerts_m al ON al.transaction_id = t.id
GROUP BY c.id, c.name, c.customer_type, c.risk_rating, c.country, c.pep_status, c.kyc_status
HAVING COUNT(DISTINCT al.alert_id) > 0
ORDER BY max_score DESC, total_alerts DESC, c.id LIMIT 20""")

H["x01_transactions_export"] = sql("""
SELECT t.id, t.account_id, t.transaction_type, CAST(t.amount AS DOUBLE) AS amount, t.currency, t.timestamp,
       t.counterparty_account, t.counterparty_name, t.counterparty_country, t.channel, t.status,
       CAST(t.amount_usd AS DOUBLE) AS amount_usd, t.is_round_amount, t.is_large_cash, t.velocity_1h, t.velocity_24h,
       t.velocity_7d, CAST(t.amount_velocity_24h AS DOUBLE) AS amount_velocity_24h, t.country_risk_score,
       t.is_new_counterparty, t.account_age_days, c.id AS customer_id, c.name AS customer_name, c.risk_rating,
       c.customer_type
FROM wide_m t JOIN customers_m c ON c.id = t.customer_id""")

H["x02_alerts_export"] = sql(ALERT_ROWS + """
SELECT alert_id, score, status, created_date, resolved_date, rule_name, category, severity, transaction_id,
       transaction_type, amount, currency, timestamp, counterparty_country, customer_id, customer_name, risk_rating,
       customer_type, pep_status, rule_score, customer_risk_score, geographic_risk_score, behavioral_score
FROM ar""")

H["x03_customer_risk_summary"] = sql(f"""
SELECT c.id, c.name, c.customer_type, c.risk_rating, c.country, c.kyc_status, c.pep_status, c.registration_date,
       cr.risk_level AS country_risk_level, CAST(COUNT(DISTINCT a.id) AS BIGINT) AS account_count,
       CAST(COUNT(DISTINCT t.id) AS BIGINT) AS transaction_count, {R('SUM(t.amount_usd)', 2)} AS total_volume_usd,
       CAST(COUNT(DISTINCT al.alert_id) AS BIGINT) AS total_alerts, {R('MAX(al.score)', 2)} AS max_alert_score,
       {R('AVG(CAST(al.score AS DECIMAL(5,2)))', 2)} AS avg_alert_score
FROM customers_m c JOIN country_risk_m cr ON cr.country_code = c.country
LEFT JOIN accounts_m a ON a.customer_id = c.id LEFT JOIN wide_m t ON t.account_id = a.id
LEFT JOIN alerts_m al ON al.transaction_id = t.id
GROUP BY c.id, c.name, c.customer_type, c.risk_rating, c.country, c.kyc_status, c.pep_status, c.registration_date,
         cr.risk_level""")

H["x04_quick_stats"] = sql(f"""
SELECT (SELECT COUNT(*) FROM customers_m) AS customers, (SELECT COUNT(*) FROM accounts_m) AS accounts,
       (SELECT COUNT(*) FROM wide_m) AS transactions, (SELECT COUNT(*) FROM alerts_m) AS alerts,
       {R('(SELECT CAST(round(SUM(amount_usd), 2) AS DOUBLE) FROM wide_m) / 1e9', 2)} AS volume_billions,
       (SELECT CAST(COUNT(*) AS BIGINT) FROM alerts_m WHERE status = 'open') AS open_alerts,
       (SELECT CAST(COUNT(*) AS BIGINT) FROM alerts_m WHERE score >= 60) AS high_score_alerts""")

_ALERTED = """
, al_m AS (
  SELECT a.*, w.customer_id, r.name AS rule_name, r.category FROM alerts_m a JOIN wide_m w ON w.id = a.transaction_id
       JOIN rules_m r ON r.id = a.rule_id)"""

H["h05_profile_summary"] = sql(_ALERTED + f"""
, per AS (SELECT customer_id, COUNT(*) AS n, COUNT(*) FILTER (WHERE score >= 60) AS high,
                 {R('SUM(CAST(score AS DECIMAL(20,2))) / CAST(COUNT(*) AS DOUBLE)', 1)} AS mean, MAX(score) AS top FROM al_m GROUP BY customer_id),
acc AS (SELECT customer_id, COUNT(*) AS n FROM accounts_m GROUP BY customer_id),
tx AS (SELECT customer_id, COUNT(*) AS n FROM wide_m GROUP BY customer_id)
SELECT c.id AS customer_id, c.name, c.customer_type, c.risk_rating, c.country, c.registration_date, c.kyc_status, c.pep_status,
       cr.country_name, cr.risk_level AS country_risk_level, coalesce(acc.n, 0) AS accounts_held,
       coalesce(per.n, 0) AS total_alerts, coalesce(per.high, 0) AS high_alerts, per.mean AS avg_score, per.top AS max_score,
       CAST(least(coalesce(acc.n, 0), 100) AS INTEGER) AS n_accounts,
       CAST(least(coalesce(tx.n, 0), 20) AS INTEGER) AS n_recent_transactions,
       CAST(least(coalesce(per.n, 0), 10) AS INTEGER) AS n_recent_alerts
FROM customers_m c JOIN country_risk_m cr ON cr.country_code = c.country LEFT JOIN per ON per.customer_id = c.id
     LEFT JOIN acc ON acc.customer_id = c.id LEFT JOIN tx ON tx.customer_id = c.id""")

H["h05_profile_accounts"] = sql("""
SELECT customer_id, CAST(row_number() OVER (PARTITION BY customer_id ORDER BY opened_date, id) AS INTEGER) AS rank, id, account_type,
       currency, opened_date, status, daily_limit
FROM accounts_m WHERE customer_id IN (SELECT id FROM customers_m) QUALIFY rank <= 100""")

H["h05_profile_transactions"] = sql("""
SELECT customer_id, CAST(row_number() OVER (PARTITION BY customer_id ORDER BY timestamp DESC, id DESC) AS INTEGER) AS rank, id,
       account_id, transaction_type, CAST(amount AS DOUBLE) AS amount, currency, timestamp, counterparty_country, channel,
       status, CAST(amount_usd AS DOUBLE) AS amount_usd, velocity_1h
FROM wide_m WHERE customer_id IN (SELECT id FROM customers_m) QUALIFY rank <= 20""")

H["h05_profile_alerts"] = sql(_ALERTED + """
SELECT customer_id, CAST(row_number() OVER (PARTITION BY customer_id ORDER BY score DESC, alert_id) AS INTEGER) AS rank,
       alert_id AS id, score, status, TIMESTAMP '2025-01-01 00:00:00' AS created_date, rule_name, category
FROM al_m QUALIFY rank <= 10""")

H["b7_transaction_pages"] = sql("""
, o AS (SELECT timestamp, id, row_number() OVER (ORDER BY timestamp DESC, id DESC) - 1 AS place, COUNT(*) OVER () AS total
        FROM transactions_m)
SELECT place // 200 + 1 AS page, timestamp AS first_timestamp, id AS first_id, least(200, total - place) AS page_rows, total,
       (total + 199) // 200 AS pages
FROM o WHERE place % 200 = 0""")

H["b7_page_by_key"] = sql("""
SELECT id, timestamp, account_id, CAST(amount AS DOUBLE) AS amount FROM transactions_m
ORDER BY timestamp DESC, id DESC LIMIT 100 OFFSET 600""")

H["s10_transactions_csv"] = H["x01_transactions_export"]
H["s11_alerts_csv"] = H["x02_alerts_export"]
H["s12_customer_risk_csv"] = H["x03_customer_risk_summary"]
