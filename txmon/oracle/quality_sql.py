"""DuckDB oracle SQL for the data-quality operators."""

from __future__ import annotations

from txmon.oracle.monitor_sql import R, sql
from txmon.oracle.report_sql import REPORT_CTES


def _null(table: str, col: str, good: float = 5.0, warn: float = 15.0) -> str:
    pct = f"(CASE WHEN COUNT(*) > 0 THEN SUM(CASE WHEN {col} IS NULL OR CAST({col} AS VARCHAR) = '' THEN 1 ELSE 0 END) * 100.0 / COUNT(*) ELSE 0.0 END)"
    return (f"SELECT '{table.replace('r_', '')}' AS table_name, '{col}' AS field, CAST(COUNT(*) AS BIGINT) AS total, "
            f"CAST(SUM(CASE WHEN {col} IS NULL OR CAST({col} AS VARCHAR) = '' THEN 1 ELSE 0 END) AS BIGINT) AS null_count, "
            f"{R(pct, 2)} AS null_pct, CASE WHEN {pct} < {good} THEN 'good' WHEN {pct} < {warn} THEN 'warning' "
            f"ELSE 'critical' END AS status FROM {table}")


_CLOSED_PCT = ("(CASE WHEN COUNT(*) > 0 THEN SUM(CASE WHEN closed_at IS NOT NULL THEN 1 ELSE 0 END) * 100.0 / COUNT(*) "
               "ELSE 0.0 END)")

COMPLETENESS = REPORT_CTES + "\n, comp AS (" + " UNION ALL ".join(
    [_null("r_transactions", c) for c in
     ["counterparty_name", "counterparty_country", "description", "channel", "currency"]]
    + [_null("r_customers", c) for c in ["nationality", "date_of_birth", "email"]]
    + [_null("r_alerts", c) for c in ["assigned_to", "notes"]]
    + [f"SELECT 'accounts', 'closed_at (active accts w/ close date)', CAST(COUNT(*) AS BIGINT), "
       f"CAST(SUM(CASE WHEN closed_at IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT), {R(_CLOSED_PCT, 2)}, "
       f"CASE WHEN {_CLOSED_PCT} < 1 THEN 'good' WHEN {_CLOSED_PCT} < 5 THEN 'warning' ELSE 'critical' END "
       f"FROM r_accounts WHERE status = 'active'"]) + ")"

DQ = {}
DQ["dq_completeness"] = sql(COMPLETENESS + "\nSELECT * FROM comp")
DQ["dq_completeness_score"] = sql(COMPLETENESS + f"""
SELECT {R('(SELECT AVG(greatest(0.0, 100 - null_pct)) FROM comp)', 1)} AS score,
       CAST(SUM(CASE WHEN counterparty_country IS NULL OR counterparty_name IS NULL OR counterparty_name = ''
                     THEN 1 ELSE 0 END) AS BIGINT) AS unenriched_count,
       {R("SUM(CASE WHEN counterparty_country IS NULL OR counterparty_name IS NULL OR counterparty_name = '' THEN 1 ELSE 0 END) * 100.0 / COUNT(*)", 2)}
         AS unenriched_pct
FROM r_transactions""")

CONSISTENCY = REPORT_CTES + """
, cons AS (
  SELECT 'Zero / Negative-Amount Transactions' AS label, (SELECT COUNT(*) FROM r_transactions WHERE amount < 0.01) AS cnt, 10 AS crit
  UNION ALL SELECT 'Future-Dated Transactions',
         (SELECT COUNT(*) FROM r_transactions WHERE transaction_date > TIMESTAMP '2024-01-31 23:59:59'), 5
  UNION ALL SELECT 'Transactions on Closed Accounts',
         (SELECT COUNT(*) FROM r_transactions t JOIN r_accounts a ON t.account_id = a.account_id
          WHERE a.closed_at IS NOT NULL AND t.transaction_date > a.closed_at), 10
  UNION ALL SELECT 'Failed Transactions (No Reversal)', (SELECT COUNT(*) FROM r_transactions WHERE status = 'failed'), 100
  UNION ALL SELECT 'Duplicate Transaction IDs',
         (SELECT COUNT(*) FROM (SELECT transaction_id FROM r_transactions GROUP BY 1 HAVING COUNT(*) > 1)), -1
  UNION ALL SELECT 'Large Non-USD Transactions (>$1M)',
         (SELECT COUNT(*) FROM r_transactions WHERE amount > 1000000 AND currency <> 'USD'), 5
  UNION ALL SELECT 'Processing Before Transaction Date',
         (SELECT COUNT(*) FROM r_transactions WHERE processing_date < transaction_date), 10),
cons2 AS (
  SELECT label, CAST(cnt AS BIGINT) AS count,
         CASE WHEN cnt = 0 THEN 'good' WHEN crit < 0 THEN 'critical' WHEN cnt <= crit THEN 'warning'
              ELSE 'critical' END AS status FROM cons)"""

DQ["dq_consistency"] = sql(CONSISTENCY + "\nSELECT * FROM cons2")
DQ["dq_consistency_score"] = sql(CONSISTENCY + f"""
SELECT {R("AVG(CASE status WHEN 'good' THEN 100.0 WHEN 'warning' THEN 60.0 ELSE 0.0 END)", 1)} AS score FROM cons2""")

DQ["dq_missing_months"] = sql(REPORT_CTES + """
, bounds AS (SELECT date_trunc('month', MIN(transaction_date)) AS lo FROM r_transactions),
months AS (SELECT strftime(m, '%Y-%m') AS month
           FROM bounds, range(bounds.lo, TIMESTAMP '2024-01-01 00:00:00' + INTERVAL 1 DAY, INTERVAL 1 MONTH) t(m))
SELECT month FROM months WHERE month NOT IN (SELECT DISTINCT strftime(transaction_date, '%Y-%m') FROM r_transactions)""")
