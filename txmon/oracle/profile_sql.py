"""DuckDB oracle SQL for the spot checks, the data profile and the totals."""

from __future__ import annotations

from txmon.oracle.monitor_sql import R, sql


def _check(name: str, value: str, where: str = "TRUE", detail: str = "NULL") -> str:
    return (f"SELECT '{name}' AS check_name, CAST({detail} AS VARCHAR) AS detail, CAST({value} AS DOUBLE) AS value "
            f"FROM wide_m WHERE {where}")


PF = {}
PF["e11_enrichment_checks"] = sql("\n" + "\nUNION ALL ".join([
    _check("coverage_pct", R("COUNT(*) * 100.0 / (SELECT COUNT(*) FROM transactions_m)", 1)),
    _check("large_cash", "COUNT(*)", "is_large_cash = 1"),
    _check("large_cash_not_cash", "COUNT(*)", "is_large_cash = 1 AND transaction_type NOT LIKE 'cash%'"),
    _check("round_amounts", "COUNT(*)", "is_round_amount = 1"), _check("round_amount_pct", R("AVG(is_round_amount) * 100", 1)),
    _check("structuring_deposits", "COUNT(*)", "transaction_type = 'cash_deposit' AND amount >= 9000 AND amount <= 9999"),
    _check("new_counterparties", "SUM(is_new_counterparty)"), _check("new_counterparty_pct", R("AVG(is_new_counterparty) * 100", 1)),
    _check("account_age_min", "MIN(account_age_days)"), _check("account_age_avg", R("AVG(account_age_days)", 0)),
    _check("account_age_max", "MAX(account_age_days)"),
    *[_check("velocity_avg", R(f"AVG(velocity_{w})", 2), detail=f"'{w}'") for w in ("1h", "24h", "7d")],
    *[_check("velocity_max", f"MAX(velocity_{w})", detail=f"'{w}'") for w in ("1h", "24h", "7d")],
    *[_check("country_risk", "COUNT(*)", f"country_risk_score = {k}", f"'{k}'") for k in (2, 3, 4, 5)],
    *[f"SELECT 'implied_rate_{f}', currency, {f}({R('amount_usd / amount', 4)}) FROM wide_m WHERE currency <> 'USD' GROUP BY currency"
      for f in ("min", "max")]]))
PF["e11_fast_accounts"] = sql("""
SELECT account_id, MAX(velocity_1h) AS max_velocity_1h FROM wide_m GROUP BY 1 HAVING MAX(velocity_1h) >= 2
ORDER BY max_velocity_1h DESC, account_id LIMIT 10""")
PF["e12_by_type"] = sql(f"""
SELECT transaction_type, COUNT(*) AS n, {R('AVG(amount)', 2)} AS avg_amount, CAST(MIN(amount) AS DOUBLE) AS min_amount,
       CAST(MAX(amount) AS DOUBLE) AS max_amount FROM transactions_m GROUP BY 1""")
PF["e12_by_month"] = sql(f"""
SELECT strftime(timestamp, '%Y-%m') AS month, COUNT(*) AS n, {R('SUM(amount)', 0)} AS total_volume FROM transactions_m GROUP BY 1""")
PF["e12_by_channel"] = sql(f"""
SELECT channel, COUNT(*) AS n, {R('COUNT(*) * 100.0 / SUM(COUNT(*)) OVER ()', 1)} AS pct FROM transactions_m GROUP BY 1""")
PF["e12_by_risk"] = sql("""
SELECT c.risk_rating, COUNT(DISTINCT c.id) AS customers, COUNT(t.id) AS transactions
FROM customers_m c LEFT JOIN accounts_m a ON a.customer_id = c.id LEFT JOIN transactions_m t ON t.account_id = a.id GROUP BY 1""")
PF["e12_amount_levels"] = sql(f"""
, ranked AS (SELECT amount, percent_rank() OVER (ORDER BY amount) AS p FROM transactions_m)
SELECT CAST(MIN(amount) AS DOUBLE) AS p0, {', '.join(R(f'AVG(amount) FILTER (WHERE p <= {c})', 2) + f' AS {n}' for n, c in (('p25', 0.25), ('p50', 0.5), ('p75', 0.75), ('p95', 0.95)))},
       CAST(MAX(amount) AS DOUBLE) AS p100 FROM ranked""")
PF["rule_totals"] = sql("""
SELECT COUNT(*) AS alerts, COUNT(DISTINCT a.transaction_id) AS transactions, COUNT(DISTINCT w.customer_id) AS customers
FROM alerts_m a JOIN wide_m w ON w.id = a.transaction_id""")
PF["score_bands"] = sql("""
SELECT CASE WHEN score >= 80 THEN '80-100 (Critical)' WHEN score >= 60 THEN '60-79  (High)'
            WHEN score >= 40 THEN '40-59  (Medium)' ELSE '0-39   (Low)' END AS band, COUNT(*) AS n FROM alerts_m GROUP BY 1""")
PF["row_counts"] = sql("\n" + " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, COUNT(*) AS n FROM {view}" for name, view in {
        "country_risk": "country_risk_m", "customers": "customers_m", "accounts": "accounts_m",
        "transactions": "transactions_m", "transaction_enrichment": "te", "rules": "rules_m", "alerts": "alerts_m",
        "alert_scores": "alerts_m"}.items()))
