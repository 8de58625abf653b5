"""DuckDB oracle SQL for the expectations B1-B6: one plain count for each check."""

from __future__ import annotations

from txmon.oracle.monitor_sql import sql


def _rows(table: str, source: str, checks: dict[str, str]) -> list[str]:
    """Rows that satisfy the violation."""
    return [f"SELECT '{table}: {name}' AS check_name, COUNT(*) AS violations FROM {source} WHERE {bad}"
            for name, bad in checks.items()]


def _orphans(table: str, source: str, column: str, parent: str, key: str) -> str:
    return (f"SELECT '{table}: {column} known' AS check_name, COUNT(*) AS violations FROM {source} x "
            f"LEFT JOIN {parent} p ON p.{key} = x.{column} WHERE p.{key} IS NULL AND x.{column} IS NOT NULL")


def _keys(table: str, source: str, key: str) -> str:
    return (f"SELECT '{table}: unique {key}' AS check_name, COUNT(*) AS violations FROM "
            f"(SELECT {key} FROM {source} GROUP BY {key} HAVING COUNT(*) > 1)")


def _all(parts: list[str]) -> str:
    return sql("\n" + "\nUNION ALL ".join(parts))


_FLAG = "NOT IN (0, 1)"
_UNIT = "NOT BETWEEN 0.0 AND 1.0"
_CONSTANT = "(SELECT *, CAST(risk_level >= 4 AS INTEGER) AS fatf_listed FROM country_risk_m)"

B = {}
B["b1_domain_checks"] = _all(
    _rows("country_risk", _CONSTANT, {"risk_level": "risk_level NOT BETWEEN 1 AND 5", "fatf_listed": f"fatf_listed {_FLAG}"})
    + _rows("customers", "customers_m", {
        "customer_type": "customer_type NOT IN ('individual', 'business', 'financial_institution')",
        "risk_rating": "risk_rating NOT IN (1, 2, 3)",
        "kyc_status": "kyc_status NOT IN ('verified', 'pending', 'expired', 'failed')", "pep_status": f"pep_status {_FLAG}"})
    + _rows("accounts", "accounts_m", {
        "account_type": "account_type NOT IN ('checking', 'savings', 'business', 'investment', 'crypto')",
        "currency": "length(currency) <> 3", "status": "status NOT IN ('active', 'frozen', 'closed')",
        "daily_limit": "daily_limit <= 0"})
    + _rows("transactions", "transactions_m", {
        "transaction_type": "transaction_type NOT IN ('deposit', 'withdrawal', 'transfer_in', 'transfer_out', 'wire_in', "
                            "'wire_out', 'cash_deposit', 'cash_withdrawal', 'crypto_buy', 'crypto_sell')",
        "amount": "amount <= 0", "currency": "length(currency) <> 3",
        "channel": "channel NOT IN ('online', 'mobile', 'branch', 'atm', 'wire', 'api')",
        "status": "status NOT IN ('completed', 'pending', 'failed', 'reversed')"})
    + _rows("enrichment", "te", {
        "is_round_amount": f"is_round_amount {_FLAG}", "is_large_cash": f"is_large_cash {_FLAG}",
        "country_risk_score": "country_risk_score NOT BETWEEN 1 AND 5",
        "is_new_counterparty": f"is_new_counterparty {_FLAG}"})
    + _rows("rules", "rules_m", {
        "category": "category NOT IN ('structuring', 'velocity', 'geographic', 'behavioral', 'threshold')",
        "severity": f"severity {_UNIT}", "is_active": f"is_active {_FLAG}"})
    + _rows("alerts", "alerts_m", {
        "score": "score NOT BETWEEN 0 AND 100",
        "status": "status NOT IN ('open', 'investigating', 'closed_tp', 'closed_fp', 'escalated')"})
    + _rows("alert_scores", "alerts_m", {
        **{c: f"{c} {_UNIT}" for c in ("rule_score", "customer_risk_score", "geographic_risk_score", "behavioral_score")},
        "composite_score": "score NOT BETWEEN 0 AND 100"}))

B["b2_reference_checks"] = _all([
    _orphans("accounts", "accounts_m", "customer_id", "customers_m", "id"),
    _orphans("transactions", "transactions_m", "account_id", "accounts_m", "id"),
    _orphans("transactions", "transactions_m", "counterparty_country", "country_risk_m", "country_code"),
    _orphans("alerts", "alerts_m", "transaction_id", "transactions_m", "id"),
    _orphans("alerts", "alerts_m", "rule_id", "rules_m", "id")])

B["b3_key_checks"] = _all([
    _keys("country_risk", "country_risk_m", "country_code"), _keys("customers", "customers_m", "id"),
    _keys("accounts", "accounts_m", "id"), _keys("transactions", "transactions_m", "id"),
    _keys("rules", "rules_m", "id"), _keys("rules", "rules_m", "name"), _keys("alerts", "alerts_m", "alert_id"),
    _keys("alerts", "alerts_m", "transaction_id, rule_id")])

B["b4_integrity_checks"] = _all(
    _rows("transactions", "transactions_m", {
        "currency has 3 letters": "length(currency) <> 3", "amount is positive": "amount <= 0",
        "dated in the year": "timestamp < TIMESTAMP '2024-01-01' OR timestamp > TIMESTAMP '2025-01-01'"})
    + _rows("customers", "customers_m", {
        "name present": "name IS NULL OR name = ''",
        "type valid": "customer_type NOT IN ('individual', 'business', 'financial_institution')"})
    + _rows("accounts", "accounts_m a JOIN customers_m c ON c.id = a.customer_id",
            {"opened after registration": "a.opened_date < c.registration_date"}))

B["b5_enrichment_checks"] = _all(
    ["SELECT 'enrichment: every transaction' AS check_name, (SELECT COUNT(*) FROM transactions_m) - (SELECT COUNT(*) "
     "FROM te) AS violations"]
    + _rows("enrichment", "wide_m", {
        "amount_usd is positive": "amount_usd <= 0",
        "large cash is cash": "is_large_cash = 1 AND transaction_type NOT IN ('cash_deposit', 'cash_withdrawal')",
        "large cash is large": "is_large_cash = 1 AND amount_usd < 10000",
        "dollars stay as they are": "currency = 'USD' AND abs(amount_usd - amount) > 0.01",
        "velocities are not negative": "least(velocity_1h, velocity_24h, velocity_7d) < 0",
        "velocities grow with the window": "velocity_1h > velocity_24h OR velocity_24h > velocity_7d",
        "country risk from 1 to 5": "country_risk_score NOT BETWEEN 1 AND 5",
        "account age is not negative": "account_age_days < 0"}))

B["b6_alert_checks"] = _all([
    "SELECT 'rules: every active rule fires' AS check_name, COUNT(*) AS violations FROM rules_m r WHERE is_active = 1 "
    "AND NOT EXISTS (SELECT 1 FROM alerts_m a WHERE a.rule_id = r.id)",
    "SELECT 'rules: every category has rules', 5 - COUNT(DISTINCT category) FROM rules_m WHERE category IN "
    "('structuring', 'velocity', 'geographic', 'behavioral', 'threshold')",
    *_rows("alerts", "alerts_m", {"score from 0 to 100": "score < 0 OR score > 100"}),
    "SELECT 'alerts: one breakdown each', COUNT(*) - COUNT(DISTINCT alert_id) FROM alerts_m",
    *_rows("alert_scores", "alerts_m", {
        "formula holds": "abs(30 * rule_score + 25 * customer_risk_score + 25 * geographic_risk_score "
                         "+ 20 * behavioral_score - score) >= 0.1"}),
    _keys("alerts", "alerts_m", "transaction_id, rule_id")])
