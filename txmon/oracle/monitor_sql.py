"""DuckDB SQL for the monitor model: the same mapping, enrichment and rule
engine written as plain SQL over the input tables (an independent check of
the Spark plans; never used by them)."""

from __future__ import annotations

from txmon.oracle.constants import CUSTOMER_NORM, FX, GEO_NORM, RULES


def R(x: str, n: int = 0) -> str:
    """ROUND half away from zero through decimal, as DOUBLE (mirrors money.rnd)."""
    return f"CAST(round(CAST({x} AS DECIMAL(38,10)), {n}) AS DOUBLE)"


def DIV(num: str, den: str) -> str:
    return f"(CAST({num} AS DOUBLE) / CAST(NULLIF({den}, 0) AS DOUBLE))"


def _cc(k: str) -> str:
    return f"('N' || lpad(CAST({k} AS VARCHAR), CAST(greatest(2, length(CAST({k} AS VARCHAR))) AS INTEGER), '0'))"


def _fx(cur: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN CAST({v} AS DECIMAL(10,4))" for k, v in FX.items())
    return f"(CASE {cur} {whens} ELSE CAST(1 AS DECIMAL(10,4)) END)"


def _map(col: str, table: dict, default: str) -> str:
    whens = " ".join(f"WHEN {k} THEN CAST({v} AS DECIMAL(6,4))" for k, v in table.items())
    return f"(CASE {col} {whens} ELSE CAST({default} AS DECIMAL(6,4)) END)"


def _currency(src: str) -> str:
    return f"(CASE {src} % 5 WHEN 0 THEN 'EUR' WHEN 1 THEN 'GBP' WHEN 2 THEN 'JPY' ELSE 'USD' END)"


_ACCOUNT_COLS = """
    id, customer_id,
    CASE id % 5 WHEN 0 THEN 'checking' WHEN 1 THEN 'savings' WHEN 2 THEN 'business'
                WHEN 3 THEN 'investment' ELSE 'crypto' END AS account_type,
    {currency} AS currency,
    opened_date,
    CASE WHEN id % 20 = 0 THEN 'frozen' WHEN id % 20 = 1 THEN 'closed' ELSE 'active' END AS status,
    CAST(5000.0 * (id % 5 + 1) AS DOUBLE) AS daily_limit,
    CAST(opened_date AS TIMESTAMP) AS created_at
"""


def _rule_branch(r) -> str:
    rid, _name, _cat, cond, sev = r
    return f"""
    SELECT t.id AS transaction_id, t.account_id, CAST({rid} AS BIGINT) AS rule_id,
           CAST({sev} AS DECIMAL(3,2)) AS rule_score, c.risk_rating, te.country_risk_score,
           te.velocity_1h, te.velocity_24h, te.amount_usd, te.amount_velocity_24h,
           te.is_round_amount, te.is_new_counterparty
    FROM transactions_m t JOIN te ON te.transaction_id = t.id
         JOIN accounts_m a ON a.id = t.account_id JOIN customers_m c ON c.id = a.customer_id
    WHERE ({cond}) AND t.status = 'completed'"""


def _rules_values() -> str:
    rows = []
    for rid, name, cat, cond, sev in RULES:
        q = lambda s: "'" + s.replace("'", "''") + "'"
        rows.append(f"({rid}, {q(name)}, {q(f"{cat} rule: {cond}")}, {q(cat)}, {q(cond)}, {sev}, 1)")
    return ",\n    ".join(rows)


def _prelude() -> str:
    beh = """LEAST(CAST(1.0 AS DECIMAL(6,4)),
        (CASE WHEN velocity_1h >= 20 THEN 0.40 WHEN velocity_1h >= 10 THEN 0.25 WHEN velocity_1h >= 5 THEN 0.10
              WHEN velocity_24h >= 40 THEN 0.20 WHEN velocity_24h >= 20 THEN 0.10 ELSE 0 END)
      + (CASE WHEN amount_usd >= 500000 THEN 0.35 WHEN amount_usd >= 100000 THEN 0.25
              WHEN amount_usd >= 50000 THEN 0.15 WHEN amount_usd >= 10000 THEN 0.08 ELSE 0 END)
      + (CASE WHEN is_round_amount = 1 AND is_new_counterparty = 1 THEN 0.15 WHEN is_round_amount = 1 THEN 0.07
              WHEN is_new_counterparty = 1 THEN 0.05 ELSE 0 END)
      + (CASE WHEN amount_velocity_24h >= 100000 THEN 0.10 WHEN amount_velocity_24h >= 25000 THEN 0.05 ELSE 0 END))"""
    return f"""
country_risk_m AS (
  SELECT {_cc('n_nationkey')} AS country_code, n_name AS country_name,
         CAST(CASE WHEN n_nationkey < 12 THEN 1 WHEN n_nationkey < 18 THEN 2 WHEN n_nationkey < 22 THEN 3
                   WHEN n_nationkey < 24 THEN 4 ELSE 5 END AS INTEGER) AS risk_level
  FROM nation),
customers_m AS (
  SELECT c_custkey AS id, c_name AS name,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'business' WHEN 'MACHINERY' THEN 'financial_institution'
              ELSE 'individual' END AS customer_type,
         CAST(1 + c_custkey % 3 AS INTEGER) AS risk_rating,
         {_cc('c_nationkey')} AS country,
         CAST(DATE '1985-01-01' + CAST(c_custkey % 3650 AS INTEGER) AS DATE) AS registration_date,
         CASE WHEN c_custkey % 10 < 8 THEN 'verified' WHEN c_custkey % 20 = 8 THEN 'pending'
              WHEN c_custkey % 20 = 9 THEN 'expired' ELSE 'failed' END AS kyc_status,
         CAST(c_custkey % 25 = 0 AS INTEGER) AS pep_status
  FROM customer),
accounts_m AS (
  SELECT {_ACCOUNT_COLS.format(currency=_currency('src'))} FROM (
    SELECT 2 * user_id - user_id % 1000000 AS id, user_id // 2 AS customer_id, user_id AS src,
           CAST(DATE '2023-11-01' + CAST(user_id % 60 AS INTEGER) AS DATE) AS opened_date
    FROM (SELECT DISTINCT user_id FROM events)
    UNION ALL
    SELECT 2 * c_custkey - c_custkey % 1000000 + 1000000, c_custkey, c_custkey,
           CAST(DATE '1994-10-01' + CAST((2 * c_custkey - c_custkey % 1000000 + 1000000) % 400 AS INTEGER) AS DATE)
    FROM customer)),
tx_raw AS (
  SELECT 2 * event_id - event_id % 1000000000 AS id, 2 * user_id - user_id % 1000000 AS account_id,
         CASE event_type WHEN 'purchase' THEN 'wire_out' WHEN 'view' THEN 'wire_in' WHEN 'signup' THEN 'cash_deposit'
              WHEN 'click' THEN 'transfer_out' WHEN 'error' THEN 'withdrawal' END AS transaction_type,
         CAST(CAST(value AS DECIMAL(18,2)) * 200 AS DECIMAL(18,2)) AS amount,
         {_currency('user_id')} AS currency,
         date_trunc('second', ts) AS timestamp,
         CAST(json_extract(props, '$.k') AS INTEGER) AS k,
         CASE WHEN event_id % 50 = 0 THEN 'pending' WHEN event_id % 50 = 1 THEN 'failed'
              WHEN event_id % 50 = 2 THEN 'reversed' ELSE 'completed' END AS status
  FROM events
  UNION ALL
  SELECT 2 * o_orderkey - o_orderkey % 1000000000 + 1000000000, 2 * o_custkey - o_custkey % 1000000 + 1000000,
         CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'wire_out' WHEN '2' THEN 'wire_in' WHEN '3' THEN 'deposit'
              WHEN '4' THEN 'cash_deposit' WHEN '5' THEN 'cash_withdrawal' END,
         CAST(CASE WHEN o_orderkey % 20 = 0 THEN floor(o_totalprice / 1000) * 1000 + 1000
                   ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS DECIMAL(18,2)),
         {_currency('o_custkey')},
         o_orderdate,
         CAST(o_orderkey % 100 AS INTEGER),
         CASE WHEN o_orderstatus = 'P' THEN 'pending' ELSE 'completed' END
  FROM orders),
transactions_m AS (
  SELECT id, account_id, transaction_type, amount, currency, timestamp,
         CASE WHEN transaction_type IN ('wire_out','wire_in','transfer_out')
              THEN 'CP-' || lpad(CAST(k AS VARCHAR), CAST(greatest(3, length(CAST(k AS VARCHAR))) AS INTEGER), '0') END AS counterparty_account,
         CASE WHEN transaction_type IN ('wire_out','wire_in','transfer_out')
              THEN 'Party ' || CAST(k AS VARCHAR) END AS counterparty_name,
         CASE WHEN transaction_type IN ('wire_out','wire_in','transfer_out') THEN {_cc('k % 25')} END
              AS counterparty_country,
         CASE WHEN transaction_type IN ('cash_deposit','cash_withdrawal')
                   THEN CASE WHEN id % 2 = 0 THEN 'branch' ELSE 'atm' END
              WHEN transaction_type IN ('wire_out','wire_in') THEN 'wire'
              WHEN id % 3 = 0 THEN 'online' WHEN id % 3 = 1 THEN 'mobile' ELSE 'api' END AS channel,
         status, timestamp AS created_at,
         epoch_us(timestamp) AS us
  FROM tx_raw),
te_base AS (
  SELECT t.*, CAST(round(t.amount * {_fx('t.currency')}, 2) AS DECIMAL(18,2)) AS usd
  FROM transactions_m t),
te AS (
  SELECT t.id AS transaction_id, t.usd AS amount_usd,
         CAST(((t.usd >= 1000 AND t.usd % 1000 = 0) OR (t.usd >= 500 AND t.usd % 100 = 0)
               OR (t.usd >= 5000 AND t.usd % 50 = 0)) AS INTEGER) AS is_round_amount,
         CAST((t.transaction_type IN ('cash_deposit','cash_withdrawal') AND t.usd >= 10000) AS INTEGER)
           AS is_large_cash,
         CAST(COUNT(*) OVER (PARTITION BY t.account_id ORDER BY t.us
              RANGE BETWEEN 3600000000 PRECEDING AND 1 PRECEDING) AS BIGINT) AS velocity_1h,
         CAST(COUNT(*) OVER (PARTITION BY t.account_id ORDER BY t.us
              RANGE BETWEEN 86400000000 PRECEDING AND 1 PRECEDING) AS BIGINT) AS velocity_24h,
         CAST(COUNT(*) OVER (PARTITION BY t.account_id ORDER BY t.us
              RANGE BETWEEN 604800000000 PRECEDING AND 1 PRECEDING) AS BIGINT) AS velocity_7d,
         CAST(round(coalesce(SUM(t.usd) OVER (PARTITION BY t.account_id ORDER BY t.us
              RANGE BETWEEN 86400000000 PRECEDING AND 1 PRECEDING), 0), 2) AS DECIMAL(18,2)) AS amount_velocity_24h,
         CAST(coalesce(cr.risk_level, 1) AS INTEGER) AS country_risk_score,
         CASE WHEN t.counterparty_account IS NULL OR t.counterparty_account = '' THEN 0
              WHEN row_number() OVER (PARTITION BY t.account_id, t.counterparty_account ORDER BY t.us, t.id) = 1
              THEN 1 ELSE 0 END AS is_new_counterparty,
         CAST(greatest(0, date_diff('day', a.opened_date, CAST(t.timestamp AS DATE))) AS INTEGER) AS account_age_days
  FROM te_base t JOIN accounts_m a ON a.id = t.account_id
       LEFT JOIN country_risk_m cr ON cr.country_code = t.counterparty_country),
rules_m AS (
  SELECT * FROM (VALUES
    {_rules_values()}
  ) r(id, name, description, category, sql_condition, severity, is_active)),
fired_m AS ({' UNION ALL '.join(_rule_branch(r) for r in RULES)}),
scored_m AS (
  SELECT f.*,
         {_map('risk_rating', CUSTOMER_NORM, '0.2')} AS customer_risk_score,
         {_map('country_risk_score', GEO_NORM, '0.1')} AS geographic_risk_score,
         CAST({beh} AS DECIMAL(6,4)) AS behavioral_score
  FROM fired_m f),
alerts_m AS (
  SELECT transaction_id * 100 + rule_id AS alert_id, transaction_id, rule_id,
         CAST(round(LEAST(CAST(100 AS DECIMAL(8,4)), GREATEST(CAST(0 AS DECIMAL(8,4)),
              (0.30 * rule_score + 0.25 * customer_risk_score + 0.25 * geographic_risk_score
               + 0.20 * behavioral_score) * 100)), 2) AS DOUBLE) AS score,
         'open' AS status,
         CAST(rule_score AS DOUBLE) AS rule_score,
         CAST(customer_risk_score AS DOUBLE) AS customer_risk_score,
         CAST(geographic_risk_score AS DOUBLE) AS geographic_risk_score,
         CAST(behavioral_score AS DOUBLE) AS behavioral_score
  FROM scored_m),
wide_m AS (
  SELECT t.*, te.* EXCLUDE (transaction_id), a.customer_id
  FROM transactions_m t JOIN te ON te.transaction_id = t.id JOIN accounts_m a ON a.id = t.account_id)"""


PRELUDE = _prelude()


def sql(body: str) -> str:
    """``body`` is either ``SELECT ...`` or ``, extra AS (...) SELECT ...``."""
    body = body.strip()
    sep = "\n" if body.startswith(",") else "\n"
    return f"WITH {PRELUDE}{sep}{body}"
