"""DuckDB SQL for the stored tables after all batches: what one run over everything gives."""

from __future__ import annotations

from txmon.oracle.monitor_queries_sql import RULE_PERFORMANCE, Q
from txmon.oracle.monitor_sql import sql

S: dict[str, str] = {
    "s05_stored_enrichment": Q["transaction_enrichment"],
    "s06_stored_alerts": Q["alerts"],
    "s08_stored_rule_performance": sql(RULE_PERFORMANCE + """
SELECT * FROM rule_perf
UNION ALL
SELECT * REPLACE (DATE '2024-06-30' AS evaluation_date) FROM rule_perf"""),
    "s09_audit_truth": sql("""
SELECT ['structuring', 'rapid_velocity', 'round_trip', 'geo_risk', 'layering', 'dormant_activation', 'unusual_amounts',
        'cross_acct_smurf'][(id // 20) % 8 + 1] AS pattern, id AS customer_id
FROM customers_m WHERE id % 20 = 0"""),
    "n1_streaming_velocity": sql("""
SELECT t.id, t.account_id, te.velocity_1h, te.velocity_24h, te.velocity_7d,
       CAST(te.amount_velocity_24h AS DOUBLE) AS amount_velocity_24h
FROM transactions_m t JOIN te ON te.transaction_id = t.id"""),
    # components over the counterparties, of which there are few, then the least account of each
    "n5_counterparty_components": sql("""
, edges AS (SELECT DISTINCT account_id, counterparty_account AS cp FROM wide_m WHERE counterparty_account <> ''),
near AS (SELECT DISTINCT a.cp AS x, b.cp AS y FROM edges a JOIN edges b ON a.account_id = b.account_id),
reach(x, y) AS (SELECT x, y FROM near UNION SELECT r.x, n.y FROM reach r JOIN near n ON n.x = r.y),
least_of AS (SELECT r.x AS cp, min(e.account_id) AS least_id FROM reach r JOIN edges e ON e.cp = r.y GROUP BY r.x)
SELECT e.account_id, min(l.least_id) AS component_id FROM edges e JOIN least_of l ON l.cp = e.cp GROUP BY e.account_id""").replace(
        "WITH ", "WITH RECURSIVE ", 1),
    "x05_full_run": sql("""
, pairs AS (SELECT DISTINCT account_id, counterparty_account FROM transactions_m WHERE counterparty_account <> '')
SELECT 'rules' AS table_name, COUNT(*) AS stored_rows FROM rules_m
UNION ALL SELECT 'transactions', COUNT(*) FROM transactions_m
UNION ALL SELECT 'first_seen', COUNT(*) FROM pairs
UNION ALL SELECT 'transaction_enrichment', COUNT(*) FROM te
UNION ALL SELECT 'alerts', COUNT(*) FROM alerts_m
UNION ALL SELECT 'rule_performance', 2 * COUNT(DISTINCT rule_id) FROM alerts_m"""),
}
