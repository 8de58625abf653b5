"""The fixed values the oracle's SQL is written with.

Stated here on their own, so that a wrong rate, norm or rule condition in the library shows as a
difference; ``tests/test_oracle_constants.py`` compares the two sets by name.
"""

from __future__ import annotations

# FX rates to USD.
FX = {
    "USD": "1.0",
    "EUR": "1.09",
    "GBP": "1.27",
    "CAD": "0.74",
    "AUD": "0.66",
    "JPY": "0.0067",
    "CHF": "1.12",
    "MXN": "0.059",
    "BRL": "0.20",
    "INR": "0.012",
}
# Normalised customer rating and country level.
CUSTOMER_NORM = {1: "0.2", 2: "0.6", 3: "1.0"}
GEO_NORM = {1: "0.1", 2: "0.35", 3: "0.6", 4: "0.85", 5: "1.0"}
# Monitor rules (id, name, category, condition, severity).
RULES = [
    (1, "STR-001 Sub-threshold cash deposit", "structuring",
     "t.transaction_type = 'cash_deposit' AND te.amount_usd BETWEEN 9000 AND 9999.99", 0.80),
    (2, "STR-002 Aggregate daily sub-threshold deposits", "structuring",
     "t.transaction_type IN ('cash_deposit') AND te.amount_velocity_24h > 9000 AND te.amount_usd < 10000", 0.85),
    (3, "STR-003 Cross-account smurfing", "structuring",
     "t.transaction_type = 'cash_deposit' AND te.amount_usd BETWEEN 8500 AND 9999.99 AND te.velocity_24h >= 2", 0.90),
    (4, "STR-004 Declining cash deposit pattern", "structuring",
     "t.transaction_type = 'cash_deposit' AND te.amount_usd BETWEEN 7000 AND 9999.99 AND te.velocity_7d >= 5", 0.75),
    (5, "VEL-001 Rapid transaction burst", "velocity",
     "te.velocity_1h >= 20", 0.85),
    (6, "VEL-002 High 24h transaction count", "velocity",
     "te.velocity_24h >= 40", 0.70),
    (7, "VEL-003 Volume spike — 24h amount anomaly", "velocity",
     "te.amount_velocity_24h > 100000", 0.75),
    (8, "GEO-001 Sanctioned country transaction", "geographic",
     "te.country_risk_score = 5", 0.95),
    (9, "GEO-002 Very high risk country", "geographic",
     "te.country_risk_score = 4", 0.80),
    (10, "GEO-003 High-risk country new counterparty", "geographic",
     "te.country_risk_score >= 3 AND te.is_new_counterparty = 1", 0.70),
    (11, "BEH-001 Unusual large amount", "behavioral",
     "te.amount_usd > 50000 AND c.customer_type = 'individual'", 0.80),
    (12, "BEH-002 Dormant account sudden activity", "behavioral",
     "te.velocity_7d = 0 AND te.amount_usd > 10000", 0.75),
    (13, "BEH-003 Round-amount large wire", "behavioral",
     "t.transaction_type IN ('wire_out', 'wire_in') AND te.is_round_amount = 1 AND te.amount_usd > 25000", 0.65),
    (14, "THR-001 Large cash transaction", "threshold",
     "te.is_large_cash = 1", 0.60),
    (15, "THR-002 Large international wire", "threshold",
     "t.transaction_type IN ('wire_out', 'wire_in') AND te.amount_usd > 50000 AND t.counterparty_country IS NOT NULL", 0.65),
    (16, "BEH-004 PEP high-value transaction", "behavioral",
     "c.pep_status = 1 AND te.amount_usd > 25000", 0.85),
    (17, "GEO-004 Multi-country activity — new countries", "geographic",
     "te.is_new_counterparty = 1 AND te.country_risk_score >= 2 AND te.velocity_7d >= 5", 0.70),
    (18, "VEL-101 Scaled transaction burst", "velocity",
     "te.velocity_1h >= 2", 0.85),
    (19, "VEL-102 Scaled 24h transaction count", "velocity",
     "te.velocity_24h >= 8", 0.70),
]
# Transaction descriptions and rules (id, name, category, threshold) of the report model.
TEXTS = ["groceries", "rent", "payroll", "invoice", "supplier payment", "travel", "utilities"]
REPORT_RULES = [
    (1, "Large Cash Transaction", "structuring", 10000),
    (2, "Structuring Detection", "structuring", 9500),
    (3, "Rapid Fund Movement", "velocity", 0),
    (4, "High-Risk Country Transfer", "geographic", 0),
    (5, "Round Dollar Amounts", "behavior", 0),
    (6, "Dormant Account Activity", "behavior", 180),
    (7, "Multiple Small Deposits", "structuring", 3000),
    (8, "Cross-Border Wire", "geographic", 5000),
    (9, "Velocity Check 24h", "velocity", 10),
    (10, "New Account High Value", "behavior", 50000),
    (11, "PEP Transaction", "network", 0),
    (12, "Sanctions Country", "geographic", 0),
    (13, "Layering Pattern", "network", 0),
    (14, "Smurfing Detection", "structuring", 3000),
    (15, "Business Account Personal Use", "behavior", 0),
]
