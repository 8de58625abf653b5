"""Alert scoring as column expressions (R18-R21), computed in decimal so the
two-decimal composite is exact."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

D = "decimal(6,4)"

# Customer risk rating -> normalised score; anything else -> 0.2.
CUSTOMER_RISK_NORM = {1: "0.2", 2: "0.6", 3: "1.0"}
CUSTOMER_RISK_DEFAULT = "0.2"
# Country risk level -> normalised geographic score; anything else -> 0.1.
GEO_RISK_NORM = {1: "0.1", 2: "0.35", 3: "0.6", 4: "0.85", 5: "1.0"}
GEO_RISK_DEFAULT = "0.1"
# Composite weights (rule severity, customer, geographic, behavioural).
W_RULE, W_CUST, W_GEO, W_BEH = "0.30", "0.25", "0.25", "0.20"


def _d(v: str) -> Column:
    return F.lit(v).cast(D)


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _lookup(col: Column, table: dict, default: str) -> Column:
    expr = None
    for k, v in table.items():
        expr = (F.when(col == k, _d(v)) if expr is None else expr.when(col == k, _d(v)))
    return expr.otherwise(_d(default))


def customer_risk_norm(risk_rating: Column | str) -> Column:
    return _lookup(_c(risk_rating), CUSTOMER_RISK_NORM, CUSTOMER_RISK_DEFAULT)


def geo_risk_norm(country_risk_score: Column | str) -> Column:
    return _lookup(_c(country_risk_score), GEO_RISK_NORM, GEO_RISK_DEFAULT)


def behavioral_score(v1h, v24h, usd, usd24h, is_round, is_new) -> Column:
    """One velocity chain, amount band, round/new combination, daily volume; max 1."""
    v1h, v24h, usd, usd24h = _c(v1h), _c(v24h), _c(usd), _c(usd24h)
    rnd_, new_ = _c(is_round) == 1, _c(is_new) == 1
    velocity = (F.when(v1h >= 20, _d("0.40")).when(v1h >= 10, _d("0.25")).when(v1h >= 5, _d("0.10"))
                .when(v24h >= 40, _d("0.20")).when(v24h >= 20, _d("0.10")).otherwise(_d("0")))
    amount = (F.when(usd >= 500_000, _d("0.35")).when(usd >= 100_000, _d("0.25"))
              .when(usd >= 50_000, _d("0.15")).when(usd >= 10_000, _d("0.08")).otherwise(_d("0")))
    pattern = (F.when(rnd_ & new_, _d("0.15")).when(rnd_, _d("0.07")).when(new_, _d("0.05"))
               .otherwise(_d("0")))
    volume = F.when(usd24h >= 100_000, _d("0.10")).when(usd24h >= 25_000, _d("0.05")).otherwise(_d("0"))
    return F.least(_d("1.0"), velocity + amount + pattern + volume).cast(D)


def composite(severity, cust, geo, beh) -> Column:
    """round(clamp(100 * weighted sum, 0, 100), 2)."""
    raw = (_d(W_RULE) * _c(severity).cast(D) + _d(W_CUST) * _c(cust) + _d(W_GEO) * _c(geo)
           + _d(W_BEH) * _c(beh)) * F.lit(100)
    return F.round(F.least(F.lit(100).cast("decimal(8,4)"), F.greatest(F.lit(0).cast("decimal(8,4)"), raw)),
                   2).cast("decimal(5,2)")
