"""Money helpers: FX conversion, round-amount test, rounding that both Spark
and the SQL oracle reproduce exactly (decimal, half away from zero)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"

# FX rates to USD (rate per unit of the currency); unknown currency -> 1.
FX_RATES = {
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
CASH_TYPES = ("cash_deposit", "cash_withdrawal")
LARGE_CASH_USD = 10_000


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def fx_rate(currency: Column | str) -> Column:
    """Rate as decimal(10,4); a literal map (bounded: one entry per currency)."""
    m = F.create_map(*[x for k, v in FX_RATES.items() for x in (F.lit(k), F.lit(v).cast("decimal(10,4)"))])
    return F.coalesce(F.element_at(m, _c(currency)), F.lit("1").cast("decimal(10,4)"))


def to_usd(amount: Column | str, currency: Column | str) -> Column:
    """round(amount * rate, 2) in decimal."""
    return F.round(_c(amount).cast(MONEY) * fx_rate(currency), 2).cast(MONEY)


def is_round_usd(usd: Column | str) -> Column:
    """E02 on the USD value: >=1000 & %1000, >=500 & %100, >=5000 & %50."""
    u = _c(usd)
    return (((u >= 1000) & (u % 1000 == 0)) | ((u >= 500) & (u % 100 == 0))
            | ((u >= 5000) & (u % 50 == 0)))


def rnd(x: Column | str, n: int = 0) -> Column:
    """ROUND(x, n) half away from zero on the decimal text, as double.

    Goes through decimal(38,10) so that a double like 1.005 rounds to 1.01 the
    same way in Spark and in the oracle.
    """
    return F.round(_c(x).cast("decimal(38,10)"), n).cast("double")


def safe_div(num: Column, den: Column) -> Column:
    """x / NULLIF(y, 0) — NULL on zero, never an ANSI error."""
    return F.try_divide(num.cast("double"), F.nullif(den, F.lit(0)).cast("double"))
