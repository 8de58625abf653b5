"""DuckDB oracle SQL for timeliness, statistical checks and the overall score."""

from __future__ import annotations

from txmon.oracle.monitor_sql import R, sql
from txmon.oracle.quality_sql import COMPLETENESS, CONSISTENCY
from txmon.oracle.report_sql import REPORT_CTES

NOW, SINCE = "TIMESTAMP '2024-01-31'", "TIMESTAMP '2024-01-01'"
AGE = f"((epoch_us({NOW}) - epoch_us(created_at)) / 86400e6)"


def _lag(later: str, earlier: str) -> str:
    return f"(CAST(SUM(epoch_us({later}) - epoch_us({earlier})) AS DOUBLE) / COUNT(*) / 3600e6)"


def _grade(v: str, good: str, warn: str) -> str:
    return f"CASE WHEN {v} {good} THEN 'good' WHEN {v} {warn} THEN 'warning' ELSE 'critical' END"


def _points(status: str) -> str:
    return f"CASE {status} WHEN 'good' THEN 100.0 WHEN 'warning' THEN 60.0 ELSE 0.0 END"


TIMELY = f"""
, measured AS (
  SELECT 'freshness_days' AS measure, CAST(floor((epoch_us({NOW}) - epoch_us(MAX(transaction_date))) / 86400e6) AS DOUBLE) AS value
  FROM r_transactions
  UNION ALL SELECT 'etl_lag_hours', {R(_lag('processing_date', 'transaction_date'), 2)}
  FROM r_transactions WHERE processing_date >= transaction_date
  UNION ALL SELECT 'alert_lag_hours', {R(_lag('a.created_at', 't.transaction_date'), 2)}
  FROM r_alerts a JOIN r_transactions t ON t.transaction_id = a.transaction_id
  UNION ALL SELECT 'stale_new_alerts', CAST(COUNT(*) AS DOUBLE) FROM r_alerts WHERE status = 'new' AND {AGE} > 30
  UNION ALL SELECT 'overdue_reviews', CAST(COUNT(*) AS DOUBLE) FROM r_alerts WHERE status = 'under_review' AND {AGE} > 14),
timely AS (
  SELECT measure, value, CASE measure
    WHEN 'freshness_days' THEN {_grade('value', '<= 2', '<= 7')} WHEN 'etl_lag_hours' THEN {_grade('value', '< 24', '< 48')}
    WHEN 'alert_lag_hours' THEN {_grade('value', '< 48', '< 96')} WHEN 'stale_new_alerts' THEN {_grade('value', '= 0', '<= 20')}
    ELSE {_grade('value', '= 0', '<= 10')} END AS status FROM measured)"""
TIMELY_SCORE = f"(SELECT {R('AVG(' + _points('status') + ')', 1)} FROM timely)"

BANDS = f"""
, weekly AS (SELECT strftime(transaction_date, '%Y-W%W') AS week, COUNT(*) AS n FROM r_transactions GROUP BY 1),
spread AS (SELECT COUNT(*) AS k, AVG(n) AS m, stddev_pop(n) AS sd FROM weekly),
bands AS (SELECT k, m, sd, CASE WHEN k > 2 THEN {R('greatest(m - 2 * sd, 0)', 1)} ELSE m END AS low,
                 CASE WHEN k > 2 THEN {R('m + 2 * sd', 1)} ELSE m END AS high FROM spread),
volume AS (SELECT week, n AS transactions, {R('m', 1)} AS mean, CASE WHEN k > 2 THEN {R('sd', 1)} ELSE 0.0 END AS deviation,
                  low AS lower_band, high AS upper_band, k > 2 AND n NOT BETWEEN low AND high AS stands_out
           FROM weekly, bands)"""

SHIFT = f"""
, means AS (SELECT coalesce({R(f"(SELECT AVG(amount) FROM r_transactions WHERE transaction_date >= {SINCE})", 2)}, 0.0) AS recent_avg,
                   coalesce({R(f"(SELECT AVG(amount) FROM r_transactions WHERE transaction_date < {SINCE})", 2)}, 0.0) AS earlier_avg),
shift0 AS (SELECT *, CASE WHEN earlier_avg > 0 THEN {R('(recent_avg - earlier_avg) * 100.0 / earlier_avg', 1)} ELSE 0.0 END
             AS change_pct FROM means),
shift AS (SELECT *, {_grade('abs(change_pct)', '< 15', '< 30')} AS status FROM shift0)"""

COUNTRIES = f"""
, fresh AS (
  SELECT t.counterparty_country AS country, strftime(MIN(t.transaction_date), '%Y-%m-%d') AS first_seen,
         COUNT(*) AS transactions, {R('SUM(t.amount)', 2)} AS total_amount, coalesce(ANY_VALUE(c.risk_level), 'Unknown') AS risk
  FROM r_transactions t LEFT JOIN r_country c ON c.country_code = t.counterparty_country
  WHERE t.transaction_date >= {SINCE} AND t.counterparty_country IS NOT NULL AND t.counterparty_country NOT IN (
    SELECT DISTINCT counterparty_country FROM r_transactions
    WHERE transaction_date < {SINCE} AND counterparty_country IS NOT NULL)
  GROUP BY t.counterparty_country)"""

SPIKE = f"""
, hv AS (SELECT strftime(transaction_date, '%Y-W%W') AS week, COUNT(*) AS n FROM r_transactions WHERE amount > 100000 GROUP BY 1),
sides AS (SELECT (SELECT COUNT(*) FROM hv) AS weeks, (SELECT AVG(n) FROM (SELECT n FROM hv ORDER BY week DESC LIMIT 4)) AS a,
                 coalesce((SELECT AVG(n) FROM (SELECT n FROM hv ORDER BY week DESC OFFSET 4)), 0.0) AS b,
                 coalesce((SELECT AVG(n) FROM hv), 0.0) AS whole),
chosen AS (SELECT weeks, CASE WHEN weeks >= 4 THEN a ELSE whole END AS x, CASE WHEN weeks >= 4 THEN b ELSE whole END AS y FROM sides),
spike0 AS (SELECT weeks, {R('x', 2)} AS last_mean, {R('y', 2)} AS earlier_mean,
                  {R('(x - y) * 100.0 / greatest(y, 1.0)', 1)} AS change_pct FROM chosen),
spike AS (SELECT *, {_grade('abs(change_pct)', '< 20', '< 50')} AS status FROM spike0)"""

RATES = f"""
, joined AS (SELECT strftime(t.transaction_date, '%Y-W%W') AS week, COUNT(DISTINCT t.transaction_id) AS transactions,
                    COUNT(DISTINCT a.alert_id) AS alerts
             FROM r_transactions t LEFT JOIN r_alerts a ON a.transaction_id = t.transaction_id GROUP BY 1),
rated AS (SELECT *, {R('alerts * 100.0 / transactions', 2)} AS rate_pct FROM joined),
rates AS (SELECT *, (SELECT COUNT(*) FROM rated) > 2 AND abs(rate_pct - (SELECT AVG(rate_pct) FROM rated))
                    > 2 * (SELECT stddev_pop(rate_pct) FROM rated) AS stands_out FROM rated)"""


def _few(n: str, warn: int) -> str:
    return f"CASE WHEN {n} = 0 THEN 100.0 WHEN {n} <= {warn} THEN 60.0 ELSE 0.0 END"


STAT = BANDS + SHIFT + COUNTRIES + SPIKE + RATES + f"""
, points AS (SELECT {_few('(SELECT COUNT(*) FROM volume WHERE stands_out)', 2)} AS volume_points,
                    (SELECT {_points('status')} FROM shift) AS amount_points,
                    {_few('(SELECT COUNT(*) FROM fresh)', 3)} AS country_points,
                    (SELECT {_points('status')} FROM spike) AS high_value_points,
                    {_few('(SELECT COUNT(*) FROM rates WHERE stands_out)', 2)} AS rate_points),
stat AS (SELECT {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in ('volume_points', 'amount_points', 'country_points', 'high_value_points', 'rate_points'))},
                {R('(volume_points + amount_points + country_points + high_value_points + rate_points) / 5.0', 1)} AS score FROM points)"""

T = {}
T["d05_timeliness"] = sql(REPORT_CTES + TIMELY + "\nSELECT * FROM timely")
T["d07_weekly_lag"] = sql(REPORT_CTES + f"""
SELECT strftime(transaction_date, '%Y-W%W') AS week, {R(_lag('processing_date', 'transaction_date'), 2)} AS avg_lag_hours
FROM r_transactions WHERE processing_date >= transaction_date GROUP BY 1 ORDER BY 1 LIMIT 52""")
T["d07_open_alert_ages"] = sql(REPORT_CTES + f"""
, aged AS (SELECT {AGE} AS age FROM r_alerts WHERE status IN ('new', 'under_review')),
b(position, bucket, lo, hi) AS (VALUES (1, '1-7 days', -1e18, 7), (2, '7-14 days', 7, 14), (3, '14-30 days', 14, 30),
                                       (4, '30+ days', 30, 1e18))
SELECT position, bucket, COUNT(age) AS alerts FROM b LEFT JOIN aged ON age > lo AND age <= hi GROUP BY position, bucket""")
T["d08_timeliness_score"] = sql(REPORT_CTES + TIMELY + f"\nSELECT {TIMELY_SCORE} AS score")
T["d09_volume_bands"] = sql(REPORT_CTES + BANDS + "\nSELECT * FROM volume")
T["d10_amount_shift"] = sql(REPORT_CTES + SHIFT + "\nSELECT * FROM shift")
T["d11_new_countries"] = sql(REPORT_CTES + COUNTRIES + "\nSELECT * FROM fresh")
T["d12_high_value_spike"] = sql(REPORT_CTES + SPIKE + "\nSELECT * FROM spike")
T["d13_alert_rates"] = sql(REPORT_CTES + RATES + "\nSELECT * FROM rates")
T["d14_statistical_score"] = sql(REPORT_CTES + STAT + "\nSELECT * FROM stat")
T["d15_overall_score"] = sql(COMPLETENESS + CONSISTENCY.removeprefix(REPORT_CTES) + TIMELY + STAT + f"""
, s AS (SELECT {R('(SELECT AVG(greatest(0.0, 100 - null_pct)) FROM comp)', 1)} AS completeness,
               {R("(SELECT AVG(CASE status WHEN 'good' THEN 100.0 WHEN 'warning' THEN 60.0 ELSE 0.0 END) FROM cons2)", 1)} AS consistency,
               {TIMELY_SCORE} AS timeliness, (SELECT score FROM stat) AS statistical),
marks AS (SELECT status FROM comp UNION ALL SELECT status FROM cons2 UNION ALL SELECT status FROM timely)
SELECT {R('completeness * 0.3 + consistency * 0.3 + timeliness * 0.2 + statistical * 0.2', 1)} AS overall, s.*,
       {', '.join(_grade(c, '>= 80', '>= 60') + f' AS {c}_status' for c in ('completeness', 'consistency', 'timeliness', 'statistical'))},
       (SELECT COUNT(*) FROM marks WHERE status = 'warning') AS warnings,
       (SELECT COUNT(*) FROM marks WHERE status = 'critical') AS criticals
FROM s""")
