"""Timeliness, statistical checks and the overall score.

Weekly tables hold one row a week, so the windows and one-row joins over
them stay small whatever the number of transactions.  "Now" is the model's
``as_of`` date at midnight.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txmon.functions.money import rnd
from txmon.functions.timefn import US_PER_HOUR, floor_days, julian_days, micros, monday_week_key, ts_lit
from txmon.operators import quality as DQ
from txmon.sources.report import Report

OPEN = ("new", "under_review")
POINTS = {"good": 100.0, "warning": 60.0, "critical": 0.0}
RECENT_DAYS = 30
HIGH_VALUE = 100_000


def _run_date(r: Report) -> Column:
    return ts_lit(f"{r.as_of} 00:00:00")


def _age_days(r: Report) -> Column:
    return julian_days(_run_date(r), "created_at")


def _mean_hours(later: Column, earlier: Column) -> Column:
    """Mean of the difference in hours, from an exact sum of microseconds."""
    us = (later - earlier).cast("decimal(20,0)")
    return F.sum(us).cast("double") / F.count(us) / F.lit(float(US_PER_HOUR))


def _points(status: Column) -> Column:
    return F.when(status == "good", POINTS["good"]).when(status == "warning", POINTS["warning"]).otherwise(POINTS["critical"])


def _counted(n: Column, warn: int) -> Column:
    return F.when(n == 0, "good").when(n <= warn, "warning").otherwise("critical")


def _recent_from(r: Report) -> Column:
    return F.timestamp_add("DAY", F.lit(-RECENT_DAYS), _run_date(r))


def processing_lag(r: Report) -> DataFrame:
    """Transactions whose processing does not precede them."""
    return r.transactions.where("processing_date IS NOT NULL AND transaction_date IS NOT NULL AND "
                                "processing_date >= transaction_date")


def timeliness(r: Report) -> DataFrame:
    """Measure, value and status of freshness, both lags, stale and overdue alerts."""
    fresh = r.transactions.agg(F.coalesce(floor_days(_run_date(r), F.max("transaction_date")), F.lit(99)).alias("v"))
    lag = rnd(F.coalesce(_mean_hours(micros("processing_date"), micros("transaction_date")), F.lit(0.0)), 2)
    etl = processing_lag(r).agg(lag.alias("v"))
    a = r.alerts.select("transaction_id", "created_at")
    t = r.transactions.select("transaction_id", "transaction_date")
    waited = a.join(t, "transaction_id").agg(rnd(F.coalesce(_mean_hours(
        micros("created_at"), micros("transaction_date")), F.lit(0.0)), 2).alias("v"))
    late = lambda status, days: F.count_if((F.col("status") == status) & (_age_days(r) > days))
    counts = r.alerts.agg(late("new", 30).alias("stale"), late("under_review", 14).alias("overdue"))
    row = lambda df, name, v, status: df.select(
        F.lit(name).alias("measure"), F.col(v).cast("double").alias("value"), status.alias("status"))
    v = F.col("v")
    upto = lambda good, warn: F.when(v < good, "good").when(v < warn, "warning").otherwise("critical")
    return (row(fresh, "freshness_days", "v", F.when(v <= 2, "good").when(v <= 7, "warning").otherwise("critical"))
            .unionByName(row(etl, "etl_lag_hours", "v", upto(24, 48)))
            .unionByName(row(waited, "alert_lag_hours", "v", upto(48, 96)))
            .unionByName(row(counts, "stale_new_alerts", "stale", _counted(F.col("stale"), 20)))
            .unionByName(row(counts, "overdue_reviews", "overdue", _counted(F.col("overdue"), 10))))


def weekly_lag(r: Report, weeks: int = 52) -> DataFrame:
    """Mean processing lag of the first ``weeks`` weeks."""
    g = processing_lag(r).groupBy(monday_week_key("transaction_date").alias("week")).agg(
        rnd(_mean_hours(micros("processing_date"), micros("transaction_date")), 2).alias("avg_lag_hours"))
    return g.orderBy("week").limit(weeks)


def open_alert_ages(r: Report) -> DataFrame:
    """Open alerts by age, the four buckets in fixed order and zero filled."""
    age, is_open = _age_days(r), F.col("status").isin(*OPEN)
    bucket = F.when(age <= 7, 1).when(age <= 14, 2).when(age <= 30, 3).otherwise(4)
    names = ["1-7 days", "7-14 days", "14-30 days", "30+ days"]
    counts = r.alerts.agg(*[F.count_if(is_open & (bucket == i + 1)).alias(f"n{i}") for i in range(4)])
    return counts.select(F.explode(F.array(*[F.struct(
        F.lit(i + 1).alias("position"), F.lit(n).alias("bucket"), F.col(f"n{i}").alias("alerts"))
        for i, n in enumerate(names)])).alias("x")).select("x.*")


def timeliness_score(r: Report) -> DataFrame:
    """Mean points of the five measures."""
    return timeliness(r).agg(rnd(F.avg(_points(F.col("status"))), 1).alias("score"))


def volume_bands(r: Report) -> DataFrame:
    """Weekly counts against mean and two population deviations; the rounded bands decide.
    With two weeks or fewer the bands are the mean and no week stands out."""
    weeks = r.transactions.groupBy(monday_week_key("transaction_date").alias("week")).agg(F.count("*").alias("transactions"))
    s = weeks.agg(F.count("*").alias("_n"), F.avg("transactions").alias("_m"), F.stddev_pop("transactions").alias("_sd"))
    enough, m, sd = F.col("_n") > 2, F.col("_m"), F.col("_sd")
    up = F.when(enough, rnd(m + 2 * sd, 1)).otherwise(m)
    low = F.when(enough, rnd(F.greatest(F.lit(0.0), m - 2 * sd), 1)).otherwise(m)
    n = F.col("transactions")
    return weeks.crossJoin(F.broadcast(s)).select(  # one row
        "week", "transactions", rnd(m, 1).alias("mean"), rnd(F.when(enough, sd).otherwise(0.0), 1).alias("deviation"),
        low.alias("lower_band"), up.alias("upper_band"), (enough & ((n > up) | (n < low))).alias("stands_out"))


def amount_shift(r: Report) -> DataFrame:
    """Mean amount of the last 30 days against everything before."""
    new = F.col("transaction_date") >= _recent_from(r)
    mean = lambda part: rnd(F.coalesce(F.sum(F.when(part, F.col("amount"))) / F.nullif(
        F.count_if(part), F.lit(0)), F.lit(0)), 2)
    g = r.transactions.agg(mean(new).alias("recent_avg"), mean(~new).alias("earlier_avg"))
    change = F.when(F.col("earlier_avg") > 0, rnd((F.col("recent_avg") - F.col("earlier_avg")) * 100.0
                                                  / F.col("earlier_avg"), 1)).otherwise(0.0)
    return g.withColumn("change_pct", change).withColumn("status", DQ._status(F.abs("change_pct"), 15, 30))


def new_countries(r: Report) -> DataFrame:
    """Countries first seen in the last 30 days; one aggregate a country, no second scan."""
    at = F.col("transaction_date")
    g = (r.transactions.where("counterparty_country IS NOT NULL").groupBy("counterparty_country").agg(
        F.min(at).alias("_first"), F.count("*").alias("transactions"), F.sum("amount").alias("_sum"))
        .where(F.col("_first") >= _recent_from(r)))
    risk = F.broadcast(r.country_risk.select(F.col("country_code").alias("_cc"), "risk_level"))  # a row a country
    return g.join(risk, F.col("counterparty_country") == F.col("_cc"), "left").select(
        F.col("counterparty_country").alias("country"), F.date_format("_first", "yyyy-MM-dd").alias("first_seen"),
        "transactions", rnd("_sum", 2).alias("total_amount"), F.coalesce("risk_level", F.lit("Unknown")).alias("risk"))


def high_value_spike(r: Report) -> DataFrame:
    """High-value transactions of the last four weeks that have any against the weeks before."""
    weeks = r.transactions.where(F.col("amount") > HIGH_VALUE).groupBy(
        monday_week_key("transaction_date").alias("week")).agg(F.count("*").alias("n"))
    back = F.row_number().over(Window.partitionBy().orderBy(F.desc("week")))  # one row a week
    g = weeks.withColumn("back", back).agg(
        F.count("*").alias("weeks"), F.coalesce(F.avg("n"), F.lit(0.0)).alias("_all"),
        F.avg(F.when(F.col("back") <= 4, F.col("n"))).alias("_last"),
        F.coalesce(F.avg(F.when(F.col("back") > 4, F.col("n"))), F.lit(0.0)).alias("_before"))
    enough = F.col("weeks") >= 4
    last, before = F.when(enough, F.col("_last")).otherwise(F.col("_all")), F.when(enough, F.col("_before")).otherwise(F.col("_all"))
    return g.select("weeks", rnd(last, 2).alias("last_mean"), rnd(before, 2).alias("earlier_mean"),
                    rnd((last - before) * 100.0 / F.greatest(before, F.lit(1.0)), 1).alias("change_pct")).withColumn(
        "status", DQ._status(F.abs("change_pct"), 20, 50))


def alert_rates(r: Report) -> DataFrame:
    """Alerts per hundred transactions by week; the rounded rates decide which weeks stand out."""
    t = r.transactions.select("transaction_id", monday_week_key("transaction_date").alias("week"))
    tx = t.distinct().groupBy("week").agg(F.count("*").alias("transactions"))
    al = r.alerts.select("transaction_id", "alert_id").join(t, "transaction_id").select("week", "alert_id").distinct(
        ).groupBy("week").agg(F.count("*").alias("_a"))
    weeks = tx.join(al, "week", "left").select("week", "transactions", F.coalesce("_a", F.lit(0)).alias("alerts"))
    weeks = weeks.withColumn("rate_pct", rnd(F.col("alerts") * 100.0 / F.col("transactions"), 2))
    s = weeks.agg(F.count("*").alias("_n"), F.avg("rate_pct").alias("_m"), F.stddev_pop("rate_pct").alias("_sd"))
    out = (F.col("_n") > 2) & (F.abs(F.col("rate_pct") - F.col("_m")) > 2 * F.col("_sd"))
    return weeks.crossJoin(F.broadcast(s)).select("week", "transactions", "alerts", "rate_pct", out.alias("stands_out"))


def statistical_score(r: Report) -> DataFrame:
    """Mean points of five parts: volume, amount shift, new countries, high values, alert rate."""
    parts = [
        volume_bands(r).agg(_points(_counted(F.count_if("stands_out"), 2)).alias("volume_points")),
        amount_shift(r).select(_points(F.col("status")).alias("amount_points")),
        new_countries(r).agg(_points(_counted(F.count("*"), 3)).alias("country_points")),
        high_value_spike(r).select(_points(F.col("status")).alias("high_value_points")),
        alert_rates(r).agg(_points(_counted(F.count_if("stands_out"), 2)).alias("rate_points"))]
    row = parts[0]
    for p in parts[1:]:
        row = row.crossJoin(p)  # one-row sides
    return row.withColumn("score", rnd(sum(F.col(c) for c in row.columns) / len(row.columns), 1))


def overall_score(r: Report) -> DataFrame:
    """Weighted score, section statuses, and how many checks warn or fail (the statistical ones are
    not counted)."""
    checks = DQ.completeness(r).select("status").unionByName(DQ.consistency(r).select("status")).unionByName(
        timeliness(r).select("status")).agg(F.count_if(F.col("status") == "warning").alias("warnings"),
                                            F.count_if(F.col("status") == "critical").alias("criticals"))
    one = lambda df, name: df.select(F.col("score").alias(name))
    row = (one(DQ.completeness_score(r), "completeness").crossJoin(one(DQ.consistency_score(r), "consistency"))
           .crossJoin(one(timeliness_score(r), "timeliness")).crossJoin(one(statistical_score(r), "statistical"))
           .crossJoin(checks))  # one-row sides
    sections = ["completeness", "consistency", "timeliness", "statistical"]
    total = sum(F.col(c) * w for c, w in zip(sections, (0.3, 0.3, 0.2, 0.2), strict=True))
    status = lambda c: F.when(F.col(c) >= 80, "good").when(F.col(c) >= 60, "warning").otherwise("critical")
    return row.select(rnd(total, 1).alias("overall"), *sections, *[status(c).alias(f"{c}_status") for c in sections],
                      "warnings", "criticals")


ALL = {
    "d05_timeliness": timeliness,
    "d07_weekly_lag": weekly_lag,
    "d07_open_alert_ages": open_alert_ages,
    "d08_timeliness_score": timeliness_score,
    "d09_volume_bands": volume_bands,
    "d10_amount_shift": amount_shift,
    "d11_new_countries": new_countries,
    "d12_high_value_spike": high_value_spike,
    "d13_alert_rates": alert_rates,
    "d14_statistical_score": statistical_score,
    "d15_overall_score": overall_score,
}
