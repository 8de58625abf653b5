"""Time helpers.  All timestamps are TIMESTAMP_NTZ (wall-clock, no zone), so
every helper here is independent of the session time zone."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

US_PER_SECOND = 1_000_000
US_PER_HOUR = 3_600 * US_PER_SECOND
US_PER_DAY = 24 * US_PER_HOUR

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def micros(ts: Column | str) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP_NTZ (or DATE) value.

    Built from the wall-clock fields (day number, hour, minute, seconds with
    fraction), which never consult the session time zone; ``timestampdiff``
    would cast through it and shift across daylight-saving changes.
    """
    t = _c(ts).cast("timestamp_ntz")
    day = F.unix_date(t.cast("date")).cast("bigint")
    sec_us = (F.date_part(F.lit("SECOND"), t) * US_PER_SECOND).cast("bigint")
    return (day * US_PER_DAY + F.hour(t).cast("bigint") * US_PER_HOUR
            + F.minute(t).cast("bigint") * (60 * US_PER_SECOND) + sec_us)


def trunc_seconds(ts: Column | str) -> Column:
    """Drop the sub-second part, keeping TIMESTAMP_NTZ."""
    t = _c(ts).cast("timestamp_ntz")
    frac = (F.date_part(F.lit("SECOND"), t) * US_PER_SECOND).cast("bigint") % US_PER_SECOND
    return F.timestamp_add("MICROSECOND", -frac, t)


def to_ntz(col: Column | str) -> Column:
    return _c(col).cast("timestamp_ntz")


def ts_lit(value: str) -> Column:
    """A TIMESTAMP_NTZ literal from 'YYYY-MM-DD[ HH:MM:SS]'."""
    return F.lit(_dt.datetime.fromisoformat(value)).cast("timestamp_ntz")


def date_lit(value: str) -> Column:
    return F.lit(_dt.date.fromisoformat(value))


def julian_days(a: Column | str, b: Column | str) -> Column:
    """julianday(a) - julianday(b) as a double number of days."""
    return (micros(a) - micros(b)) / float(US_PER_DAY)


def floor_days(a: Column | str, b: Column | str) -> Column:
    """timedelta(a - b).days: floored, can be -1."""
    return F.floor((micros(a) - micros(b)) / F.lit(US_PER_DAY)).cast("bigint")


def month_key(ts: Column | str) -> Column:
    """strftime('%Y-%m')."""
    return F.date_format(_c(ts), "yyyy-MM")


def weekday_sun0(ts: Column | str) -> Column:
    """strftime('%w'): 0 = Sunday .. 6 = Saturday."""
    return (F.dayofweek(_c(ts)) - 1).cast("int")


def monday_week_key(ts: Column | str, sep: str = "-W") -> Column:
    """strftime('%Y-W%W'): Monday-based week, week 00 before the first Monday."""
    d = F.to_date(_c(ts))
    wk = F.floor((F.dayofyear(d) - 1 + 7 - F.weekday(d)) / 7).cast("int")
    return F.concat(F.year(d).cast("string"), F.lit(sep), F.lpad(wk.cast("string"), 2, "0"))
