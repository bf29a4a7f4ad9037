"""Time-of-day and calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MIN = 1440
HALF_DAY_MIN = 720


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def wrap_minutes(minutes: Column | str) -> Column:
    """A difference of minutes brought to [-720, 720): ten past midnight is 20 after 23:50."""
    return F.pmod(_col(minutes) + F.lit(HALF_DAY_MIN), F.lit(DAY_MIN)) - F.lit(HALF_DAY_MIN)


def minute_of_day(ts: Column | str) -> Column:
    return F.hour(_col(ts)) * 60 + F.minute(_col(ts))


def weekday_from_monday(ts: Column | str) -> Column:
    """Monday = 0 .. Sunday = 6."""
    return F.weekday(_col(ts))


def month_key(ts: Column | str) -> Column:
    """YYYYMM as a long, in the session zone for zoned timestamps."""
    return (F.year(_col(ts)) * 100 + F.month(_col(ts))).cast("long")


def month_text(ts: Column | str) -> Column:
    return F.date_format(_col(ts), "yyyy-MM")


def fractional_hour(minutes: Column | str) -> Column:
    return _col(minutes) / F.lit(60.0)


def local_date(ts: Column | str) -> Column:
    """The calendar day in the session zone; the time and the zone are dropped."""
    return F.to_date(_col(ts))


def in_zone(ts: Column | str, zone: str) -> Column:
    """Wall-clock time of a zoned timestamp in ``zone``, independent of the session zone."""
    return F.convert_timezone(None, F.lit(zone), _col(ts))
