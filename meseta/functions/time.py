"""Instants, dates, grains and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Minutes of each sub-monthly grain.
GRAIN_MINUTES = {"FIVE_MINUTES": 5, "FIFTEEN_MINUTES": 15, "HOUR": 60}


def instant(text: Column) -> Column:
    """ISO text, with or without an offset, to an instant; unreadable -> NULL."""
    return F.try_to_timestamp(text)


def instant_with(text: Column, pattern: str) -> Column:
    return F.try_to_timestamp(text, F.lit(pattern))


def day(text: Column, pattern: str = "yyyy-MM-dd") -> Column:
    return F.try_to_timestamp(text, F.lit(pattern)).cast("date")


def floor_grain(ts: Column, grain: str) -> Column:
    """Start of the interval that holds ``ts``.

    The result keeps the session's LTZ timestamp type; cast back when the input
    was ``timestamp_ntz``.
    """
    if grain == "MONTH":
        return F.date_trunc("month", ts)
    minutes = GRAIN_MINUTES[grain]
    hour = F.date_trunc("hour", ts)
    if minutes == 60:
        return hour
    offset = (F.minute(ts) - F.minute(ts) % minutes).cast("int")
    return hour + F.make_dt_interval(F.lit(0), F.lit(0), offset)


def shift_hours(ts: Column, hours: int | Column) -> Column:
    return ts + F.make_dt_interval(F.lit(0), F.lit(hours) if isinstance(hours, int) else hours)


def minutes_between(earlier: Column, later: Column) -> Column:
    """Difference in minutes as a double, keeping fractions of a minute."""
    return F.timestamp_diff("MICROSECOND", earlier, later) / F.lit(60_000_000.0)


def month_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def civil_month(ts: Column, zone: str = "Europe/Madrid") -> Column:
    """``yyyy-MM`` of an instant on the civil calendar of ``zone``.

    A local month starts late on the last UTC day of the month before, so the
    label must not be read from the UTC clock.
    """
    return F.date_format(F.from_utc_timestamp(ts, zone), "yyyy-MM")


def calendar_parts(ts: Column) -> dict[str, Column]:
    """Calendar attributes of a sub-monthly member."""
    return {
        "date": F.to_date(ts),
        "year": F.year(ts),
        "month": F.month(ts),
        "year_month": month_label(ts),
        "day": F.dayofmonth(ts),
        "day_of_week": F.dayofweek(ts),
        "hour": F.hour(ts),
        "minute": F.minute(ts),
    }


def solar_clock(hours: Column) -> Column:
    """Fraction of hours to clock text: 5.5 -> ``05:30``; any fraction counts as a half."""
    whole = F.floor(hours).cast("int")
    half = F.when(hours > whole, F.lit(":30")).otherwise(F.lit(":00"))
    return F.concat(F.lpad(whole.cast("string"), 2, "0"), half)
