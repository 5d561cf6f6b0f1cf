"""Calendar arithmetic on GTFS ``yyyymmdd`` integers and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# GTFS calendar flag columns in ISO order (Monday first).
DAY_COLUMNS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
WEEKDAY_COLUMNS = DAY_COLUMNS[:5]
WEEKEND_COLUMNS = DAY_COLUMNS[5:]

# Daytype labels.
WEEKDAY, SATURDAY, SUNDAY = "Weekday", "Saturday", "Sunday"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def idiv(c, n: int) -> Column:
    """Integer division truncating toward zero, exact for every long (SQL ``div``; ``/`` is a double)."""
    return F.call_function("div", _c(c).cast("long"), F.lit(n).cast("long"))


def year_of(c) -> Column:
    return idiv(c, 10000).cast("int")


def month_of(c) -> Column:
    return (idiv(c, 100) % 100).cast("int")


def day_of(c) -> Column:
    return (_c(c) % 100).cast("int")


def date_from_parts(y, m, d) -> Column:
    """Build a date; an impossible date gives null instead of failing."""
    return F.try_to_date(F.concat_ws("-", _c(y).cast("string"), _c(m).cast("string"),
                                     _c(d).cast("string")), "y-M-d")


def int_to_date(c) -> Column:
    """yyyymmdd integer -> date (null when impossible)."""
    return F.try_to_date(_c(c).cast("string"), "yyyyMMdd")


def date_to_int(c) -> Column:
    c = _c(c)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def clamp_day(y, m, d, literal: bool = False) -> Column:
    """Repair impossible days of month such as Feb 31.

    ``literal=False``: clamp to the month's last day.
    ``literal=True``: the original rule order -- any month with day > 28 in
    February becomes 28 first, then in a year divisible by four every day
    above 29 becomes 29 (no month test), then 30-day months are capped.
    """
    y, m, d = _c(y), _c(m), _c(d)
    if literal:
        return (F.when((m == 2) & (d > 28), F.lit(28))
                .when((y % 4 == 0) & (d > 29), F.lit(29))
                .when(m.isin(9, 4, 6, 11) & (d > 30), F.lit(30))
                .otherwise(d))
    last = F.dayofmonth(F.last_day(date_from_parts(y, m, F.lit(1))))
    return F.least(d, last)


def iso_weekday(c) -> Column:
    """1 = Monday ... 7 = Sunday (``weekday`` is 0-based Monday)."""
    return F.weekday(_c(c)) + 1


def weekday_name(c) -> Column:
    """English weekday name, e.g. ``Monday``."""
    return F.date_format(_c(c), "EEEE")


def daytype(c) -> Column:
    """Weekday / Saturday / Sunday from a date."""
    dow = iso_weekday(c)
    return (F.when(dow.between(1, 5), F.lit(WEEKDAY))
            .when(dow == 6, F.lit(SATURDAY))
            .when(dow == 7, F.lit(SUNDAY)))
