"""GTFS clock text ``H:M:S`` (hours may exceed 23) and time-of-day periods."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Time-of-day periods as [start, end) minutes after midnight,
# with the hours used to turn a trip count into trips per hour. Anything not
# covered (1260 minutes and later) is the last period.
PERIODS = [
    ("Overnight", 0, 240, 4),
    ("Early Morning", 240, 360, 2),
    ("AM", 360, 540, 3),
    ("Midday", 540, 900, 6),
    ("PM", 900, 1140, 4),
    ("Evening", 1140, 1260, 2),
    ("Late Evening", 1260, None, 3),
]

# School-hour windows, inclusive, in seconds after midnight
# (07:00-09:00 and 14:00-16:00).
SCHOOL_WINDOWS = [(7 * 3600, 9 * 3600), (14 * 3600, 16 * 3600)]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clock_part(c, i: int) -> Column:
    """i-th field (0 = hours) of a clock text as int; bad text -> null."""
    return F.try_element_at(F.split(_c(c), ":"), F.lit(i + 1)).try_cast("int")


def clock_minutes(c) -> Column:
    """Minutes since midnight of the service day; seconds ignored."""
    return clock_part(c, 0) * 60 + clock_part(c, 1)


def clock_seconds_of_day(c) -> Column:
    """Seconds since midnight with the hour taken modulo 24."""
    return (clock_part(c, 0) % 24) * 3600 + clock_part(c, 1) * 60 + clock_part(c, 2)


def period_label(minutes, periods=PERIODS) -> Column:
    """Label a minute-of-day with its period (searched CASE, first match)."""
    m = _c(minutes)
    expr = None
    for name, lo, hi, _ in periods:
        if hi is None:
            expr = expr.otherwise(F.lit(name)) if expr is not None else F.lit(name)
            break
        cond = (m >= lo) & (m < hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def period_column_name(label: str) -> str:
    return label.lower().replace(" ", "_")


def in_windows(seconds, windows=SCHOOL_WINDOWS) -> Column:
    s = _c(seconds)
    cond = None
    for lo, hi in windows:
        c = s.between(lo, hi)
        cond = c if cond is None else (cond | c)
    return cond
