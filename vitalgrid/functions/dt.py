"""Wall-clock arithmetic on zone-less timestamps.

``dt_diff`` counts the unit boundaries crossed, not elapsed units: 01:50 to 02:10 is one hour.
All timestamps are ``timestamp_ntz`` and the session zone is UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = {"SECOND": 1_000_000, "MINUTE": 60_000_000, "HOUR": 3_600_000_000}


def micros(t: Column) -> Column:
    """Microseconds of the wall clock since 1970."""
    return F.unix_micros(t.cast("timestamp"))


def dt_diff(end: Column, start: Column, unit: str) -> Column:
    """Boundaries of ``unit`` between ``start`` and ``end``; negative if ``end`` is earlier."""
    if unit == "DAY":
        return F.date_diff(end, start).cast("long")
    if unit == "YEAR":
        return (F.year(end) - F.year(start)).cast("long")
    if unit == "MONTH":
        return ((F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)).cast("long")
    size = MICROS[unit]
    return F.floor(micros(end) / size) - F.floor(micros(start) / size)


def dt_trunc(t: Column, unit: str) -> Column:
    return F.date_trunc(unit, t).cast("timestamp_ntz")


def hours(n: int | Column) -> Column:
    """Interval of ``n`` hours; add it to or subtract it from a timestamp."""
    return F.make_dt_interval(hours=n if isinstance(n, Column) else F.lit(n))


def times_hours(n: Column) -> Column:
    """Interval of a column's number of hours; one multiplication a row, where ``hours`` goes through decimals."""
    return F.expr("INTERVAL '1' HOUR") * n


def hour_at(n: Column) -> Column:
    """Start of the hour that is ``n`` hours after 1970 began."""
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + times_hours(n)


def days(n: int | Column) -> Column:
    return F.make_dt_interval(days=n if isinstance(n, Column) else F.lit(n))


def ceil_hour(t: Column) -> Column:
    down = dt_trunc(t, "HOUR")
    return F.when(down == t, t).otherwise(down + hours(1))
