"""Date and time helpers with the reference's calendar semantics.

The reference's ``DATEDIFF(unit, a, b)`` counts unit *boundaries* crossed,
not elapsed units: 00:00:59 -> 00:01:00 is one minute.  Spark's
``timestamp_diff`` measures elapsed time, so both ends are truncated to the
unit first.  All helpers return plain Column expressions (codegen friendly).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RAW_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"

_TRUNC_UNITS = {"second": "SECOND", "minute": "MINUTE", "hour": "HOUR"}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def boundary_diff(unit: str, start, end) -> Column:
    """Number of ``unit`` boundaries between ``start`` and ``end`` (signed).

    second/minute/hour: truncate then ``timestamp_diff``; day: date
    difference; month: calendar-month index difference (Jan 31 -> Feb 1 = 1).
    NULL in either input gives NULL.
    """
    unit = unit.lower()
    start, end = _c(start), _c(end)
    if unit in _TRUNC_UNITS:
        u = _TRUNC_UNITS[unit]
        return F.timestamp_diff(u, F.date_trunc(unit, start), F.date_trunc(unit, end))
    if unit == "day":
        return F.datediff(F.to_date(end), F.to_date(start)).cast("long")
    if unit == "month":
        return ((F.year(end) * 12 + F.month(end)) - (F.year(start) * 12 + F.month(start))).cast("long")
    raise ValueError(f"unsupported unit {unit!r}")


def parse_raw_ts(col) -> Column:
    """Raw text ``YYYY-MM-DDTHH:MM:SSZ`` -> TIMESTAMP_NTZ (raises on bad input)."""
    return F.to_timestamp_ntz(_c(col), F.lit(RAW_TS_FORMAT))


def format_raw_ts(col) -> Column:
    """TIMESTAMP(_NTZ) -> raw text form used by the tracking feed."""
    return F.date_format(_c(col), RAW_TS_FORMAT)


def add_hours(col, n) -> Column:
    n = F.lit(n) if isinstance(n, int) else _c(n)
    return F.timestamp_add("HOUR", n, _c(col))



def as_of_ts(as_of) -> Column:
    """Explicit evaluation timestamp (NTZ) used in place of CURRENT_TIMESTAMP()."""
    return F.lit(str(as_of)).cast("timestamp_ntz")
