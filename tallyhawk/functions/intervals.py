"""Durations as microsecond counts, so NTZ timestamps compare without zone casts."""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS = {
    "microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
    "hour": 3_600_000_000, "day": 86_400_000_000, "week": 604_800_000_000,
}


def to_micros(span: str | _dt.timedelta | int) -> int:
    """``"20 minutes"``, ``"1 hour"``, a timedelta or a microsecond count -> microseconds."""
    if isinstance(span, int):
        return span
    if isinstance(span, _dt.timedelta):
        return (span.days * 86_400 + span.seconds) * 1_000_000 + span.microseconds
    total = 0
    parts = re.findall(r"(\d+(?:\.\d+)?)\s*([a-zA-Z]+)", span)
    if not parts:
        raise ValueError(f"cannot read duration {span!r}")
    for num, unit in parts:
        u = unit.lower().rstrip("s")
        if u not in _UNITS:
            raise ValueError(f"unknown unit {unit!r} in {span!r}")
        total += int(float(num) * _UNITS[u])
    return total


def micros_between(start: str | Column, end: str | Column) -> Column:
    """``end - start`` in microseconds (NULL if either side is NULL)."""
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    return F.timestamp_diff("MICROSECOND", s, e)


def epoch_micros(ts: str | Column) -> Column:
    """Microseconds since 1970-01-01 00:00:00 of a timestamp without time zone."""
    # a string literal casts to timestamp_ntz without the session time zone
    return micros_between(F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)
