"""Epoch conversion and calendar parts.

Timestamps are zone-free (TIMESTAMP_NTZ): an epoch always reads as UTC,
whatever zone the session happens to be in.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _epoch() -> Column:
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def from_epoch_millis(ts: Column | str) -> Column:
    """Epoch milliseconds to a timestamp, milliseconds kept; null for what is no whole number."""
    return F.timestamp_add("MILLISECOND", _col(ts).try_cast("bigint"), _epoch())


def from_epoch_seconds(ts: Column | str) -> Column:
    """Epoch milliseconds to a timestamp in whole seconds."""
    seconds = F.call_function("div", _col(ts).try_cast("bigint"), F.lit(1000))
    return F.timestamp_add("SECOND", seconds, _epoch())


def to_epoch_millis(ts: Column | str) -> Column:
    """A zone-free timestamp to epoch milliseconds, finer digits cut off."""
    ts = _col(ts)
    day = F.unix_date(F.to_date(ts)).cast("bigint") * 86_400_000
    clock = F.hour(ts) * 3_600_000 + F.minute(ts) * 60_000
    return day + clock + F.floor(F.extract(F.lit("SECONDS"), ts) * 1000)


def weekday(start: Column | str, style: str = "name") -> Column:
    """`name` Thursday, `short` Thu, `sunday0` 4 (Sunday is 0)."""
    start = _col(start)
    if style == "name":
        return F.date_format(F.to_date(start), "EEEE")
    if style == "short":
        return F.date_format(F.to_date(start), "E")
    if style == "sunday0":
        return F.dayofweek(start) - 1
    raise ValueError(f"unknown weekday style {style!r}")


def calendar(start: Column | str, weekday_style: str = "name") -> dict[str, Column]:
    """The time dimension's parts of `start`, by column name."""
    start = _col(start)
    return {
        "hour": F.hour(start),
        "day": F.dayofmonth(start),
        "week": F.weekofyear(start),
        "month": F.month(start),
        "year": F.year(start),
        "weekday": weekday(start, weekday_style),
    }
