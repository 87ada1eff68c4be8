"""Lookback parameters and time bins."""

from __future__ import annotations

import re
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, functions as F

_UNITS = {"d": "days", "h": "hours", "m": "minutes", "s": "seconds"}


def timespan(value: str | timedelta | None) -> timedelta | None:
    """``"7d"``, ``"24h"``, ``"15m"``, ``"30s"`` or a timedelta."""
    if value is None or isinstance(value, timedelta):
        return value
    match = re.fullmatch(r"\s*(\d+(?:\.\d+)?)\s*([dhms])\s*", value)
    if not match:
        raise ValueError(f"not a timespan: {value!r}")
    return timedelta(**{_UNITS[match.group(2)]: float(match.group(1))})


def clamp_lookback(lookback, default: timedelta, longest: timedelta) -> timedelta:
    """The default when none is given, never more than the longest allowed."""
    asked = timespan(lookback)
    return default if asked is None else min(asked, longest)


def instant(as_of: datetime | None) -> datetime:
    """The pinned time of a run as an aware UTC datetime; now when it is not pinned."""
    if as_of is None:
        return datetime.now(timezone.utc)
    return as_of.replace(tzinfo=timezone.utc) if as_of.tzinfo is None else as_of.astimezone(timezone.utc)


def at(as_of: datetime | None, back: timedelta | str = timedelta(0)) -> Column:
    """Timestamp literal ``as_of - back``; a literal so that scans can use it."""
    return F.lit(instant(as_of) - timespan(back))


def hour(value: Column) -> Column:
    """Start of the UTC hour, whatever the session's time zone."""
    return F.timestamp_micros((F.floor(F.unix_micros(value) / F.lit(3_600_000_000)) * 3_600_000_000).cast("bigint"))


def utc_day(value: Column) -> Column:
    """The UTC date of a timestamp, whatever the session's time zone."""
    return F.date_from_unix_date(F.floor(F.unix_micros(value) / F.lit(86_400_000_000)).cast("int"))


def day_at(as_of: datetime | None, back: timedelta | str = timedelta(0)) -> Column:
    """UTC date literal of ``as_of - back``."""
    return F.lit((instant(as_of) - timespan(back)).date())


def seconds_between(later: Column, earlier: Column) -> Column:
    """Length of a time difference in seconds, with fractions."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1000000.0)


def whole_share(part_: Column, whole: Column) -> Column:
    """Integer percentage, null over an empty whole."""
    return F.call_function("div", part_ * F.lit(100), F.nullif(whole, F.lit(0)))
