"""The as-of instant. Nothing in this package reads a wall clock: every "now" and every "today"
follows from one UTC instant and one business time zone given by the caller."""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

BUSINESS_ZONE = "US/Eastern"

_EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


def instant_ms(as_of: dt.datetime | int) -> int:
    """Epoch milliseconds of `as_of`; a datetime without a zone is taken as UTC."""
    if isinstance(as_of, int):
        return as_of
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=dt.timezone.utc)
    return (as_of - _EPOCH) // dt.timedelta(milliseconds=1)


def wall_clock(as_of: dt.datetime | int, tz: str = BUSINESS_ZONE) -> dt.datetime:
    """`as_of` as a zone-less datetime on the clocks of `tz`."""
    instant = _EPOCH + dt.timedelta(milliseconds=instant_ms(as_of))
    return instant.astimezone(ZoneInfo(tz)).replace(tzinfo=None)


def business_day(as_of: dt.datetime | int, tz: str = BUSINESS_ZONE) -> dt.date:
    """The calendar day in `tz` at `as_of`."""
    return wall_clock(as_of, tz).date()


def stamp(as_of: dt.datetime | int, tz: str = BUSINESS_ZONE) -> Column:
    """`as_of` as a constant TIMESTAMP_NTZ on the clocks of `tz`."""
    return F.lit(wall_clock(as_of, tz).isoformat(sep=" ", timespec="milliseconds")).cast("timestamp_ntz")
