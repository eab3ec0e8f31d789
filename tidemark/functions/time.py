"""Time arithmetic on zone-less microsecond timestamps."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = timedelta(microseconds=1)


EPOCH = "1970-01-01 00:00:00"


@dataclass(frozen=True)
class Calendar:
    """A duration in calendar units, whose length depends on where it begins."""

    years: int = 0
    months: int = 0
    days: int = 0

    def after(self, begin: Column) -> Column:
        whole = F.make_ym_interval(F.lit(self.years), F.lit(self.months))
        return begin + whole + F.lit(timedelta(days=self.days))


def ending(begin: Column, end) -> Column:
    """The end of a range: a time, or a duration after its begin."""
    if isinstance(end, timedelta):
        return begin + F.lit(end)
    return end.after(begin) if isinstance(end, Calendar) else timestamp(end)


def nanosecond(value) -> int:
    """Nanoseconds, 0 to 999, of a time beyond its microseconds; only pandas and numpy times have any."""
    if isinstance(value, np.datetime64):
        return int(value.astype("datetime64[ns]").astype(np.int64) % 1000)
    return getattr(value, "nanosecond", 0)


def timestamp(value) -> Column:
    """A timestamp literal from a datetime, a date, ISO text, a year number or a column.

    Times finer than a microsecond are cut to it.
    """
    if isinstance(value, Column):
        return value
    if isinstance(value, np.datetime64):
        value = value.astype("datetime64[us]").item()
    if isinstance(value, int) and not isinstance(value, bool):
        value = date(value, 1, 1)
    if isinstance(value, datetime) and value.tzinfo is not None:
        offset = value.utcoffset()
        value = value.replace(tzinfo=None) - offset
    if isinstance(value, datetime):
        value = value.isoformat(sep=" ")
    elif isinstance(value, date):
        value = value.isoformat()
    return F.lit(value).cast("timestamp_ntz")


def micros(ts: Column) -> Column:
    """Microseconds since the epoch, whatever the session's time zone."""
    since = ts.cast("timestamp_ntz") - F.lit(EPOCH).cast("timestamp_ntz")
    part = lambda unit: F.extract(F.lit(unit), since)
    seconds = (part("DAY").cast("long") * 24 + part("HOUR")) * 3600 + part("MINUTE") * 60
    return seconds * 1_000_000 + (part("SECOND") * 1_000_000).cast("long")


def from_micros(us: Column) -> Column:
    zero = F.lit(0)
    seconds = (us.cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)")
    return F.lit(EPOCH).cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, seconds)


def floor_div(us: Column, width: int) -> Column:
    """Integer floor division, exact for negative values too."""
    return _div(us - F.pmod(us, F.lit(width)), width)


def _div(us: Column, width: int) -> Column:
    return F.call_function("div", us, F.lit(width))


def shard_of(ts: Column, size: timedelta) -> Column:
    """Number of the time bucket a row belongs to."""
    return floor_div(micros(ts), size // MICROS)


def ns_split(ns: Column) -> Column:
    """Nanoseconds since the epoch -> struct(sec, nsec); negative times are null."""
    return F.when(
        ns >= 0,
        F.struct(
            _div(ns, 1_000_000_000).alias("sec"),
            F.pmod(ns, F.lit(1_000_000_000)).alias("nsec"),
        ),
    )


def ns_join(sec: Column, nsec: Column) -> Column:
    """(sec, nsec) -> nanoseconds since the epoch."""
    return sec * F.lit(1_000_000_000) + nsec


def to_utc(ts: Column, zone: str | Column) -> Column:
    """Local wall-clock time in ``zone`` -> UTC."""
    zone = F.lit(zone) if isinstance(zone, str) else zone
    return F.convert_timezone(zone, F.lit("UTC"), ts)


def in_zone(ts: Column, zone: str) -> Column:
    """UTC time -> wall-clock time in ``zone``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts)


def trunc_ms(ts: Column) -> Column:
    """Drop what is finer than a millisecond."""
    return F.date_trunc("MILLISECOND", ts).cast("timestamp_ntz")
