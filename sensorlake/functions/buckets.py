"""Time buckets as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorlake.functions.timezones import epoch_to_ntz, ntz_to_epoch, shift_seconds

CALENDAR_INTERVALS = ("second", "minute", "hour", "day", "week", "month", "year")
FIXED_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def bucket_start(local: Column, interval: str | int) -> Column:
    """Start of the calendar interval, or of the ``interval``-second slot, that holds ``local``."""
    if isinstance(interval, int) and not isinstance(interval, bool):
        if interval <= 0:
            raise ValueError(f"interval must be positive: {interval}")
        epoch = ntz_to_epoch(local)
        return epoch_to_ntz(epoch - F.pmod(epoch, F.lit(interval)))
    if interval not in CALENDAR_INTERVALS:
        raise ValueError(f"unknown interval {interval!r}, expected one of {CALENDAR_INTERVALS} or seconds")
    if interval == "second":
        return epoch_to_ntz(ntz_to_epoch(local))
    return F.date_trunc(interval, local).cast("timestamp_ntz")


RESAMPLE_UNITS = ("H", "D", "W", "MS", "AS", "AS-OCT")


def _month_index(ts: Column) -> Column:
    return F.year(ts) * 12 + F.month(ts) - 1


def _month_start(index: Column) -> Column:
    return F.make_date(F.floor(index / 12).cast("int"), (F.pmod(index, F.lit(12)) + 1).cast("int"), F.lit(1)) \
        .cast("timestamp_ntz")


def resample_bin(ts: Column, count: int, unit: str, anchor: Column) -> Column:
    """Start of the ``count`` x ``unit`` bin of ``ts``; bins are counted from ``anchor``.

    Hours, days and weeks are fixed lengths; the first bin of n weeks ends with the anchor's week. Months, calendar years and years that begin in October are calendar
    bins whose first one holds the anchor.
    """
    if unit not in RESAMPLE_UNITS or count < 1:
        raise ValueError(f"unknown frequency {count}{unit}")
    if unit in ("H", "D"):
        length = count * (3600 if unit == "H" else 86400)
        origin = ntz_to_epoch(anchor)
        return epoch_to_ntz(origin + F.floor((ntz_to_epoch(ts) - origin) / length) * length)
    if unit == "W":
        length = count * 7 * 86400
        # A bin of n weeks ends with the week of the anchor.
        origin = ntz_to_epoch(F.date_trunc("week", anchor).cast("timestamp_ntz")) - (count - 1) * 7 * 86400
        return epoch_to_ntz(origin + F.floor((ntz_to_epoch(ts) - origin) / length) * length)
    if unit == "MS":
        origin = _month_index(anchor)
        return _month_start(origin + F.floor((_month_index(ts) - origin) / count) * count)
    lead = 9 if unit == "AS-OCT" else 0
    this_year = F.floor((_month_index(ts) - lead) / 12)
    first_year = F.floor((_month_index(anchor) - lead) / 12)
    return _month_start((first_year + F.floor((this_year - first_year) / count) * count) * 12 + lead)


def mid_bin(start: Column, count: int, unit: str) -> Column:
    """Middle of a bin, given its start: half the length; a week's middle is Thursday noon."""
    if unit in ("H", "D", "W"):
        length = count * {"H": 3600, "D": 86400, "W": 7 * 86400}[unit]
        return shift_seconds(start, length // 2)
    months = count if unit == "MS" else 12 * count
    days = F.datediff(F.add_months(start.cast("date"), months), start.cast("date"))
    return shift_seconds(start, days * F.lit(43200))
