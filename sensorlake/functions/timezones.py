"""Local time and UTC as column expressions.

Wall-clock values are TIMESTAMP_NTZ, instants are epoch seconds (BIGINT). The session zone must be UTC.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Zone abbreviations that mean one constant offset, in hours from UTC.
ABBREVIATION_HOURS = {
    "UTC": 0, "GMT": 0, "Z": 0,
    "AST": -4, "ADT": -3,
    "EST": -5, "EDT": -4,
    "CST": -6, "CDT": -5,
    "MST": -7, "MDT": -6,
    "PST": -8, "PDT": -7,
    "AKST": -9, "AKDT": -8,
    "HST": -10,
}

_POSIX_OFFSET = re.compile(r"^(?:UTC|GMT)([+-])(\d{1,2})(?::?(\d{2}))?$", re.IGNORECASE)


def _offset_name(hours: int, minutes: int = 0, negative: bool = False) -> str:
    if hours == 0 and minutes == 0:
        return "UTC"
    return f"{'-' if negative else '+'}{hours:02d}:{minutes:02d}"


def normalize_tz(name: str) -> str:
    """Translate a zone name to the one Spark reads the same way.

    ``UTC+7`` carries the POSIX sign (seven hours *west*), and an abbreviation such as ``PST`` is a constant
    offset, also in summer. Region names pass through.
    """
    posix = _POSIX_OFFSET.match(name.strip())
    if posix:
        sign, hours, minutes = posix.groups()
        return _offset_name(int(hours), int(minutes or 0), negative=sign == "+")
    hours = ABBREVIATION_HOURS.get(name.strip().upper())
    if hours is not None:
        return _offset_name(abs(hours), negative=hours < 0)
    return name.strip()


def _zone(tz: str | Column) -> Column:
    return F.lit(normalize_tz(tz)) if isinstance(tz, str) else tz


def epoch_to_ntz(epoch: Column) -> Column:
    """Epoch seconds as the UTC wall clock."""
    return F.timestamp_seconds(epoch).cast("timestamp_ntz")


def ntz_to_epoch(ts: Column) -> Column:
    """The UTC wall clock as epoch seconds, rounded down."""
    return F.unix_seconds(ts.cast("timestamp"))


def utc_to_local(ts: Column, tz: str | Column) -> Column:
    """UTC wall clock to the wall clock of ``tz``. With the session in UTC the casts keep the value, and a literal
    zone is resolved once per task instead of once per row."""
    return F.from_utc_timestamp(ts.cast("timestamp"), _zone(tz)).cast("timestamp_ntz")


def local_to_utc(ts: Column, tz: str | Column) -> Column:
    """Wall clock of ``tz`` to UTC; the repeated hour takes its first pass."""
    return F.to_utc_timestamp(ts.cast("timestamp"), _zone(tz)).cast("timestamp_ntz")


def epoch_to_local(epoch: Column, tz: str | Column = "UTC") -> Column:
    """Epoch seconds to the wall clock of ``tz``."""
    if isinstance(tz, str) and normalize_tz(tz) == "UTC":
        return epoch_to_ntz(epoch)
    return F.from_utc_timestamp(F.timestamp_seconds(epoch), _zone(tz)).cast("timestamp_ntz")


def shift_seconds(ts: Column, seconds: Column | int) -> Column:
    """Move a wall clock value by a number of seconds."""
    amount = F.lit(seconds) if isinstance(seconds, int) else seconds
    micros = F.unix_micros(ts.cast("timestamp")) + amount.cast("bigint") * 1_000_000
    return F.timestamp_micros(micros).cast("timestamp_ntz")


def is_gap(ts: Column, tz: str | Column) -> Column:
    """True for wall clock values that the zone skips (clocks moved forward)."""
    return utc_to_local(local_to_utc(ts, tz), tz) != ts


def fall_back_seconds(ts: Column, tz: str | Column) -> Column:
    """How far the clock goes back within a day after ``ts``: the zone offset in force minus the one a day later."""
    utc = F.to_utc_timestamp(ts.cast("timestamp"), _zone(tz))
    later = F.timestamp_micros(F.unix_micros(utc) + 86_400_000_000)
    now = F.unix_seconds(ts.cast("timestamp")) - F.unix_seconds(utc)
    then = F.unix_seconds(F.from_utc_timestamp(later, _zone(tz))) - F.unix_seconds(later)
    return now - then


def is_repeated(ts: Column, tz: str | Column) -> Column:
    """True for wall clock values that occur twice (clocks moved back)."""
    back = fall_back_seconds(ts, tz)
    second = shift_seconds(local_to_utc(ts, tz), back)
    return F.when(back > 0, utc_to_local(second, tz) == ts).otherwise(F.lit(False))


# Hour offsets that sample sheets use for their zone labels.
LABEL_OFFSET_HOURS = {
    "eastern standard time": -4,
    "est": -4,
    "mountain standard time": -7,
    "mst": -7,
    "pacific standard time": -8,
    "pst": -8,
}


def label_offset(label: Column) -> Column:
    """Hour offset of a sample sheet's zone label, 0 when unknown."""
    table = F.create_map(*[F.lit(x) for pair in LABEL_OFFSET_HOURS.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.lower(label)), F.lit(0))
