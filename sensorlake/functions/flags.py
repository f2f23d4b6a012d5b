"""Quality flags as column expressions. A later letter of the alphabet is better quality."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

QA_MODES = ("greater_or_eq", "less_or_eq", "equal")


def qa_predicate(flag_col: Column, flag: str = "z", mode: str = "greater_or_eq") -> Column:
    """Filter on the quality letter."""
    if len(flag) != 1 or not "a" <= flag <= "z":
        raise ValueError(f"qa_flag must be one letter a-z, got {flag!r}")
    if mode == "greater_or_eq":
        return flag_col >= flag
    if mode == "less_or_eq":
        return flag_col <= flag
    if mode == "equal":
        return flag_col == flag
    raise ValueError(f"unknown qa mode {mode!r}, expected one of {QA_MODES}")


def auto_flag(value: Column, lower: Column, upper: Column, null_as_nan: bool = False) -> Column:
    """Missing, NaN, infinite, out-of-range or good.

    NaN is tested before the range because Spark orders NaN above every number. ``null_as_nan`` folds missing
    values into NaN (flag ``c``) as a float-typed load would.
    """
    infinite = value.isin(float("inf"), float("-inf"))
    return (F.when(value.isNull(), "c" if null_as_nan else "d")
            .when(F.isnan(value), "c")
            .when(infinite, "b")
            .when((value < lower) | (value > upper), "f")
            .otherwise("z"))


def manual_flag(epoch: Column, current: Column, ranges: Column) -> Column:
    """Apply an array of hand-made ranges ``(start_epoch, end_epoch, qa_flag)``: inclusive, open when null,
    the last matching range wins, otherwise ``current`` stays.

    The ranges travel as one array inside the stream's mapping row, so rows are neither multiplied nor shuffled.
    """
    def covers(r: Column) -> Column:
        after = r["start_epoch"].isNull() | (epoch >= r["start_epoch"])
        before = r["end_epoch"].isNull() | (epoch <= r["end_epoch"])
        return after & before

    hits = F.filter(F.coalesce(ranges, F.array().cast("array<struct<start_epoch:bigint,end_epoch:bigint,qa_flag:string>>")), covers)
    picked = F.try_element_at(hits, F.lit(-1))["qa_flag"]
    checked = F.when(picked.rlike("^[a-z]$"), picked).when(
        picked.isNotNull(), F.raise_error(F.concat(F.lit("manual qa_flag must be a letter a-z: "), picked)))
    return F.coalesce(checked, current)


def parse_ranges(ranges: Column) -> Column:
    """Mapping-file ranges (ISO text, read as UTC) to epoch ranges for :func:`manual_flag`."""
    def one(r: Column) -> Column:
        return F.struct(
            F.unix_seconds(F.to_timestamp(r["datetime_start"])).alias("start_epoch"),
            F.unix_seconds(F.to_timestamp(r["datetime_end"])).alias("end_epoch"),
            r["qa_flag"].alias("qa_flag"))

    return F.transform(ranges, one)
