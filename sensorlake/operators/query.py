"""Datastream queries: time range, quality filter, local time, downsampling, precision.

All of them take one long table of observations for any number of streams; grouping always includes the stream.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.functions.buckets import bucket_start
from sensorlake.functions.flags import qa_predicate
from sensorlake.functions.numbers import short_precision
from sensorlake.functions.timezones import epoch_to_local
from sensorlake.sources.store import Layout

OPEN_INTERVALS = (None, "start", "end", "both")
SIMPLE_METHODS = ("mean", "sum", "count", "stddev", "variance")
PICK_METHODS = ("min", "max", "min_max")


def find_datastreams(registry: DataFrame, **lookup) -> DataFrame:
    """Registered streams that match ``lookup`` (all of them without one). A lookup that matches no stream is an error, as an
    unknown id is."""
    wanted = registry
    for column, value in lookup.items():
        wanted = wanted.filter(F.col(column) == value)
    if lookup and wanted.isEmpty():
        raise LookupError(f"no datastream with {lookup}")
    return wanted


def select_datastreams(observations: DataFrame, registry: DataFrame, **lookup) -> DataFrame:
    """Observations of the registered streams that match ``lookup``."""
    return observations.join(find_datastreams(registry, **lookup).select("datastream_id", "datastream_tablename"), "datastream_id")


def with_local_time(observations: DataFrame, tz: str = "UTC") -> DataFrame:
    """Add ``datetime_local``, the wall clock of ``tz``."""
    return observations.withColumn("datetime_local", epoch_to_local(F.col("utc_time"), tz))


def _day(value: str | dt.date) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def _moment(value: str | dt.datetime) -> dt.datetime:
    return value if isinstance(value, dt.datetime) else dt.datetime.fromisoformat(value)


def _bound(date, datetime_, name: str, end: bool) -> dt.datetime | None:
    if date is not None and datetime_ is not None:
        raise ValueError(f"give either {name}_date or {name}_datetime, not both")
    if datetime_ is not None:
        return _moment(datetime_)
    if date is None:
        return None
    return dt.datetime.combine(_day(date), dt.time(23, 59, 59, 999999) if end else dt.time())


def epoch_bounds(start_date=None, end_date=None, start_datetime=None, end_datetime=None) -> tuple[int | None, int | None]:
    """Epochs that enclose a range of local time in any zone: a day wider on both sides."""
    start, end, epoch0 = _bound(start_date, start_datetime, "start", end=False), _bound(end_date, end_datetime, "end", end=True), dt.datetime(1970, 1, 1)
    return (None if start is None else int((start - epoch0).total_seconds()) - 86400,
            None if end is None else int((end - epoch0).total_seconds()) + 86401)


def cells_of(layout: Layout, wanted: DataFrame | None, start: int | None, end: int | None) -> Column | None:
    """Condition on the cell columns of a stored table that holds all readings of the ``wanted`` streams from epoch ``start`` to ``end``; None
    if every cell may. At most one number per bucket reaches the driver."""
    conditions = []
    if wanted is not None and "bucket" in layout.cells:
        buckets = wanted.select(layout.cell_columns()["bucket"].alias("bucket")).distinct().collect()
        conditions.append(F.col("bucket").isin([r["bucket"] for r in buckets]))
    if "year" in layout.cells:
        conditions += [F.col("year") >= dt.datetime.fromtimestamp(start, dt.UTC).year] if start is not None else []
        conditions += [F.col("year") <= dt.datetime.fromtimestamp(end, dt.UTC).year] if end is not None else []
    return reduce(Column.__and__, conditions) if conditions else None


def between(df: DataFrame, start_date=None, end_date=None, start_datetime=None, end_datetime=None,
            open_interval: str | None = None) -> DataFrame:
    """Keep rows whose local time lies in the range; a date as end means the whole day.

    The same bounds, a day wider, also go on ``utc_time`` so that file statistics can skip data.
    """
    if open_interval not in OPEN_INTERVALS:
        raise ValueError(f"open_interval must be one of {OPEN_INTERVALS}")
    start = _bound(start_date, start_datetime, "start", end=False)
    end = _bound(end_date, end_datetime, "end", end=True)
    first, last = epoch_bounds(start_date, end_date, start_datetime, end_datetime)
    local = F.col("datetime_local")
    if start is not None:
        bound = F.lit(start.isoformat(sep=" ")).cast("timestamp_ntz")
        df = df.filter(F.col("utc_time") >= first)
        df = df.filter(local > bound if open_interval in ("start", "both") else local >= bound)
    if end is not None:
        bound = F.lit(end.isoformat(sep=" ")).cast("timestamp_ntz")
        df = df.filter(F.col("utc_time") <= last)
        df = df.filter(local < bound if open_interval in ("end", "both") else local <= bound)
    return df


def qa(df: DataFrame, flag: str = "z", mode: str = "greater_or_eq") -> DataFrame:
    """Keep rows by quality letter."""
    return df.filter(qa_predicate(F.col("qa_flag"), flag, mode))


def _smallest(value: Column, time: Column, skip_null: bool) -> Column:
    picked = F.min(F.when(value.isNotNull(), F.struct(value.alias("v"), time.alias("t"))))
    if skip_null:
        return picked
    return F.coalesce(picked, F.struct(F.lit(None).cast("double").alias("v"), F.min(time).alias("t")))


def _largest(value: Column, time: Column, skip_null: bool) -> Column:
    """Largest value, earliest time on ties. Times are negated inside the aggregate so one ``max`` does both."""
    epoch = F.unix_micros(time.cast("timestamp"))
    picked = F.max(F.when(value.isNotNull(), F.struct(value.alias("v"), (-epoch).alias("n"))))
    best = F.struct(picked["v"].alias("v"), F.timestamp_micros(-picked["n"]).cast("timestamp_ntz").alias("t"))
    if skip_null:
        return F.when(picked.isNotNull(), best)
    first_null = F.min(F.when(value.isNull(), time))
    nulls = F.struct(F.lit(None).cast("double").alias("v"), first_null.alias("t"))
    return F.when(first_null.isNotNull(), nulls).otherwise(best)


def downsample(df: DataFrame, interval: str | int, method: str, keys: tuple[str, ...] = ("datastream_id",),
               skip_null: bool = True) -> DataFrame:
    """One row per stream and interval of local time.

    ``mean, sum, count, stddev, variance`` ignore NULL (sample statistics, NULL for one value). ``min``, ``max``
    and ``min_max`` also give the time the value occurred, the earliest on ties; both extremes come from one pass.
    With ``skip_null=False`` a NULL reading counts as the largest value, as descending order in SQL puts it first.
    Every method is a partial aggregate, so a dominant stream is reduced before the shuffle.
    """
    value, local = F.col("data_value"), F.col("datetime_local")
    grouped = df.groupBy(*keys, bucket_start(local, interval).alias("truncated_datetime_local"))
    if method in SIMPLE_METHODS:
        aggregate = {"mean": F.avg, "sum": F.sum, "count": F.count, "stddev": F.stddev_samp,
                     "variance": F.var_samp}[method]
        return grouped.agg(aggregate(value).alias("data_value"))
    if method not in PICK_METHODS:
        raise ValueError(f"unknown method {method!r}, expected one of {SIMPLE_METHODS + PICK_METHODS}")
    aggregates = []
    if method in ("min", "min_max"):
        aggregates.append(_smallest(value, local, skip_null).alias("lo"))
    if method in ("max", "min_max"):
        aggregates.append(_largest(value, local, skip_null).alias("hi"))
    picked = grouped.agg(*aggregates)
    if skip_null:
        picked = picked.filter(F.col("lo" if method != "max" else "hi").isNotNull())
    columns = [*keys, "truncated_datetime_local"]
    if method in ("min", "min_max"):
        columns += [F.col("lo.t").alias("min_datetime_local"), F.col("lo.v").alias("min_data_value")]
    if method in ("max", "min_max"):
        columns += [F.col("hi.t").alias("max_datetime_local"), F.col("hi.v").alias("max_data_value")]
    return picked.select(*columns)


def with_precision(df: DataFrame, precision: str = "short") -> DataFrame:
    """``short`` rounds every value column to ten significant digits, ``full`` leaves them."""
    if precision == "full":
        return df
    if precision != "short":
        raise ValueError("precision must be 'short' or 'full'")
    for name, kind in df.dtypes:
        if kind == "double" and name.endswith("data_value"):
            df = df.withColumn(name, short_precision(F.col(name)))
    return df
