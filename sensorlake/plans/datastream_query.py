"""The datastream query as one plan built from typed options."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.operators import query as q
from sensorlake.sources import store


def datastream_data(observations: DataFrame, *, tz: str = "UTC", start_date=None, end_date=None,
                    start_datetime=None, end_datetime=None, open_interval: str | None = None,
                    qa_flag: str = "z", qa_flag_mode: str = "greater_or_eq",
                    downsample_interval: str | int | None = None, downsample_method: str | None = None,
                    precision: str = "short", skip_null: bool = True, ordered: bool = False) -> DataFrame:
    """Range, quality and downsampling over any number of streams.

    Filters on stored columns (``utc_time``, ``qa_flag``) reach the scan. Sorting is opt-in: it costs a range
    shuffle that a many-stream result rarely needs.
    """
    if (downsample_interval is None) != (downsample_method is None):
        raise ValueError("downsample_interval and downsample_method belong together")
    df = q.qa(observations, qa_flag, qa_flag_mode)
    df = q.with_local_time(df, tz)
    df = q.between(df, start_date, end_date, start_datetime, end_datetime, open_interval)
    if downsample_interval is None:
        df = df.select("datastream_id", "datetime_local", "data_value", "qa_flag")
    else:
        df = q.downsample(df, downsample_interval, downsample_method, skip_null=skip_null)
    df = q.with_precision(df, precision)
    if ordered:
        df = df.orderBy("datastream_id", F.col(df.columns[1]))
    return df


def stored_data(spark: SparkSession, layout: store.Layout, registry: DataFrame, lookup: dict, version: int | None = None, **options) -> DataFrame:
    """``datastream_data`` over a stored table, for the registered streams that match ``lookup`` (all of them if it is empty).

    Streams and the range of local time become buckets and years, and only cells of those are listed and read. A lookup that matches
    no stream is an error.
    """
    wanted = q.find_datastreams(registry, **lookup).select("datastream_id") if lookup else None
    limits = {k: options.get(k) for k in ("start_date", "end_date", "start_datetime", "end_datetime")}
    where = q.cells_of(layout, wanted, *q.epoch_bounds(**limits))
    rows = store.read(spark, layout, version, where)
    return datastream_data(rows if wanted is None else rows.join(wanted, "datastream_id", "left_semi"), **options)
