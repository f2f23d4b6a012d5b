"""Derived inputs, written once for Spark and once as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.functions.flags import auto_flag
from sensorlake.functions.timezones import ntz_to_epoch, shift_seconds
from suite.registry import Tables

BOUNDS = {"click": 60.0, "view": 80.0, "error": 100.0, "purchase": 120.0, "signup": 90.0}


def raw_values():
    """Event value with some readings missing and some NaN."""
    e = F.col("event_id")
    return F.when(e % 97 == 0, F.lit(None).cast("double")).when(e % 89 == 0, float("nan")).otherwise(F.col("value"))


def upper_bound():
    kind = F.col("event_type")
    expr = F.lit(None).cast("double")
    for name, bound in BOUNDS.items():
        expr = F.when(kind == name, bound).otherwise(expr)
    return expr


def observations(t: Tables) -> DataFrame:
    """One stream per user: events as flagged observations (a narrow projection of the scan)."""
    value = raw_values()
    return t.events.select(
        F.col("user_id").alias("datastream_id"),
        ntz_to_epoch(F.col("ts")).alias("utc_time"),
        value.alias("data_value"),
        auto_flag(value, F.lit(0.5), upper_bound()).alias("qa_flag"))


_CASE = " ".join(f"WHEN event_type = '{k}' THEN {v}" for k, v in BOUNDS.items())
RAW_SQL = """
raw AS (
  SELECT *, user_id AS datastream_id, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS utc_time,
         CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN CAST('NaN' AS DOUBLE) ELSE value END
           AS data_value
  FROM events)"""
OBS_SQL = RAW_SQL + f""",
obs AS (
  SELECT datastream_id, utc_time, data_value, event_id, event_type,
         CASE WHEN data_value IS NULL THEN 'd' WHEN isnan(data_value) THEN 'c' WHEN isinf(data_value) THEN 'b'
              WHEN data_value < 0.5 OR data_value > (CASE {_CASE} END) THEN 'f' ELSE 'z' END AS qa_flag
  FROM raw)"""


def local_series(t: Tables) -> DataFrame:
    """Multi-year hourly-offset series: one stream per supplier."""
    return t.lineitem.select(
        F.col("l_suppkey").alias("datastream_id"),
        shift_seconds(F.col("l_shipdate"), F.col("l_linenumber") * 3600).alias("ts"),
        F.col("l_quantity").alias("value"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_orderkey").alias("row_key"))


SERIES_SQL = """
series AS (
  SELECT l_suppkey AS datastream_id, l_shipdate + l_linenumber * INTERVAL 1 HOUR AS ts, l_quantity AS value,
         l_extendedprice AS price, l_orderkey AS row_key
  FROM lineitem)"""


def local_sql(epoch: str, tz: str) -> str:
    """Epoch seconds to wall clock in DuckDB."""
    return f"(to_timestamp({epoch}) AT TIME ZONE '{tz}')"
