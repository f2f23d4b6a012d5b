"""Collects the checked queries: a Spark function and its SQL oracle under one name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.session import require_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Lazy readers of the parquet tables of one scale factor."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = require_utc(spark)
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None):
    """Register ``fn(tables)`` under ``name``."""
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def r4(value: Column) -> Column:
    """Round for comparison; the tiny surplus keeps exact halves on one side in both engines.

    NaN becomes NULL."""
    return F.when(~F.isnan(value), F.floor(value * 10000.0 + 0.500001) / 10000.0)


def sql_r4(expression: str) -> str:
    return f"(floor(({expression}) * 10000.0 + 0.500001) / 10000.0)"


def stamp(ts: Column) -> Column:
    """Wall clock as epoch seconds."""
    return F.unix_seconds(ts.cast("timestamp"))


def sql_stamp(expression: str) -> str:
    return f"CAST(epoch_us({expression}) // 1000000 AS BIGINT)"
