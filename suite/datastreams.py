"""Datastream query checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorlake.operators import query as q
from sensorlake.plans.datastream_query import datastream_data
from suite.registry import query, r4, sql_r4, sql_stamp, stamp
from suite.views import OBS_SQL, local_sql, observations

DENVER = "America/Denver"


def _flat(df):
    """Wall clocks to epoch seconds, NaN to NULL, values rounded."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(name)
        if kind == "timestamp_ntz":
            c = stamp(c)
        elif kind == "double":
            c = r4(F.when(~F.isnan(c), c))
        out.append(c.alias(name))
    return df.select(*out)


def _value_sql(v="data_value"):
    return sql_r4(f"CASE WHEN NOT isnan({v}) THEN {v} END")


@query("ds_scan", f"""
WITH {OBS_SQL}, registry AS (
  SELECT user_id AS datastream_id, 'stream_' || CAST(user_id AS VARCHAR) || '_meas' AS datastream_tablename
  FROM events GROUP BY user_id)
SELECT o.datastream_id, r.datastream_tablename, o.utc_time, {_value_sql()} AS data_value, o.qa_flag
FROM obs o JOIN registry r ON o.datastream_id = r.datastream_id""")
def ds_scan(t):
    registry = t.events.select(F.col("user_id").alias("datastream_id")).distinct().withColumn(
        "datastream_tablename", F.concat(F.lit("stream_"), F.col("datastream_id").cast("string"), F.lit("_meas")))
    return _flat(q.select_datastreams(observations(t), registry)).select(
        "datastream_id", "datastream_tablename", "utc_time", "data_value", "qa_flag")


@query("ds_local_time", f"""
WITH {OBS_SQL}
SELECT datastream_id, utc_time, {sql_stamp(local_sql('utc_time', DENVER))} AS denver,
       utc_time - 7 * 3600 AS utc_plus_7, utc_time - 8 * 3600 AS pst
FROM obs""")
def ds_local_time(t):
    df = observations(t)
    out = q.with_local_time(df, DENVER).withColumnRenamed("datetime_local", "denver")
    out = q.with_local_time(out, "UTC+7").withColumnRenamed("datetime_local", "utc_plus_7")
    out = q.with_local_time(out, "PST").withColumnRenamed("datetime_local", "pst")
    return _flat(out).select("datastream_id", "utc_time", "denver", "utc_plus_7", "pst")


@query("ds_time_range", f"""
WITH {OBS_SQL}, loc AS (SELECT *, {local_sql('utc_time', DENVER)} AS l FROM obs)
SELECT datastream_id, {sql_stamp('l')} AS datetime_local, {_value_sql()} AS data_value, qa_flag FROM loc
WHERE l >= TIMESTAMP '2024-01-05 00:00:00' AND l <= TIMESTAMP '2024-01-20 23:59:59.999999' AND qa_flag >= 'z'""")
def ds_time_range(t):
    return _flat(datastream_data(observations(t), tz=DENVER, start_date="2024-01-05", end_date="2024-01-20"))


@query("ds_open_interval", f"""
WITH {OBS_SQL}, cases AS (SELECT * FROM (VALUES ('both'), ('end'), ('none'), ('start')) v(mode))
SELECT mode, count(*) AS n, min(utc_time) AS lo, max(utc_time) AS hi
FROM obs, cases
WHERE qa_flag >= 'a'
  AND (CASE WHEN mode IN ('start', 'both') THEN utc_time > (SELECT min(utc_time) FROM obs)
            ELSE utc_time >= (SELECT min(utc_time) FROM obs) END)
  AND (CASE WHEN mode IN ('end', 'both') THEN utc_time < 1706572800 ELSE utc_time <= 1706572800 END)
GROUP BY mode""")
def ds_open_interval(t):
    obs = observations(t)
    start = obs.agg(F.min(F.timestamp_seconds("utc_time").cast("timestamp_ntz"))).first()[0]
    out = None
    for mode in (None, "start", "end", "both"):
        part = datastream_data(obs, qa_flag="a", start_datetime=start, end_datetime="2024-01-30 00:00:00",
                               open_interval=mode)
        part = part.agg(F.count("*").alias("n"), stamp(F.min("datetime_local")).alias("lo"),
                        stamp(F.max("datetime_local")).alias("hi")).select(F.lit(mode or "none").alias("mode"), "*")
        out = part if out is None else out.unionByName(part)
    return out


def _qa_case(name, flag, mode, op):
    sql = f"""
WITH {OBS_SQL}
SELECT datastream_id, utc_time AS datetime_local, {_value_sql()} AS data_value, qa_flag FROM obs
WHERE qa_flag {op} '{flag}'"""

    @query(name, sql)
    def run(t):
        return _flat(datastream_data(observations(t), qa_flag=flag, qa_flag_mode=mode))


_qa_case("ds_qa_ge", "f", "greater_or_eq", ">=")
_qa_case("ds_qa_le", "f", "less_or_eq", "<=")
_qa_case("ds_qa_eq", "d", "equal", "=")


def _down_case(name, interval, method, expression, flag="z", tz=DENVER, bucket=None):
    bucket = bucket or f"date_trunc('{interval}', l)"
    sql = f"""
WITH {OBS_SQL}, loc AS (SELECT *, {local_sql('utc_time', tz)} AS l FROM obs WHERE qa_flag >= '{flag}')
SELECT datastream_id, {sql_stamp(f'CAST({bucket} AS TIMESTAMP)')} AS truncated_datetime_local, {expression}
FROM loc GROUP BY 1, 2"""

    @query(name, sql)
    def run(t):
        return _flat(datastream_data(observations(t), tz=tz, qa_flag=flag, downsample_interval=interval,
                                     downsample_method=method, precision="full"))


_SIMPLE = {"mean": "avg", "sum": "sum", "stddev": "stddev_samp", "variance": "var_samp"}
for _method, _fn in _SIMPLE.items():
    _down_case(f"ds_down_{_method}", "day", _method, f"{sql_r4(f'{_fn}(data_value)')} AS data_value")
_down_case("ds_down_count", "day", "count", "count(data_value) AS data_value", flag="d")
for _interval in ("second", "minute", "hour", "week", "month", "year"):
    _down_case(f"ds_down_{_interval}", _interval, "mean", f"{sql_r4('avg(data_value)')} AS data_value")
_down_case("ds_down_seconds", 900, "sum", f"{sql_r4('sum(data_value)')} AS data_value", tz="UTC",
           bucket="to_timestamp(utc_time - utc_time % 900) AT TIME ZONE 'UTC'")

_MIN = (f"{sql_stamp('arg_min(l, (data_value, l))')} AS min_datetime_local, "
        f"{sql_r4('min(data_value)')} AS min_data_value")
_MAX = (f"{sql_stamp('arg_max(l, (data_value, -epoch_us(l)))')} AS max_datetime_local, "
        f"{sql_r4('max(data_value)')} AS max_data_value")
_down_case("ds_down_min", "day", "min", _MIN)
_down_case("ds_down_max", "day", "max", _MAX)
_down_case("ds_down_min_max", "day", "min_max", f"{_MIN}, {_MAX}")


@query("ds_down_max_nulls", f"""
WITH {OBS_SQL}, b AS (SELECT *, date_trunc('week', to_timestamp(utc_time) AT TIME ZONE 'UTC') AS w,
                             data_value IS NULL AS missing FROM obs WHERE qa_flag >= 'd'),
r AS (SELECT *, row_number() OVER (PARTITION BY datastream_id, w ORDER BY data_value DESC NULLS FIRST, utc_time) AS k
      FROM b)
SELECT datastream_id, {sql_stamp('CAST(w AS TIMESTAMP)')} AS truncated_datetime_local,
       utc_time AS max_datetime_local, {sql_r4('data_value')} AS max_data_value
FROM r WHERE k = 1""")
def ds_down_max_nulls(t):
    return _flat(datastream_data(observations(t), qa_flag="d", downsample_interval="week", downsample_method="max",
                                 precision="full", skip_null=False))


@query("ds_short_precision", """
WITH s AS (SELECT l_suppkey AS datastream_id, l_orderkey AS k,
                  l_extendedprice * l_discount / 7.0 AS v FROM lineitem)
SELECT datastream_id, k,
       CASE WHEN v = 0 THEN 0.0
            WHEN 9 - floor(log10(abs(v))) >= 0
            THEN round_even(v * pow(10.0, 9 - floor(log10(abs(v)))), 0) / pow(10.0, 9 - floor(log10(abs(v))))
            ELSE round_even(v / pow(10.0, floor(log10(abs(v))) - 9), 0) * pow(10.0, floor(log10(abs(v))) - 9)
       END AS data_value
FROM s""")
def ds_short_precision(t):
    s = t.lineitem.select(F.col("l_suppkey").alias("datastream_id"), F.col("l_orderkey").alias("k"),
                          (F.col("l_extendedprice") * F.col("l_discount") / 7.0).alias("data_value"))
    return q.with_precision(s)


@query("ds_multi_daily", f"""
WITH {OBS_SQL}, loc AS (SELECT *, {local_sql('utc_time', DENVER)} AS l FROM obs WHERE qa_flag >= 'z')
SELECT datastream_id, {sql_stamp("CAST(date_trunc('day', l) AS TIMESTAMP)")} AS truncated_datetime_local,
       {_MIN}, {_MAX}
FROM loc WHERE l >= TIMESTAMP '2024-01-01 00:00:00' AND l <= TIMESTAMP '2024-01-31 23:59:59.999999'
GROUP BY 1, 2""")
def ds_multi_daily(t):
    """Flagship: daily extremes of good values, Denver time, January."""
    return _flat(datastream_data(observations(t), tz=DENVER, start_date="2024-01-01", end_date="2024-01-31",
                                 downsample_interval="day", downsample_method="min_max"))
