import datetime as dt
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sensorlake.functions.numbers import short_precision
from sensorlake.operators import query as q
from sensorlake.plans.datastream_query import datastream_data

DAY0 = 1704067200  # 2024-01-01 UTC


def obs(spark, rows):
    return spark.createDataFrame(rows, "datastream_id long, utc_time long, data_value double, qa_flag string")


def test_default_keeps_good_only_and_date_end_is_inclusive(spark):
    df = obs(spark, [(1, DAY0, 1.0, "z"), (1, DAY0 + 86399, 2.0, "z"), (1, DAY0 + 86400, 3.0, "z"), (1, DAY0 + 5, 4.0, "f")])
    out = datastream_data(df, start_date="2024-01-01", end_date="2024-01-01").collect()
    assert sorted(r.data_value for r in out) == [1.0, 2.0]


@pytest.mark.parametrize("mode, expected", [(None, 3), ("start", 2), ("end", 2), ("both", 1)])
def test_open_interval(spark, mode, expected):
    df = obs(spark, [(1, DAY0 + i * 60, 1.0, "z") for i in range(3)])
    out = datastream_data(df, start_datetime="2024-01-01T00:00:00", end_datetime="2024-01-01T00:02:00", open_interval=mode)
    assert out.count() == expected


def test_conflicting_options(spark):
    df = obs(spark, [])
    with pytest.raises(ValueError):
        datastream_data(df, start_date="2024-01-01", start_datetime="2024-01-01T00:00:00")
    with pytest.raises(ValueError):
        datastream_data(df, downsample_interval="day")
    with pytest.raises(ValueError):
        datastream_data(df, downsample_interval="fortnight", downsample_method="mean")
    with pytest.raises(ValueError):
        datastream_data(df, qa_flag="zz")
    with pytest.raises(ValueError):
        datastream_data(df, downsample_interval="day", downsample_method="middle")


def test_ties_take_the_earliest_time(spark):
    df = obs(spark, [(1, DAY0 + 30, 5.0, "z"), (1, DAY0 + 10, 5.0, "z"), (1, DAY0 + 20, 1.0, "z"), (1, DAY0 + 5, 5.0, "f"), (1, DAY0 + 40, 1.0, "z")])
    row = datastream_data(df, downsample_interval="day", downsample_method="min_max").first()
    assert row.min_datetime_local == dt.datetime(2024, 1, 1, 0, 0, 20)
    assert row.max_datetime_local == dt.datetime(2024, 1, 1, 0, 0, 10)
    assert (row.min_data_value, row.max_data_value) == (1.0, 5.0)


def test_null_rule_of_max(spark):
    df = obs(spark, [(1, DAY0, 9.0, "z"), (1, DAY0 + 7, None, "d"), (1, DAY0 + 9, None, "d")])
    skip = datastream_data(df, qa_flag="a", downsample_interval="day", downsample_method="max").first()
    assert skip.max_data_value == 9.0
    first = datastream_data(df, qa_flag="a", downsample_interval="day", downsample_method="max", skip_null=False).first()
    assert (first.max_data_value, first.max_datetime_local) == (None, dt.datetime(2024, 1, 1, 0, 0, 7))
    low = datastream_data(df, qa_flag="a", downsample_interval="day", downsample_method="min", skip_null=False).first()
    assert low.min_data_value == 9.0


def test_spread_of_one_reading_is_null(spark):
    row = datastream_data(obs(spark, [(1, DAY0, 9.0, "z")]), downsample_interval="hour", downsample_method="stddev").first()
    assert row.data_value is None


def test_local_day_in_denver(spark):
    row = datastream_data(obs(spark, [(1, DAY0, 9.0, "z")]), tz="America/Denver", downsample_interval="day", downsample_method="count").first()
    assert row.truncated_datetime_local == dt.datetime(2023, 12, 31)


def test_week_starts_on_monday(spark):
    row = datastream_data(obs(spark, [(1, DAY0 + 6 * 86400, 9.0, "z")]), downsample_interval="week", downsample_method="sum").first()
    assert row.truncated_datetime_local == dt.datetime(2024, 1, 1)


def test_short_precision(spark):
    numbers = [0.0, 1.0 / 3, -123456.789012345, 1.5e300, 2.5e-300, 25.599999999999998, float("inf"), None]
    df = spark.createDataFrame([(n,) for n in numbers], "v double")
    got = [r[0] for r in df.select(short_precision(F.col("v"))).collect()]
    want = [n if n is None or math.isinf(n) else float(f"{n:.10g}") for n in numbers]
    assert all(a == b or math.isclose(a, b, rel_tol=1e-15) for a, b in zip(got, want) if a is not None) and got[-1] is None
    assert math.isnan(spark.range(1).select(short_precision(F.lit(float("nan")))).first()[0])


def test_lookup_of_unknown_stream(spark):
    registry = spark.createDataFrame([(1, "a")], "datastream_id long, datastream_tablename string")
    df = obs(spark, [(1, DAY0, 9.0, "z"), (2, DAY0, 9.0, "z")])
    assert q.select_datastreams(df, registry, datastream_tablename="a").count() == 1
    with pytest.raises(LookupError):
        q.select_datastreams(df, registry, datastream_id=7)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 3), st.integers(0, 10 ** 7), st.floats(-1e6, 1e6), st.sampled_from("afz")), min_size=1, max_size=60))
def test_bucket_counts_add_up(spark, rows):
    df = obs(spark, [(a, DAY0 + b, c, d) for a, b, c, d in rows])
    total = datastream_data(df, qa_flag="f", downsample_interval="week", downsample_method="count").agg(F.sum("data_value")).first()[0] or 0
    assert total == sum(1 for r in rows if r[3] >= "f")


def test_plan_pushes_filters_and_prunes_columns(spark, tmp_path, capsys):
    path = str(tmp_path / "obs")
    obs(spark, [(i % 3, DAY0 + i * 3600, float(i), "z") for i in range(500)]).withColumn("note", F.lit("x")).write.parquet(path)
    out = datastream_data(spark.read.parquet(path), start_date="2024-01-02", end_date="2024-01-03", downsample_interval="day", downsample_method="min_max")
    out.explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(utc_time" in plan and "GreaterThanOrEqual(qa_flag,z)" in plan
    assert "note" not in plan
    assert plan.count("Arguments: hashpartitioning") == 1
    assert "Python" not in plan
