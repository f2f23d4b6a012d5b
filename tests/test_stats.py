import datetime as dt
import math
import statistics

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sensorlake.functions import geo
from sensorlake.functions.buckets import bucket_start, mid_bin
from sensorlake.operators import stats

NAN = float("nan")


def series(spark, rows):
    return spark.createDataFrame([(1, dt.datetime.fromisoformat(t), v) for t, v in rows], "id long, ts timestamp_ntz, v double")


def run(spark, rows, count, unit, op, **more):
    out = stats.resample(series(spark, rows), "ts", "v", count, unit, op, ["id"], **more).orderBy("ts").collect()
    return [(r.ts.isoformat(sep=" "), r.v) for r in out]


HOURS = [("2024-02-28 22:00:00", 1.0), ("2024-02-29 01:00:00", 5.0), ("2024-02-29 02:00:00", 3.0), ("2024-03-01 00:00:00", NAN), ("2024-03-09 00:00:00", 8.0)]


def test_daily_statistics_use_the_middle_of_the_bin(spark):
    got = run(spark, HOURS, 1, "D", "mean")
    assert got[:2] == [("2024-02-28 12:00:00", 1.0), ("2024-02-29 12:00:00", 4.0)]
    assert got[2][0] == "2024-03-01 12:00:00" and math.isnan(got[2][1])
    assert len(got) == 4


def test_picked_values_keep_their_time(spark):
    assert run(spark, HOURS, 1, "MS", "max") == [("2024-02-29 01:00:00", 5.0), ("2024-03-09 00:00:00", 8.0)]
    assert run(spark, HOURS, 1, "MS", "first")[0] == ("2024-02-28 22:00:00", 1.0)
    assert math.isnan(run(spark, HOURS, 1, "MS", "first")[1][1])
    assert run(spark, HOURS, 1, "MS", "last") == [("2024-02-29 02:00:00", 3.0), ("2024-03-09 00:00:00", 8.0)]


def test_infinite_results_are_dropped(spark):
    assert run(spark, [("2024-01-01 00:00:00", float("inf")), ("2024-01-02 00:00:00", 1.0)], 1, "D", "max") == [("2024-01-02 00:00:00", 1.0)]


def test_single_value_has_no_spread(spark):
    assert math.isnan(run(spark, [("2024-01-01 00:00:00", 1.0)], 1, "D", "stdev")[0][1])


def test_multi_day_bins_and_anchor(spark):
    rows = [("2024-01-03 06:00:00", 1.0), ("2024-01-04 12:00:00", 2.0), ("2024-01-05 03:00:00", 3.0)]
    assert run(spark, rows, 2, "D", "mean") == [("2024-01-04 00:00:00", 1.5), ("2024-01-06 00:00:00", 3.0)]
    assert run(spark, rows, 2, "D", "mean", anchor="first") == [("2024-01-04 06:00:00", 2.0)]


def test_water_year_and_leap_year(spark):
    rows = [("2023-09-30 23:00:00", 1.0), ("2023-10-01 00:00:00", 2.0)]
    assert run(spark, rows, 1, "AS-OCT", "mean") == [("2023-04-01 12:00:00", 1.0), ("2024-04-01 00:00:00", 2.0)]


def test_week_middle_is_thursday_noon(spark):
    assert run(spark, [("2024-01-07 23:00:00", 1.0), ("2024-01-08 00:00:00", 2.0)], 1, "W", "mean") == [("2024-01-04 12:00:00", 1.0), ("2024-01-11 12:00:00", 2.0)]


def test_two_month_bins(spark):
    rows = [("2024-01-31 00:00:00", 1.0), ("2024-02-01 00:00:00", 3.0), ("2024-03-01 00:00:00", 5.0)]
    assert [v for _, v in run(spark, rows, 2, "MS", "mean")] == [2.0, 5.0]


def test_mode_takes_the_first_seen(spark):
    rows = [("2024-01-01 00:00:00", 2.0), ("2024-01-01 01:00:00", 1.0), ("2024-01-01 02:00:00", 1.0), ("2024-01-01 03:00:00", 2.0)]
    assert run(spark, rows, 1, "D", "mode") == [("2024-01-01 12:00:00", statistics.mode([v for _, v in rows]))]
    assert math.isnan(stats.mode_first_seen(series(spark, rows).withColumn("v", F.lit(None).cast("double")), ["id"], "v", "ts").first().v)


def test_bad_arguments(spark):
    with pytest.raises(ValueError):
        run(spark, HOURS, 1, "D", "sum")
    with pytest.raises(ValueError):
        run(spark, HOURS, 0, "D", "mean")
    with pytest.raises(ValueError):
        run(spark, HOURS, 1, "D", "mean", anchor="noon")


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abc"), st.floats(-1e9, 1e9) | st.integers(-3, 3).map(float)), min_size=1, max_size=120))
def test_sliced_median_equals_the_plain_one(spark, rows):
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r.v for r in stats.sliced_median(df, ["k"], "v").collect()}
    for k in {r[0] for r in rows}:
        assert math.isclose(got[k], statistics.median(v for a, v in rows if a == k), rel_tol=1e-12, abs_tol=1e-12)


def test_median_of_a_dominant_group(spark):
    df = spark.range(40_000).select(F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(F.lit(-1)).alias("k"), (F.sin("id") * 1000).alias("v"))
    got = {r.k: r.v for r in stats.exact_median(df, ["k"], "v").collect()}
    want = {r.k: r.v for r in df.groupBy("k").agg(F.median("v").alias("v")).collect()}
    assert got == want


def test_median_and_mode_of_odd_values(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", math.inf), ("b", -math.inf), ("b", 3.0), ("b", math.nan)], "k string, v double")
    got = {r.k: r.v for r in stats.exact_median(df, ["k"], "v").collect()}
    assert got == {"a": 2.0, "b": -math.inf}
    hours = spark.sql("SELECT 1 AS k, TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, id) AS t, if(id < 2, double('NaN'), 4D) AS v FROM range(3)")
    assert stats.resample(hours, "t", "v", 1, "D", "mode", ["k"]).first().v == 4.0


def test_two_week_bins_end_with_the_first_week(spark):
    days = spark.sql("SELECT 1 AS k, TIMESTAMP_NTZ '2024-01-10 00:00:00' + make_interval(0, 0, 0, id * 7) AS t, double(id + 1) AS v FROM range(4)")
    assert [r.v for r in stats.resample(days, "t", "v", 2, "W", "mean", ["k"]).orderBy("t").collect()] == [1.0, 2.5, 4.0]


def test_buckets(spark):
    row = spark.sql("SELECT TIMESTAMP_NTZ '1969-12-31 23:59:59.5' AS t")
    assert row.select(bucket_start(F.col("t"), 900).alias("b")).first().b == dt.datetime(1969, 12, 31, 23, 45)
    assert row.select(bucket_start(F.col("t"), "second").alias("b")).first().b == dt.datetime(1969, 12, 31, 23, 59, 59)
    assert row.select(mid_bin(F.lit("2024-02-01").cast("timestamp_ntz"), 1, "MS").alias("b")).first().b == dt.datetime(2024, 2, 15, 12)
    with pytest.raises(ValueError):
        bucket_start(F.col("t"), 0)


def test_geometry(spark):
    row = spark.range(1).select(geo.great_circle_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0)).alias("half"),
                                *[c.alias(n) for c, n in zip(geo.degree_length_km(F.lit(0.0)), ("lat", "lon"))]).first()
    assert math.isclose(row.half, math.pi * 6371)
    assert math.isclose(row.lon, math.radians(1) * 6378.137) and math.isclose(row.lat, (111132.954 - 559.822 + 1.175) / 1000)
    points = spark.createDataFrame([(0.0, 10.0), (0.0, 20.0)], "lat double, lon double")
    c = points.agg(geo.centroid(F.col("lat"), F.col("lon")).alias("c")).first().c
    assert math.isclose(c.lon, 15.0) and abs(c.lat) < 1e-9


def test_phase_difference(spark):
    t = np.linspace(0, 2 * np.pi, 100, endpoint=False)
    a, b = np.exp(1j * t), np.exp(1j * (t - 0.5))
    df = spark.createDataFrame([(float(x.real), float(x.imag), float(y.real), float(y.imag)) for x, y in zip(a, b)], "a double, b double, c double, d double")
    p = df.agg(geo.phase_difference(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("p")).first().p
    assert math.isclose(p.phase_rad, 0.5) and math.isclose(p.phase_deg, math.degrees(0.5))
