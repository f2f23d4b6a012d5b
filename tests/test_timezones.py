import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sensorlake.functions import timezones as tz
from sensorlake.operators.process import local_to_epoch


def stamps(spark, *texts, **more):
    rows = [(i, "s", t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "seq int, stream string, text string").withColumn("ts", F.to_timestamp_ntz("text"))


@pytest.mark.parametrize("name, expected", [
    ("UTC+7", "-07:00"), ("UTC-5", "+05:00"), ("GMT+05:30", "-05:30"), ("PST", "-08:00"), ("MDT", "-06:00"), ("utc", "UTC"),
    ("America/Denver", "America/Denver"), ("UTC+0", "UTC")])
def test_zone_names(name, expected):
    assert tz.normalize_tz(name) == expected


def test_abbreviation_is_a_fixed_offset_in_summer(spark):
    row = spark.range(1).select(tz.epoch_to_local(F.lit(1689422400), "PST").alias("t")).first()
    assert row.t == dt.datetime(2023, 7, 15, 4, 0)


def test_repeated_hour_follows_reading_order(spark):
    df = stamps(spark, "2023-11-05 00:30:00", "2023-11-05 01:00:00", "2023-11-05 01:30:00", "2023-11-05 01:00:00",
                "2023-11-05 01:30:00", "2023-11-05 02:00:00")
    out = local_to_epoch(df, "ts", "America/Denver", ["stream"], ["seq"]).orderBy("seq").collect()
    assert [r.dst_status for r in out] == ["plain", "first_pass", "first_pass", "second_pass", "second_pass", "plain"]
    steps = [b.utc_time - a.utc_time for a, b in zip(out, out[1:])]
    assert steps == [1800] * 5


def test_single_pass_of_the_repeated_hour_stays_first(spark):
    out = local_to_epoch(stamps(spark, "2023-11-05 01:15:00"), "ts", "America/Denver", ["stream"], ["seq"]).first()
    assert (out.dst_status, out.utc_time) == ("first_pass", 1699168500)


def test_skipped_hour_is_rejected(spark):
    df = stamps(spark, "2023-03-12 01:59:59", "2023-03-12 02:30:00", "2023-03-12 03:00:00")
    out = local_to_epoch(df, "ts", "America/Denver", ["stream"], ["seq"]).orderBy("seq").collect()
    assert [(r.dst_status, r.utc_time is None) for r in out] == [("plain", False), ("gap", True), ("plain", False)]
    assert out[2].utc_time - out[0].utc_time == 1


def test_half_hour_zone(spark):
    df = stamps(spark, "2023-04-02 01:15:00", "2023-04-02 01:45:00", "2023-04-02 01:45:00", "2023-04-02 01:40:00")
    out = local_to_epoch(df, "ts", "Australia/Lord_Howe", ["stream"], ["seq"]).orderBy("seq").collect()
    assert [r.dst_status for r in out] == ["plain", "first_pass", "first_pass", "second_pass"]
    assert out[3].utc_time - out[2].utc_time == 25 * 60


def test_zone_per_row(spark):
    df = spark.createDataFrame([("America/Denver",), ("Asia/Kolkata",)], "zone string").withColumn("ts", F.to_timestamp_ntz(F.lit("2024-01-01 12:00:00")))
    out = {r.zone: r.e for r in df.select("zone", tz.ntz_to_epoch(tz.local_to_utc(F.col("ts"), F.col("zone"))).alias("e")).collect()}
    assert out["America/Denver"] - out["Asia/Kolkata"] == int(12.5 * 3600)


def test_label_offset(spark, values):
    df = spark.createDataFrame([("EST",), ("Mountain Standard Time",), ("nowhere",), (None,)], "label string")
    assert values(df.select("label", tz.label_offset(F.col("label")))) == sorted(
        [("EST", -4), ("Mountain Standard Time", -7), ("nowhere", 0), (None, 0)], key=repr)


def test_unknown_zone_is_an_error(spark):
    with pytest.raises(PySparkException):
        spark.range(1).select(tz.epoch_to_local(F.lit(0), "Nowhere/City")).collect()
