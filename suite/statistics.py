"""Resampling and geometry checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorlake.functions import geo
from sensorlake.operators import stats
from suite.registry import query, r4, sql_r4, sql_stamp, stamp
from suite.views import OBS_SQL, SERIES_SQL, local_series, observations

_MID = "CAST(epoch_us(b) // 1000000 AS BIGINT) + {half}"


def _series_case(name, count, unit, op, bin_sql, mid_sql, value_sql):
    sql = f"""
WITH {SERIES_SQL}, binned AS (SELECT *, CAST({bin_sql} AS TIMESTAMP) AS b FROM series)
SELECT datastream_id, {mid_sql} AS ts, {value_sql} AS value FROM binned GROUP BY datastream_id, b"""

    @query(name, sql)
    def run(t):
        df = local_series(t).withColumn("value", F.col("price"))
        return stats.resample(df, "ts", "value", count, unit, op, ["datastream_id"]).select(
            "datastream_id", stamp(F.col("ts")).alias("ts"), r4(F.col("value")).alias("value"))


_DAY, _MONTH = "date_trunc('day', ts)", "date_trunc('month', ts)"
_HALF_MONTH = "CAST(epoch_us(b) // 1000000 AS BIGINT) + CAST(date_diff('day', b, b + INTERVAL 1 MONTH) AS BIGINT) * 43200"
_series_case("resample_mean", 1, "MS", "mean", _MONTH, _HALF_MONTH, sql_r4("avg(price)"))
_series_case("resample_median", 1, "MS", "median", _MONTH, _HALF_MONTH, sql_r4("median(price)"))
_series_case("resample_stdev", 1, "MS", "stdev", _MONTH, _HALF_MONTH, sql_r4("stddev_samp(price)"))
_series_case("resample_weekly", 1, "W", "mean", "date_trunc('week', ts)", _MID.format(half="302400"), sql_r4("avg(price)"))
# The first two-week bin ends with the week of the stream's first day.
_FIRST_WEEK = "date_trunc('week', min(ts) OVER (PARTITION BY datastream_id)) - INTERVAL 7 DAY"
_series_case("resample_two_weeks", 2, "W", "mean",
             f"{_FIRST_WEEK} + CAST(floor(date_diff('day', {_FIRST_WEEK}, date_trunc('day', ts)) / 14) AS INTEGER) * INTERVAL 14 DAY",
             _MID.format(half="604800"), sql_r4("avg(price)"))
_series_case("resample_mid_bin", 12, "H", "mean",
             "date_trunc('day', ts) + CAST(date_part('hour', ts) // 12 AS INTEGER) * INTERVAL 12 HOUR",
             _MID.format(half="21600"), sql_r4("avg(price)"))
_HALF_YEAR = "CAST(epoch_us(b) // 1000000 AS BIGINT) + CAST(date_diff('day', b, b + INTERVAL 1 YEAR) AS BIGINT) * 43200"
_series_case("resample_water_year", 1, "AS-OCT", "mean",
             "date_trunc('year', ts + INTERVAL 3 MONTH) - INTERVAL 3 MONTH", _HALF_YEAR, sql_r4("avg(price)"))
_series_case("resample_year", 1, "AS", "mean", "date_trunc('year', ts)", _HALF_YEAR, sql_r4("avg(price)"))


def _pick_case(name, op, order):
    sql = f"""
WITH {SERIES_SQL}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY datastream_id, date_trunc('month', ts) ORDER BY {order}) AS k FROM series)
SELECT datastream_id, {sql_stamp('ts')} AS ts, {sql_r4('value')} AS value FROM ranked WHERE k = 1"""

    @query(name, sql)
    def run(t):
        return stats.resample(local_series(t), "ts", "value", 1, "MS", op, ["datastream_id"]).select(
            "datastream_id", stamp(F.col("ts")).alias("ts"), r4(F.col("value")).alias("value"))


_pick_case("resample_min", "min", "value, ts")
_pick_case("resample_max", "max", "value DESC, ts")
_pick_case("resample_first", "first", "ts, value")
_pick_case("resample_last", "last", "ts DESC, value")


@query("resample_pick_row", f"""
WITH {SERIES_SQL}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY datastream_id, date_trunc('year', ts)
                               ORDER BY price DESC, ts, value, row_key) AS k FROM series)
SELECT datastream_id, {sql_stamp('ts')} AS ts, {sql_r4('price')} AS price, value, row_key FROM ranked WHERE k = 1""")
def resample_pick_row(t):
    out = stats.resample(local_series(t), "ts", "price", 1, "AS", "max", ["datastream_id"], keep_row=True)
    return out.select("datastream_id", stamp(F.col("ts")).alias("ts"), r4(F.col("price")).alias("price"), "value", "row_key")


_MODE_SQL = """
, counts AS (SELECT datastream_id, b, value, count(*) AS n, min(ts) AS seen FROM binned GROUP BY 1, 2, 3),
ranked AS (SELECT *, row_number() OVER (PARTITION BY datastream_id, b ORDER BY n DESC, seen, value) AS k FROM counts)"""


@query("resample_mode", f"""
WITH {SERIES_SQL}, binned AS (SELECT *, date_trunc('month', ts) AS b FROM series){_MODE_SQL}
SELECT datastream_id, {_HALF_MONTH.replace('(b)', '(CAST(b AS TIMESTAMP))')} AS ts, value FROM ranked WHERE k = 1""")
def resample_mode(t):
    return stats.resample(local_series(t), "ts", "value", 1, "MS", "mode", ["datastream_id"]).select(
        "datastream_id", stamp(F.col("ts")).alias("ts"), "value")


@query("mode_first_seen", f"""
WITH {SERIES_SQL}, binned AS (SELECT *, 0 AS b FROM series){_MODE_SQL}
SELECT datastream_id, value FROM ranked WHERE k = 1""")
def mode_first_seen(t):
    return stats.mode_first_seen(local_series(t), ["datastream_id"], "value", "ts")


def _anchor_sql(origin):
    return f"""
WITH {SERIES_SQL}, firsts AS (SELECT datastream_id, {origin} AS a FROM series GROUP BY 1),
binned AS (
  SELECT s.*, CAST(epoch_us(a) // 1000000 AS BIGINT)
              + CAST(floor((epoch_us(ts) - epoch_us(a)) / 1000000 / (10 * 86400)) AS BIGINT) * 864000 AS b
  FROM series s JOIN firsts f ON s.datastream_id = f.datastream_id)
SELECT datastream_id, b + 432000 AS ts, {sql_r4('avg(value)')} AS value FROM binned GROUP BY datastream_id, b"""


def _anchor_case(name, anchor, origin):
    @query(name, _anchor_sql(origin))
    def run(t):
        return stats.resample(local_series(t), "ts", "value", 10, "D", "mean", ["datastream_id"], anchor).select(
            "datastream_id", stamp(F.col("ts")).alias("ts"), r4(F.col("value")).alias("value"))


_anchor_case("resample_anchor_first", "first", "min(ts)")
_anchor_case("resample_anchor_day", "day", "CAST(date_trunc('day', min(ts)) AS TIMESTAMP)")


@query("resample_nan", f"""
WITH {OBS_SQL}, b AS (SELECT *, date_trunc('day', to_timestamp(utc_time) AT TIME ZONE 'UTC') AS d FROM obs)
SELECT datastream_id, {sql_stamp('CAST(d AS TIMESTAMP)')} + 43200 AS ts,
       coalesce({sql_r4('avg(CASE WHEN NOT isnan(data_value) THEN data_value END)')}, -1.0) AS value
FROM b GROUP BY datastream_id, d""")
def resample_nan(t):
    df = observations(t).withColumn("ts", F.timestamp_seconds("utc_time").cast("timestamp_ntz"))
    out = stats.resample(df, "ts", "data_value", 1, "D", "mean", ["datastream_id"])
    return out.select("datastream_id", stamp(F.col("ts")).alias("ts"),
                      r4(F.nanvl("data_value", F.lit(-1.0))).alias("value"))


@query("phase_difference", f"""
WITH s AS (SELECT l_suppkey AS datastream_id, l_quantity AS re1, l_discount AS im1, l_tax AS re2, l_quantity / 50.0 AS im2
           FROM lineitem),
a AS (SELECT datastream_id, atan2(sum(im1 * re2 - re1 * im2), sum(re1 * re2 + im1 * im2)) AS p FROM s GROUP BY 1)
SELECT datastream_id, {sql_r4('p')} AS phase_rad, {sql_r4('p / pi()')} AS phase_rad_pi, {sql_r4('degrees(p)')} AS phase_deg
FROM a""")
def phase_difference(t):
    li = t.lineitem
    p = geo.phase_difference(li.l_quantity, li.l_discount, li.l_tax, li.l_quantity / 50.0)
    out = li.groupBy(F.col("l_suppkey").alias("datastream_id")).agg(p.alias("p"))
    return out.select("datastream_id", *[r4(F.col(f"p.{c}")).alias(c) for c in ("phase_rad", "phase_rad_pi", "phase_deg")])


def sites(t):
    """Customers as sites with coordinates derived from their key and balance."""
    lat = F.col("c_acctbal") / 150.0
    lon = F.pmod(F.col("c_custkey") * 7, F.lit(360)) - 180.0
    return t.customer.select("c_custkey", "c_nationkey", lat.alias("lat"), lon.alias("lon"))


SITES_SQL = """
sites AS (SELECT c_custkey, c_nationkey, c_acctbal / 150.0 AS lat,
                 ((c_custkey * 7) % 360) - 180.0 AS lon FROM customer)"""


@query("degree_length", f"""
WITH {SITES_SQL}
SELECT c_custkey,
  {sql_r4('(111132.954 - 559.822 * cos(radians(lat) * 2) + 1.175 * cos(radians(lat) * 4)) / 1000')} AS lat_km,
  {sql_r4('radians(CAST(1 AS DOUBLE)) * 6378.137 * cos(atan((6356.752 / 6378.137) * tan(radians(lat))))')} AS lon_km
FROM sites""")
def degree_length(t):
    lat_km, lon_km = geo.degree_length_km(F.col("lat"))
    return sites(t).select("c_custkey", r4(lat_km).alias("lat_km"), r4(lon_km).alias("lon_km"))


@query("haversine_pairs", f"""
WITH {SITES_SQL}, hub AS (SELECT s_suppkey, s_nationkey, s_acctbal / 150.0 AS hlat, s_suppkey % 180 - 90.0 AS hlon FROM supplier),
near AS (SELECT o_orderkey, lat, lon, s_suppkey, hlat, hlon,
           sin((radians(hlat) - radians(lat)) / 2) AS a, sin((radians(hlon) - radians(lon)) / 2) AS b
         FROM orders JOIN sites ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey
         JOIN hub ON l_suppkey = s_suppkey)
SELECT o_orderkey, s_suppkey, count(*) AS n,
       {sql_r4('max(2 * 6371.0 * asin(least(1.0, sqrt(a * a + cos(radians(lat)) * cos(radians(hlat)) * b * b))))')} AS km
FROM near GROUP BY 1, 2""")
def haversine_pairs(t):
    hub = t.supplier.select("s_suppkey", (F.col("s_acctbal") / 150.0).alias("hlat"),
                            (F.pmod(F.col("s_suppkey"), F.lit(180)) - 90.0).alias("hlon"))
    pairs = (t.lineitem.select("l_orderkey", "l_suppkey").join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
             .join(sites(t), F.col("o_custkey") == F.col("c_custkey"))
             .join(hub, F.col("l_suppkey") == F.col("s_suppkey")))
    km = geo.great_circle_km(F.col("lat"), F.col("lon"), F.col("hlat"), F.col("hlon"))
    return pairs.groupBy("o_orderkey", "s_suppkey").agg(F.count("*").alias("n"), r4(F.max(km)).alias("km"))


@query("geo_centroid", f"""
WITH {SITES_SQL}, xyz AS (
  SELECT c_nationkey, avg(cos(radians(lat)) * cos(radians(lon))) AS x, avg(cos(radians(lat)) * sin(radians(lon))) AS y,
         avg(sin(radians(lat))) AS z FROM sites GROUP BY 1)
SELECT c_nationkey, {sql_r4('degrees(atan2(z, sqrt(x * x + y * y)))')} AS lat, {sql_r4('degrees(atan2(y, x))')} AS lon FROM xyz""")
def geo_centroid(t):
    c = geo.centroid(F.col("lat"), F.col("lon"))
    return sites(t).groupBy("c_nationkey").agg(c.alias("c")).select(
        "c_nationkey", r4(F.col("c.lat")).alias("lat"), r4(F.col("c.lon")).alias("lon"))
