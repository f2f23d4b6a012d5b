"""Stored tables: loads against marks, late rows, pruned reads, merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorlake.functions.flags import auto_flag
from sensorlake.functions.timezones import ntz_to_epoch
from sensorlake.operators import checks
from sensorlake.operators.process import good_summary
from sensorlake.plans.datastream_query import stored_data
from sensorlake.session import scratch_path
from sensorlake.sources import store
from sensorlake.streaming.downsample import bucket_layout, downsample_into, read_observations
from suite.datastreams import DENVER, _flat
from suite.registry import query, r4, sql_r4, sql_stamp, stamp
from suite.views import OBS_SQL, SERIES_SQL, local_series, local_sql, observations, raw_values, upper_bound

_CUT = 1705276800
#: One reading per stream and time: the one of the first event.
_ONE_SQL = f"{OBS_SQL}, one AS (SELECT DISTINCT ON (datastream_id, utc_time) * FROM obs ORDER BY datastream_id, utc_time, event_id)"
_VALUE = sql_r4("CASE WHEN NOT isnan(data_value) THEN data_value END")


def _one(t):
    value = raw_values()
    obs = t.events.select("event_id", F.col("user_id").alias("datastream_id"), ntz_to_epoch(F.col("ts")).alias("utc_time"), value.alias("data_value"),
                          auto_flag(value, F.lit(0.5), upper_bound()).alias("qa_flag"))
    first = F.min(F.struct("event_id", "data_value", "qa_flag")).alias("r")
    return obs.groupBy("datastream_id", "utc_time").agg(first).select("datastream_id", "utc_time", "r.data_value", "r.qa_flag", "r.event_id")


_HALVES_SQL = f"""{_ONE_SQL},
half AS (SELECT * FROM one WHERE utc_time < {_CUT} + datastream_id * 3600 AND event_id % 10 <> 0),
marks AS (SELECT datastream_id, max(utc_time) AS last FROM half GROUP BY 1),
again AS (SELECT datastream_id, utc_time, CASE WHEN event_id % 15 = 0 THEN data_value + 1 ELSE data_value END AS data_value, qa_flag,
                 utc_time <= coalesce(last, -1) AS late FROM one LEFT JOIN marks USING (datastream_id) WHERE event_id % 7 <> 0),
stats AS (SELECT count(*) AS rows_read, count(*) FILTER (NOT late) AS rows_new, count(*) FILTER (late) AS rows_late FROM again)"""


def _load_twice(t, late):
    """Half of the readings with gaps, then a second delivery of most of them: newer ones, late ones, changed ones and some as before."""
    layout = store.observation_layout(scratch_path(t.spark, "observations"), 16)
    columns = ["datastream_id", "utc_time", "data_value", "qa_flag"]
    one = _one(t)
    store.load(one.filter((F.col("utc_time") < _CUT + F.col("datastream_id") * 3600) & (F.col("event_id") % 10 != 0)).select(*columns), layout)
    changed = F.when(F.col("event_id") % 15 == 0, F.col("data_value") + 1).otherwise(F.col("data_value"))
    done = store.load(one.filter("event_id % 7 <> 0").withColumn("data_value", changed).select(*columns), layout, late)
    return store.read(t.spark, layout).select(
        "datastream_id", "utc_time", r4(F.col("data_value")).alias("data_value"), "qa_flag",
        *(F.lit(getattr(done, n)).cast("bigint").alias(n) for n in ("rows_read", "rows_new", "rows_late")))


@query("load_late", f"""
WITH {_HALVES_SQL}
SELECT coalesce(a.datastream_id, h.datastream_id) AS datastream_id, coalesce(a.utc_time, h.utc_time) AS utc_time,
  CASE WHEN a.utc_time IS NULL THEN {_VALUE.replace("data_value", "h.data_value")} ELSE {_VALUE.replace("data_value", "a.data_value")} END AS data_value,
  CASE WHEN a.utc_time IS NULL THEN h.qa_flag ELSE a.qa_flag END AS qa_flag, rows_read, rows_new, rows_late
FROM half h FULL JOIN again a ON h.datastream_id = a.datastream_id AND h.utc_time = a.utc_time, stats""")
def load_late(t):
    return _load_twice(t, "upsert")


@query("load_late_dropped", f"""
WITH {_HALVES_SQL}
SELECT datastream_id, utc_time, {_VALUE} AS data_value, qa_flag, rows_read, rows_new, rows_late
FROM (SELECT datastream_id, utc_time, data_value, qa_flag FROM half UNION ALL SELECT datastream_id, utc_time, data_value, qa_flag FROM again WHERE NOT late), stats""")
def load_late_dropped(t):
    return _load_twice(t, "drop")


@query("load_marks", f"""
WITH {_HALVES_SQL}
SELECT datastream_id, max(utc_time) AS last FROM (SELECT datastream_id, utc_time FROM half UNION ALL SELECT datastream_id, utc_time FROM again) GROUP BY 1""")
def load_marks(t):
    """The marks after two loads; they never saw the stored rows."""
    layout = store.observation_layout(scratch_path(t.spark, "observations"), 16)
    one = _one(t)
    store.load(one.filter((F.col("utc_time") < _CUT + F.col("datastream_id") * 3600) & (F.col("event_id") % 10 != 0)).drop("event_id"), layout)
    store.load(one.filter("event_id % 7 <> 0").drop("event_id"), layout)
    return store.marks(t.spark, layout)


def _stored(t, rows, buckets=16):
    layout = store.observation_layout(scratch_path(t.spark, "observations"), buckets)
    store.load(rows, layout)
    return layout


@query("ds_lookup", f"""
WITH {OBS_SQL}
SELECT datastream_id, {sql_stamp(local_sql('utc_time', DENVER))} AS datetime_local, {_VALUE} AS data_value, qa_flag
FROM obs WHERE datastream_id % 10 = 3 AND qa_flag >= 'z'""")
def ds_lookup(t):
    """Streams of a piece of equipment from a stored table: only their buckets are read."""
    layout = _stored(t, observations(t))
    registry = t.events.select(F.col("user_id").alias("datastream_id")).distinct().select(
        "datastream_id", F.concat(F.lit("stream_"), F.col("datastream_id").cast("string")).alias("datastream_tablename"), (F.col("datastream_id") % 10).alias("equipment_id"))
    return _flat(stored_data(t.spark, layout, registry, {"equipment_id": 3}, tz=DENVER))


@query("ds_pruned", f"""
WITH {SERIES_SQL}, utc AS (SELECT datastream_id, value, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS utc_time FROM series WHERE datastream_id % 5 = 2),
loc AS (SELECT *, {local_sql('utc_time', DENVER)} AS l FROM utc)
SELECT datastream_id, {sql_stamp("date_trunc('day', l)")} AS truncated_datetime_local, {sql_r4('avg(value)')} AS data_value
FROM loc WHERE l >= TIMESTAMP '1995-12-20 00:00:00' AND l <= TIMESTAMP '1996-02-10 23:59:59.999999' GROUP BY ALL""")
def ds_pruned(t):
    """A local range over a new year's night from years of readings, by stream: cells of two years and a few buckets are read."""
    series = local_series(t)
    layout = _stored(t, series.select("datastream_id", ntz_to_epoch(F.col("ts")).alias("utc_time"), F.col("value").alias("data_value"), F.lit("z").alias("qa_flag")))
    registry = series.select("datastream_id").distinct().select(
        "datastream_id", F.concat(F.lit("supplier_"), F.col("datastream_id").cast("string")).alias("datastream_tablename"), (F.col("datastream_id") % 5).alias("group"))
    return _flat(stored_data(t.spark, layout, registry, {"group": 2}, tz=DENVER, start_date="1995-12-20", end_date="1996-02-10",
                             downsample_interval="day", downsample_method="mean"))


@query("sync_merge", f"""
WITH {_ONE_SQL},
half AS (SELECT * FROM one WHERE utc_time < {_CUT} AND datastream_id % 8 <> 0),
good AS (SELECT datastream_id AS id, max(utc_time) FILTER (qa_flag = 'z') AS l, count(*) FILTER (qa_flag = 'z') AS n FROM half GROUP BY 1),
remote AS (SELECT datastream_id AS id, max(utc_time) FILTER (qa_flag = 'z') AS l, count(*) FILTER (qa_flag = 'z') AS n FROM one GROUP BY 1),
news AS (SELECT datastream_id, utc_time, data_value, qa_flag FROM one JOIN good ON good.id = datastream_id JOIN remote ON remote.id = datastream_id
         WHERE good.n < remote.n AND utc_time > good.l AND utc_time <= remote.l)
SELECT datastream_id + 500000 AS datastream_id, utc_time, {_VALUE} AS data_value, qa_flag
FROM (SELECT datastream_id, utc_time, data_value, qa_flag FROM half UNION SELECT * FROM news)""")
def sync_merge(t):
    """A stored half takes what a remote store has more; only the cells of the streams that move are rewritten."""
    one = _one(t).drop("event_id")
    half = one.filter((F.col("utc_time") < _CUT) & (F.col("datastream_id") % 8 != 0))
    shape = ["datastream_id", F.concat(F.lit("uuid-"), F.col("datastream_id").cast("string")).alias("datastream_uuid"), F.col("first_good").alias("first_measurement_date"),
             F.col("last_good").alias("last_measurement_date"), F.col("good_count").alias("total_measurement_numbers")]
    layout = _stored(t, half.withColumn("datastream_id", F.col("datastream_id") + 500000))
    local = good_summary(half).select(*shape).withColumn("datastream_id", F.col("datastream_id") + 500000)
    delta = checks.sync_delta(local, good_summary(one).select(*shape), one)
    store.merge(delta["rows"], layout)
    return store.read(t.spark, layout).withColumn("data_value", r4(F.col("data_value")))


@query("upsert_stored", """
SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderstatus FROM orders WHERE o_orderkey % 4 <> 0
UNION ALL SELECT o_orderkey, o_totalprice + 1, NULL FROM orders WHERE o_orderkey % 4 = 0 AND o_orderkey % 9 = 0""")
def upsert_stored(t):
    """New and changed orders in a stored table by key bucket; a column that the updates do not carry stays."""
    layout = store.keyed_layout(scratch_path(t.spark, "orders"), "o_orderkey", 8)
    store.merge(t.orders.filter("o_orderkey % 4 <> 0").select("o_orderkey", "o_totalprice", "o_orderstatus"), layout)
    store.merge(t.orders.filter("o_orderkey % 9 = 0").select("o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice")), layout)
    return store.read(t.spark, layout)


@query("append_stored", """
SELECT event_id, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS timestamp, value, CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN event_type END AS sensor,
       (SELECT count(*) FROM events) AS rows_read, (SELECT count(*) FROM events WHERE event_id % 50 = 0) AS rows_without_order,
       (SELECT count(*) FROM events WHERE event_id % 50 <> 0 AND ts < TIMESTAMP '2024-01-16') AS rows_late
FROM events WHERE ts < TIMESTAMP '2024-01-16' OR event_id % 50 <> 0""")
def append_stored(t):
    """A raw table with one mark: a second delivery with a new column appends what is newer."""
    layout = store.feeder_layout(scratch_path(t.spark, "feeder"))
    store.load(t.events.select("event_id", F.col("ts").alias("timestamp"), "value").filter("timestamp < TIMESTAMP_NTZ '2024-01-16'"), layout)
    done = store.load(t.events.select("event_id", F.when(F.col("event_id") % 50 != 0, F.col("ts")).alias("timestamp"), "value", F.col("event_type").alias("sensor")), layout)
    return store.read(t.spark, layout).withColumn("timestamp", stamp(F.col("timestamp"))).select(
        "event_id", "timestamp", "value", "sensor",
        *(F.lit(getattr(done, n)).cast("bigint").alias(n) for n in ("rows_read", "rows_without_order", "rows_late")))


@query("copy_stored", """
SELECT o_orderkey, o_totalprice, o_orderdate FROM (
  SELECT o_orderkey, o_totalprice, CAST(NULL AS BIGINT) AS o_orderdate FROM orders WHERE o_orderkey <= (SELECT max(o_orderkey) FROM orders WHERE o_orderdate < TIMESTAMP '1995-01-05') AND o_orderdate < TIMESTAMP '1995-01-05'
  UNION ALL SELECT o_orderkey, o_totalprice, CAST(epoch_us(o_orderdate) // 1000000 AS BIGINT) FROM orders
  WHERE o_orderkey > (SELECT max(o_orderkey) FROM orders WHERE o_orderdate < TIMESTAMP '1995-01-05'))""")
def copy_stored(t):
    """Rows beyond the largest id that was copied before, by the mark and not by a scan of the copy."""
    layout = store.Layout(scratch_path(t.spark, "copy"), {"block": "o_orderkey div 4096"}, ("o_orderkey",), "o_orderkey")
    store.load(t.orders.filter("o_orderdate < TIMESTAMP_NTZ '1995-01-05'").select("o_orderkey", "o_totalprice"), layout)
    store.load(t.orders.select("o_orderkey", "o_totalprice", "o_orderdate"), layout)
    return store.read(t.spark, layout).withColumn("o_orderdate", stamp(F.col("o_orderdate")))


@query("stream_late", f"""
WITH {_ONE_SQL}
SELECT datastream_id, utc_time - utc_time % 86400 AS bucket_epoch, count(*) AS n, {sql_r4('avg(data_value)')} AS mean, {sql_r4('max(data_value)')} AS max
FROM one WHERE qa_flag >= 'z' GROUP BY 1, 2""")
def stream_late(t):
    """A third of the loggers is up to date with the first arrivals, the others lag behind by weeks; every reading ends up in its bucket."""
    source, one = scratch_path(t.spark, "arrivals"), _one(t)
    layout, buckets = store.observation_layout(scratch_path(t.spark, "readings"), 16), bucket_layout(scratch_path(t.spark, "buckets"), 16)
    state = scratch_path(t.spark, "state")
    first = (F.col("datastream_id") % 3 == 0) & (F.col("event_id") % 10 != 0) | (F.col("utc_time") < _CUT - 5 * 86400)
    for part in (first, ~first):
        one.filter(part).drop("event_id").write.mode("append").parquet(source)
        downsample_into(read_observations(t.spark, source), layout, buckets, 86400, ["mean", "max"], state).awaitTermination()
    return store.read(t.spark, buckets).filter("n > 0").select("datastream_id", "bucket_epoch", "n", r4(F.col("mean")).alias("mean"), r4(F.col("max")).alias("max"))
