"""Raw tables to flagged observations."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sensorlake.functions.names import datastream_name
from sensorlake.operators import process as p
from sensorlake.operators.trees import ancestor_sums
from sensorlake.plans.stages import process_stage
from sensorlake.session import small_side, written
from suite.registry import query, r4, sql_r4
from suite.views import BOUNDS, OBS_SQL, RAW_SQL, observations, raw_values, upper_bound
from sensorlake.functions.timezones import ntz_to_epoch, shift_seconds

MAPPING_ROWS = """
  ('l_quantity', 'airTemperature', 'degreeFahrenheit', true, true),
  ('l_extendedprice', 'streamFlow', 'cubicFootPerSecond', true, true),
  ('l_discount', 'airTemperature', 'degreeFahrenheit', false, true),
  ('l_tax', NULL, NULL, false, false)"""
MAPPING = f"SELECT * FROM VALUES {MAPPING_ROWS} AS m(column_name, variable_term, units_term, unit_conversion, expose_as_datastream)"
MAPPING_SQL = f"mapping AS (SELECT * FROM (VALUES {MAPPING_ROWS}) m(column_name, variable_term, units_term, unit_conversion, expose_as_datastream))"
UNIT_ROWS = """
  ('degreeFahrenheit', 'temperature', 0.5555555555555556e0, -32.0e0),
  ('degreeCelsius', 'temperature', 1.0e0, 0.0e0),
  ('cubicFootPerSecond', 'flow', 0.0283168e0, 0.0e0),
  ('cubicMeterPerSecond', 'flow', 1.0e0, 0.0e0)"""
UNITS = f"SELECT * FROM VALUES {UNIT_ROWS} AS u(term, quantity_kind_cv, conversion_multiplier, conversion_offset)"
UNITS_SQL = f"units AS (SELECT * FROM (VALUES {UNIT_ROWS}) u(term, quantity_kind_cv, conversion_multiplier, conversion_offset))"
KIND_ROWS = "('temperature', 'degreeCelsius'), ('flow', 'cubicMeterPerSecond')"
KINDS = f"SELECT * FROM VALUES {KIND_ROWS} AS k(term, default_unit)"
KINDS_SQL = f"kinds AS (SELECT * FROM (VALUES {KIND_ROWS}) k(term, default_unit))"
RANGE_ROWS = "('airTemperature', -10.0e0, 9.0e0), ('streamFlow', 100.0e0, 2500.0e0)"
RANGES = f"SELECT * FROM VALUES {RANGE_ROWS} AS r(variable_term, min_valid_range, max_valid_range)"
RANGES_SQL = f"ranges AS (SELECT * FROM (VALUES {RANGE_ROWS}) r(variable_term, min_valid_range, max_valid_range))"
SENSORS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LONG_SQL = f"""
{MAPPING_SQL}, {UNITS_SQL}, {KINDS_SQL}, {RANGES_SQL},
long AS (
  SELECT l_orderkey, l_linenumber, l_suppkey, column_name, data_value,
         coalesce(variable_term, 'unknown') AS variable_term, coalesce(units_term, 'unknown') AS units_term,
         unit_conversion
  FROM (
    SELECT l_orderkey, l_linenumber, l_suppkey, 'l_quantity' AS column_name, l_quantity AS data_value FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, l_suppkey, 'l_extendedprice', l_extendedprice FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, l_suppkey, 'l_discount', l_discount FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, l_suppkey, 'l_tax', l_tax FROM lineitem)
  JOIN mapping USING (column_name) WHERE expose_as_datastream)"""


def long_frame(t):
    feeder = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", *SENSORS)
    return p.to_observations(feeder, t.spark.sql(MAPPING), SENSORS, ["l_orderkey", "l_linenumber", "l_suppkey"])


@query("unpivot_observations", f"""
WITH {LONG_SQL}
SELECT l_orderkey, l_linenumber, l_suppkey, column_name, variable_term, units_term, data_value FROM long""")
def unpivot_observations(t):
    return long_frame(t).select("l_orderkey", "l_linenumber", "l_suppkey", "column_name", "variable_term", "units_term",
                                "data_value")


@query("datastream_names", """
WITH n AS (SELECT 'feeder_' || p_name || '_' || p_type || '_' || repeat(p_brand, 4) || '_ ' AS f,
                  lower(p_type) || '_' AS c, CASE WHEN p_size > 25 THEN 'measured' ELSE 'calculated' END AS s,
                  p_partkey FROM part)
SELECT p_partkey, regexp_replace(substr(f || '_' || c, 1, 53), '[ _]+$', '')
                  || CASE s WHEN 'measured' THEN '_meas' ELSE '_calc' END AS name FROM n""")
def datastream_names(t):
    feeder = F.concat(F.lit("feeder_"), "p_name", F.lit("_"), "p_type", F.lit("_"), F.repeat("p_brand", 4), F.lit("_ "))
    kind = F.when(F.col("p_size") > 25, "measured").otherwise("calculated")
    name = datastream_name(feeder, F.concat(F.lower("p_type"), F.lit("_")), kind)
    return t.part.select("p_partkey", name.alias("name"))


@query("unit_convert", f"""
WITH {LONG_SQL}
SELECT l_orderkey, l_linenumber, l_suppkey, column_name,
  {sql_r4('''CASE WHEN unit_conversion THEN conversion_multiplier * (conversion_offset + data_value)
                  ELSE 1.0 * (0.0 + data_value) END''')} AS data_value
FROM long LEFT JOIN units ON units_term = term""")
def unit_convert(t):
    out = p.convert_units(long_frame(t), t.spark.sql(UNITS))
    return out.select("l_orderkey", "l_linenumber", "l_suppkey", "column_name", r4(F.col("data_value")).alias("data_value"))


@query("default_unit", f"""
WITH {LONG_SQL}
SELECT l_suppkey, column_name, CASE WHEN unit_conversion THEN default_unit ELSE units_term END AS target, count(*) AS n
FROM long LEFT JOIN units u ON units_term = u.term LEFT JOIN kinds k ON quantity_kind_cv = k.term GROUP BY 1, 2, 3""")
def default_unit(t):
    mapping = t.spark.sql(MAPPING).filter("units_term IS NOT NULL")
    resolved = p.resolve_default_unit(mapping, t.spark.sql(UNITS), t.spark.sql(KINDS))
    names = resolved.select("column_name", F.col("target_units_term").alias("target"))
    return long_frame(t).join(names, "column_name").groupBy("l_suppkey", "column_name", "target").agg(
        F.count("*").alias("n"))


@query("qa_bounds", f"""
WITH {LONG_SQL}
SELECT l_suppkey, column_name, count(*) AS n,
  {sql_r4('''max(CASE WHEN unit_conversion THEN min_valid_range
             ELSE min_valid_range / conversion_multiplier - conversion_offset END)''')} AS lower,
  {sql_r4('''max(CASE WHEN unit_conversion THEN max_valid_range
             ELSE max_valid_range / conversion_multiplier - conversion_offset END)''')} AS upper
FROM long l JOIN ranges r ON l.variable_term = r.variable_term JOIN units u ON units_term = term GROUP BY 1, 2""")
def qa_bounds(t):
    streams = long_frame(t).groupBy("l_suppkey", "column_name", "variable_term", "units_term", "unit_conversion").agg(
        F.count("*").alias("n"))
    out = p.qa_bounds(streams, t.spark.sql(RANGES), t.spark.sql(UNITS))
    return out.select("l_suppkey", "column_name", "n", r4(F.col("lower")).alias("lower"), r4(F.col("upper")).alias("upper"))


def _bounds(t, manual=False):
    """One bounds row per user; every third user carries two overlapping hand-made ranges."""
    users = t.events.select(F.col("user_id").alias("datastream_id")).distinct()
    stamp_of = lambda text: F.unix_seconds(F.lit(text).cast("timestamp"))
    ranges = F.array(
        F.struct(stamp_of("2024-01-05 00:00:00").alias("start_epoch"), stamp_of("2024-01-12 00:00:00").alias("end_epoch"),
                 F.lit("b").alias("qa_flag")),
        F.struct(stamp_of("2024-01-10 00:00:00").alias("start_epoch"), F.lit(None).cast("bigint").alias("end_epoch"),
                 F.lit("w").alias("qa_flag")))
    return users.select("datastream_id", F.lit(0.5).alias("lower"), F.lit(75.0).alias("upper"),
                        F.when(F.lit(manual) & (F.col("datastream_id") % 3 == 0), ranges).alias("manual_ranges"))


def _raw(t):
    return t.events.select("event_id", F.col("user_id").alias("datastream_id"),
                           ntz_to_epoch(F.col("ts")).alias("utc_time"), raw_values().alias("data_value"))


_AUTO = """CASE WHEN data_value IS NULL THEN 'd' WHEN isnan(data_value) THEN 'c' WHEN isinf(data_value) THEN 'b'
                WHEN data_value < 0.5 OR data_value > 75.0 THEN 'f' ELSE 'z' END"""


@query("qa_auto_flags", f"WITH {RAW_SQL} SELECT event_id, datastream_id, utc_time, {_AUTO} AS qa_flag FROM raw")
def qa_auto_flags(t):
    return p.flag_observations(_raw(t), small_side(_bounds(t))).select("event_id", "datastream_id", "utc_time", "qa_flag")


@query("qa_manual_ranges", f"""
WITH {RAW_SQL}
SELECT event_id, datastream_id, utc_time,
  CASE WHEN datastream_id % 3 = 0 AND utc_time >= 1704844800 THEN 'w'
       WHEN datastream_id % 3 = 0 AND utc_time >= 1704412800 AND utc_time <= 1705017600 THEN 'b'
       ELSE {_AUTO} END AS qa_flag FROM raw""")
def qa_manual_ranges(t):
    return p.flag_observations(_raw(t), small_side(_bounds(t, manual=True))).select("event_id", "datastream_id", "utc_time", "qa_flag")


@query("local_to_utc_dst", """
WITH r AS (
  SELECT l_returnflag AS stream, l_orderkey, l_linenumber, l_partkey, l_suppkey,
         l_shipdate + (60 * (1 + l_linenumber % 2) + l_partkey % 60) * INTERVAL 1 MINUTE AS ts FROM lineitem),
z AS (SELECT *, ts AT TIME ZONE 'America/Denver' AS later FROM r),
m AS (SELECT *, ((later - INTERVAL 1 HOUR) AT TIME ZONE 'America/Denver') = ts AS rep,
             (later AT TIME ZONE 'America/Denver') <> ts AS gap FROM z),
w AS (SELECT *, coalesce(lag(ts) OVER (PARTITION BY stream, CAST(ts AS DATE)
                                       ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) > ts, false) AS back
      FROM m WHERE rep),
s AS (SELECT *, max(CASE WHEN back THEN 1 ELSE 0 END) OVER (PARTITION BY stream, CAST(ts AS DATE)
                ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey ROWS UNBOUNDED PRECEDING) AS second FROM w)
SELECT stream, l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN NOT gap THEN CAST(epoch_us(later) // 1000000 AS BIGINT) END AS utc_time,
       CASE WHEN gap THEN 'gap' ELSE 'plain' END AS dst_status FROM m WHERE NOT rep
UNION ALL
SELECT stream, l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(epoch_us(later) // 1000000 AS BIGINT) - CASE WHEN second = 1 THEN 0 ELSE 3600 END,
       CASE WHEN second = 1 THEN 'second_pass' ELSE 'first_pass' END FROM s""")
def local_to_utc_dst(t):
    minutes = 60 * (1 + F.col("l_linenumber") % 2) + F.col("l_partkey") % 60
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    df = t.lineitem.select(F.col("l_returnflag").alias("stream"), *keys,
                           shift_seconds(F.col("l_shipdate"), minutes * 60).alias("ts"))
    return p.local_to_epoch(df, "ts", "America/Denver", ["stream"], keys).drop("ts")


@query("materialize_delta", f"""
WITH {OBS_SQL}, stored AS (SELECT datastream_id, max(utc_time) AS last_time FROM obs
                           WHERE utc_time < 1705276800 + datastream_id * 3600 GROUP BY 1)
SELECT o.datastream_id, o.utc_time, o.qa_flag FROM obs o LEFT JOIN stored s USING (datastream_id)
WHERE o.utc_time > coalesce(s.last_time, 0)""")
def materialize_delta(t):
    obs = observations(t)
    stored = obs.filter(F.col("utc_time") < 1705276800 + F.col("datastream_id") * 3600)
    return p.materialize(obs, stored).select("datastream_id", "utc_time", "qa_flag")


def registry(t):
    """Registry of the streams as stored after the first half of January; some streams are not registered yet."""
    obs = observations(t).filter((F.col("utc_time") < 1705276800) & (F.col("datastream_id") % 5 != 0))
    return p.good_summary(obs).select(
        "datastream_id", F.concat(F.lit("uuid-"), F.col("datastream_id").cast("string")).alias("datastream_uuid"),
        F.col("first_good").alias("first_measurement_date"), F.col("last_good").alias("last_measurement_date"),
        F.col("good_count").alias("total_measurement_numbers"))


REGISTRY_SQL = """
registry AS (
  SELECT datastream_id, 'uuid-' || CAST(datastream_id AS VARCHAR) AS datastream_uuid,
         min(utc_time) FILTER (qa_flag = 'z') AS first_measurement_date,
         max(utc_time) FILTER (qa_flag = 'z') AS last_measurement_date,
         count(*) FILTER (qa_flag = 'z') AS total_measurement_numbers
  FROM obs WHERE utc_time < 1705276800 AND datastream_id % 5 <> 0 GROUP BY 1)"""


@query("registry_update", f"""
WITH {OBS_SQL}, {REGISTRY_SQL}, news AS (
  SELECT datastream_id, min(utc_time) FILTER (qa_flag = 'z') AS f, max(utc_time) FILTER (qa_flag = 'z') AS l,
         count(*) FILTER (qa_flag = 'z') AS n FROM obs WHERE utc_time >= 1705276800 GROUP BY 1)
SELECT coalesce(r.datastream_id, n.datastream_id) AS datastream_id, datastream_uuid,
       coalesce(first_measurement_date, f) AS first_measurement_date, coalesce(l, last_measurement_date) AS last_measurement_date,
       coalesce(total_measurement_numbers, 0) + coalesce(n, 0) AS total_measurement_numbers
FROM registry r FULL JOIN news n ON r.datastream_id = n.datastream_id""")
def registry_update(t):
    return p.update_registry(registry(t), observations(t).filter("utc_time >= 1705276800"))


def equipment(t):
    return t.part.select(F.col("p_partkey").alias("equipment_id"),
                         F.concat(F.lit("eq-"), F.col("p_partkey").cast("string")).alias("equipment_code"))


def positions(t):
    """Two positions per part; the newer one counts. Some have no offset, some starts are missing."""
    z = F.when(F.col("p_size") % 7 != 0, (25 - F.col("p_size")) / 4.0)
    new = t.part.select(F.col("p_partkey").alias("equipment_id"),
                        (F.col("p_partkey") * 10 + 1000).alias("position_start_date_utc"), z.alias("equipment_z_offset_m"))
    old = t.part.select(F.col("p_partkey").alias("equipment_id"),
                        F.when(F.col("p_size") % 2 == 0, F.col("p_partkey")).alias("position_start_date_utc"),
                        F.lit(99.0).alias("equipment_z_offset_m"))
    return new.unionByName(old)


def edges(t):
    """Newest attachment: the part with half the key. An older attachment to part 0 must lose."""
    child = t.part.filter("p_partkey > 0")
    new = child.select(F.col("p_partkey").alias("equipment_id"), F.floor(F.col("p_partkey") / 2).alias("related_equipment_id"),
                       F.lit(20).cast("bigint").alias("relationship_start_date_time_utc"))
    old = child.select(F.col("p_partkey").alias("equipment_id"), F.lit(0).cast("bigint").alias("related_equipment_id"),
                       F.lit(10).cast("bigint").alias("relationship_start_date_time_utc"))
    return new.unionByName(old).withColumn("relationship_type_cv", F.lit("isAttachedTo"))


@query("latest_position", """
SELECT p_partkey AS equipment_id, p_partkey * 10 + 1000 AS position_start_date_utc,
       CASE WHEN p_size % 7 <> 0 THEN (25 - p_size) / 4.0 END AS equipment_z_offset_m FROM part""")
def latest_position(t):
    return p.latest_position(positions(t))


_OFFSETS_SQL = """
WITH RECURSIVE own AS (SELECT p_partkey AS id, coalesce(CASE WHEN p_size % 7 <> 0 THEN (25 - p_size) / 4.0 END, 0.0) AS z FROM part),
up AS (SELECT id AS leaf, id AS at, z FROM own
       UNION ALL SELECT leaf, o.id, o.z FROM up JOIN own o ON o.id = up.at // 2 WHERE up.at > 0),
total AS (SELECT leaf AS equipment_id, CAST(sum(z) AS DOUBLE) AS s FROM up GROUP BY leaf)"""


@query("offset_ancestors", f"""{_OFFSETS_SQL}
SELECT equipment_id, false AS cyclic, CASE WHEN s < 0 THEN 'sensor_depth' ELSE 'sensor_elevation' END AS attribute,
       abs(s) AS offset_m FROM total""")
def offset_ancestors(t):
    return p.accumulate_offsets(equipment(t), positions(t), edges(t))


@query("offset_deep_chain", "SELECT event_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS depth, false AS cyclic FROM events")
def offset_deep_chain(t):
    """The events of a user as one chain, hundreds of nodes deep and deeper with more events."""
    before = F.lag("event_id").over(W.partitionBy("user_id").orderBy("event_id"))
    out = ancestor_sums(t.events.select(F.col("event_id").alias("id"), before.alias("parent_id"), F.lit(1).alias("weight")))
    return out.select(F.col("id").alias("event_id"), F.col("total").cast("bigint").alias("depth"), "cyclic")


@query("attribute_json", f"""{_OFFSETS_SQL}
SELECT equipment_id, (CASE WHEN s < 0 THEN 'sensor_depth' ELSE 'sensor_elevation' END) AS kind,
       'meter' AS unit, abs(s) AS offset_m, 'eq-' || CAST(equipment_id AS VARCHAR) AS instrument FROM total""")
def attribute_json(t):
    offsets = p.accumulate_offsets(equipment(t), positions(t), edges(t))
    out = p.datastream_attribute(offsets.join(equipment(t), "equipment_id"))
    pick = lambda key: F.get_json_object("datastream_attribute", f"$.{key}")
    return out.select(
        "equipment_id", F.when(pick("sensor_depth").isNotNull(), "sensor_depth").otherwise("sensor_elevation").alias("kind"),
        F.coalesce(pick("sensor_depth_units"), pick("sensor_elevation_units")).alias("unit"),
        F.coalesce(pick("sensor_depth"), pick("sensor_elevation")).cast("double").alias("offset_m"),
        pick("instrument").alias("instrument"))


_NAMED = "sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode('datastreams/' || tablename))"


@query("process_registry", f"""{_OFFSETS_SQL},
{OBS_SQL}, {REGISTRY_SQL}, news AS (
  SELECT datastream_id, min(utc_time) FILTER (qa_flag = 'z') AS f, max(utc_time) FILTER (qa_flag = 'z') AS l,
         count(*) FILTER (qa_flag = 'z') AS n FROM obs WHERE utc_time >= 1705276800 GROUP BY 1),
ids AS (SELECT datastream_id FROM obs WHERE utc_time < 1705276800 AND datastream_id % 5 <> 0 AND datastream_id % 7 <> 0
        UNION SELECT datastream_id FROM obs WHERE datastream_id % 5 = 0 OR utc_time >= 1705276800
        UNION SELECT datastream_id + 1000000 FROM obs WHERE datastream_id % 10 = 3),
described AS (SELECT datastream_id, 'stream_' || CAST(datastream_id AS VARCHAR) AS tablename, datastream_id % 100 AS equipment_id FROM ids),
whole AS (
  SELECT *, {_NAMED} AS h FROM described d JOIN total USING (equipment_id)),
rows AS (SELECT * FROM registry FULL JOIN news USING (datastream_id) FULL JOIN whole USING (datastream_id))
SELECT datastream_id, coalesce(datastream_uuid, h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' || translate(h[17:17], '0123456789abcdef', '89ab89ab89ab89ab')
         || h[18:20] || '-' || h[21:32]) AS datastream_uuid, 'physicalsensor' AS datastream_type,
  CASE WHEN tablename IS NOT NULL THEN 'datastreams' END AS datastream_database, tablename AS datastream_tablename, equipment_id,
  equipment_id % 9 AS sampling_feature_id, equipment_id % 4 AS variable_id, equipment_id % 3 AS units_id,
  CASE WHEN s < 0 THEN 'sensor_depth' WHEN s >= 0 THEN 'sensor_elevation' END AS kind, abs(s) AS offset_m,
  CASE WHEN equipment_id IS NOT NULL THEN 'eq-' || CAST(equipment_id AS VARCHAR) END AS instrument,
  coalesce(first_measurement_date, f) AS first_measurement_date, coalesce(l, last_measurement_date) AS last_measurement_date,
  coalesce(total_measurement_numbers, 0) + coalesce(n, 0) AS total_measurement_numbers
FROM rows""")
def process_registry(t):
    """Registered streams with and without a description, new streams with readings, and described ones that have none yet."""
    obs, late = observations(t), F.col("utc_time") >= 1705276800
    five, seven = F.col("datastream_id") % 5, F.col("datastream_id") % 7
    ids = (obs.where(late | (five == 0) | (seven != 0)).select("datastream_id")
           .unionAll(obs.where("datastream_id % 10 = 3").select(F.col("datastream_id") + 1000000)).distinct())
    number = F.col("datastream_id") % 100
    streams = ids.select("datastream_id", F.concat(F.lit("stream_"), F.col("datastream_id").cast("string")).alias("datastream_tablename"),
                         F.concat(F.lit("e-"), number.cast("string")).alias("equipment_uuid"), (number % 9).alias("sampling_feature_id"),
                         (number % 4).alias("variable_id"), (number % 3).alias("units_id"))
    machines = equipment(t).withColumn("equipment_uuid", F.concat(F.lit("e-"), F.col("equipment_id").cast("string")))
    out = p.register_streams(registry(t), obs.where(late), streams, machines, positions(t), edges(t))
    pick = lambda key: F.get_json_object("datastream_attribute", f"$.{key}")
    return out.withColumns({
        "kind": F.when(pick("sensor_depth").isNotNull(), "sensor_depth").when(pick("sensor_elevation").isNotNull(), "sensor_elevation"),
        "offset_m": F.coalesce(pick("sensor_depth"), pick("sensor_elevation")).cast("double"), "instrument": pick("instrument"),
    }).drop("datastream_attribute")


@query("water_level_calc", f"""
WITH {OBS_SQL}
SELECT datastream_id + 100000 AS datastream_id, utc_time,
  {sql_r4('((datastream_id % 7) / 10.0 + (1500.0 + datastream_id)) - data_value')} AS data_value
FROM obs WHERE qa_flag = 'z'""")
def water_level_calc(t):
    streams = t.events.select(F.col("user_id").alias("datastream_id")).distinct().select(
        "datastream_id", (F.col("datastream_id") + 100000).alias("level_id"),
        (1500.0 + F.col("datastream_id")).alias("elevation_m"), (F.col("datastream_id") % 7 / 10.0).alias("casing_m"))
    out = p.water_level(observations(t), streams)
    return out.withColumn("data_value", r4(F.col("data_value")))


@query("piecewise_segments", f"""
WITH {OBS_SQL}
SELECT datastream_id, utc_time,
  {sql_r4('''CASE WHEN datastream_id % 2 = 0 AND utc_time >= 1705000000 AND utc_time <= 1705900000 THEN 11.0 * 0.3048 + data_value
                  WHEN datastream_id % 2 = 0 AND utc_time >= 1704200000 AND utc_time <= 1705100000 THEN 9.5 * 0.3048 + data_value
                  ELSE data_value END''')} AS data_value
FROM obs WHERE qa_flag >= 'f'""")
def piecewise_segments(t):
    segment = lambda a, b, e: F.struct(F.lit(a).alias("start_epoch"), F.lit(b).alias("end_epoch"), F.lit(e).alias("elevation_ft"))
    ranges = F.array(segment(1704200000, 1705100000, 9.5), segment(1705000000, 1705900000, 11.0))
    segments = t.events.select(F.col("user_id").alias("datastream_id")).distinct().select(
        "datastream_id", F.lit(30.0).alias("casing_ft"), F.when(F.col("datastream_id") % 2 == 0, ranges).alias("ranges"))
    out = p.piecewise_calc(observations(t).filter("qa_flag >= 'f'"), segments)
    return out.select("datastream_id", "utc_time", r4(F.col("data_value")).alias("data_value"))


_STAGE_TS = "(l_shipdate + (8 + l_linenumber) * INTERVAL 1 HOUR)"


@query("process_stage", f"""
WITH {LONG_SQL},
vals AS (
  SELECT 'site_' || CAST(l.l_suppkey AS VARCHAR) || '_' || l.column_name || '_meas' AS name,
    CAST(epoch_us({_STAGE_TS.replace("l_shipdate", "o.l_shipdate").replace("l_linenumber", "o.l_linenumber")} AT TIME ZONE 'America/Denver') // 1000000 AS BIGINT) AS utc_time,
    CASE WHEN l.unit_conversion THEN conversion_multiplier * (conversion_offset + l.data_value) ELSE l.data_value END AS v,
    CASE WHEN l.unit_conversion THEN min_valid_range ELSE min_valid_range / conversion_multiplier - conversion_offset END AS lo,
    CASE WHEN l.unit_conversion THEN max_valid_range ELSE max_valid_range / conversion_multiplier - conversion_offset END AS hi
  FROM (SELECT *, row_number() OVER () AS rid FROM lineitem) o
  JOIN (SELECT rid, l_suppkey, column_name, data_value, variable_term, units_term, unit_conversion FROM (
          SELECT rid, l_suppkey, 'l_quantity' AS column_name, l_quantity AS data_value FROM (SELECT *, row_number() OVER () AS rid FROM lineitem)
          UNION ALL SELECT rid, l_suppkey, 'l_extendedprice', l_extendedprice FROM (SELECT *, row_number() OVER () AS rid FROM lineitem)
          UNION ALL SELECT rid, l_suppkey, 'l_discount', l_discount FROM (SELECT *, row_number() OVER () AS rid FROM lineitem)) JOIN mapping USING (column_name)) l
    ON l.rid = o.rid
  JOIN units ON units_term = term JOIN ranges r ON r.variable_term = l.variable_term),
f AS (SELECT *, CASE WHEN v < lo OR v > hi THEN 'f' ELSE 'z' END AS qa_flag FROM vals WHERE utc_time > 883612800)
SELECT name, min(utc_time) FILTER (qa_flag = 'z') AS first_time, max(utc_time) FILTER (qa_flag = 'z') AS last_time,
       count(*) FILTER (qa_flag = 'z') AS good, count(*) AS all_rows, {sql_r4("sum(v)")} AS total FROM f GROUP BY name""")
def process_stage_query(t):
    """Whole way from a raw table in local time to flagged readings; everything up to the end of 1997 is stored already."""
    feeder = t.lineitem.select(F.concat(F.lit("site_"), F.col("l_suppkey").cast("string")).alias("feeder_table"), "l_orderkey", "l_linenumber",
                               shift_seconds(F.col("l_shipdate"), (8 + F.col("l_linenumber")) * 3600).alias("timestamp"), *SENSORS)
    def load(rows, stored):
        return process_stage(rows, "America/Denver", SENSORS, ["l_orderkey", "l_linenumber"], t.spark.sql(MAPPING), t.spark.sql(UNITS),
                             t.spark.sql(KINDS), t.spark.sql(RANGES), stored)

    nothing = t.spark.range(0).select(F.col("id").alias("datastream_id"), F.col("id").alias("utc_time"))
    # The first load has the readings up to then; the second sees all of them and takes what is newer in each stream.
    first, _ = load(feeder.filter(F.col("timestamp") <= F.lit("1997-12-31 17:00:00").cast("timestamp_ntz")), nothing)
    delta, streams = load(feeder, written(first.select("datastream_id", "utc_time"), "stored"))
    late = delta.join(streams.select("datastream_id", "datastream_tablename"), "datastream_id")
    good = F.col("qa_flag") == "z"
    return late.groupBy(F.col("datastream_tablename").alias("name")).agg(
        F.min(F.when(good, F.col("utc_time"))).alias("first_time"), F.max(F.when(good, F.col("utc_time"))).alias("last_time"),
        F.count_if(good).alias("good"), F.count("*").alias("all_rows"), r4(F.sum("data_value")).alias("total"))
