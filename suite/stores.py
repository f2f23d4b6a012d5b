"""Store checks, comparison, sync, snapshots, streaming."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorlake.functions.timezones import ntz_to_epoch
from sensorlake.operators import checks
from sensorlake.operators.process import good_summary
from sensorlake.session import scratch_path
from sensorlake.sources import sinks
from sensorlake.streaming.downsample import append_new, downsample_stream, read_observations
from suite.metadata import _variables
from suite.registry import query, r4, sql_r4
from suite.views import OBS_SQL, observations


def registry(t):
    """Registry as it should be, but wrong for some streams and without some."""
    k = F.col("datastream_id")
    good = good_summary(observations(t)).filter(k % 13 != 0)
    return good.select(
        "datastream_id", F.concat(F.lit("uuid-"), k.cast("string")).alias("datastream_uuid"),
        (F.col("first_good") + F.when(k % 5 == 0, 60).otherwise(0)).alias("first_measurement_date"),
        F.when(k % 7 != 0, F.col("last_good")).alias("last_measurement_date"),
        (F.col("good_count") - F.when(k % 3 == 0, 1).otherwise(0)).alias("total_measurement_numbers"))


_REG_SQL = """
actual AS (SELECT datastream_id, min(utc_time) FILTER (qa_flag = 'z') AS first_good, max(utc_time) FILTER (qa_flag = 'z') AS last_good,
                  count(*) FILTER (qa_flag = 'z') AS good_count, count(*) AS row_count FROM obs GROUP BY 1),
registry AS (SELECT datastream_id, 'uuid-' || CAST(datastream_id AS VARCHAR) AS datastream_uuid,
  first_good + CASE WHEN datastream_id % 5 = 0 THEN 60 ELSE 0 END AS first_measurement_date,
  CASE WHEN datastream_id % 7 <> 0 THEN last_good END AS last_measurement_date,
  good_count - CASE WHEN datastream_id % 3 = 0 THEN 1 ELSE 0 END AS total_measurement_numbers FROM actual WHERE datastream_id % 13 <> 0)"""


@query("check_registry", f"""
WITH {OBS_SQL}, {_REG_SQL}
SELECT a.datastream_id, first_measurement_date, first_good, last_measurement_date, last_good, total_measurement_numbers, good_count
FROM actual a LEFT JOIN registry r ON a.datastream_id = r.datastream_id
WHERE first_measurement_date IS DISTINCT FROM first_good OR last_measurement_date IS DISTINCT FROM last_good
   OR coalesce(total_measurement_numbers, 0) <> good_count""")
def check_registry(t):
    return checks.check_registry(registry(t), observations(t))


@query("fix_registry", f"""
WITH {OBS_SQL}, {_REG_SQL}
SELECT a.datastream_id, datastream_uuid, first_good AS first_measurement_date, last_good AS last_measurement_date,
       good_count AS total_measurement_numbers FROM actual a LEFT JOIN registry r ON a.datastream_id = r.datastream_id""")
def fix_registry(t):
    return checks.fix_registry(registry(t), checks.check_registry(registry(t), observations(t)))


_RANGE_ROWS = "('click', 0.5e0, 60.0e0), ('view', 0.5e0, 80.0e0), ('error', 0.5e0, 100.0e0)"


@query("empty_streams", f"""
WITH bad AS (SELECT l_suppkey * 100 + l_linenumber AS datastream_id, l_linenumber, count(*) AS row_count,
             count(*) FILTER (l_quantity > 48) AS good_count FROM lineitem GROUP BY 1, 2)
SELECT datastream_id, row_count, variable_term, 'meter' AS units_term, lo AS min_valid_range, hi AS max_valid_range
FROM (SELECT *, CASE l_linenumber % 4 WHEN 0 THEN 'click' WHEN 1 THEN 'view' WHEN 2 THEN 'error' ELSE 'signup' END AS variable_term FROM bad)
LEFT JOIN (VALUES {_RANGE_ROWS}) v(term, lo, hi) ON term = variable_term WHERE good_count = 0 AND row_count >= 10""")
def empty_streams(t):
    li = t.lineitem
    ids = (F.col("l_suppkey") * 100 + F.col("l_linenumber")).alias("datastream_id")
    obs = li.select(ids, ntz_to_epoch(F.col("l_shipdate")).alias("utc_time"), F.col("l_quantity").alias("data_value"),
                    F.when(F.col("l_quantity") > 48, "z").otherwise("f").alias("qa_flag"))
    k = F.col("l_linenumber") % 4
    term = F.when(k == 0, "click").when(k == 1, "view").when(k == 2, "error").otherwise("signup")
    streams = li.select(ids, term.alias("variable_term"), F.lit("meter").alias("units_term")).distinct()
    ranges = t.spark.sql(f"SELECT * FROM VALUES {_RANGE_ROWS} AS v(variable_term, min_valid_range, max_valid_range)")
    return checks.empty_streams(obs, streams, ranges)


@query("last_ten", f"""
WITH {OBS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY datastream_id ORDER BY utc_time DESC, data_value DESC, qa_flag DESC) AS k
                      FROM obs WHERE data_value IS NOT NULL)
SELECT datastream_id, utc_time, {sql_r4('CASE WHEN NOT isnan(data_value) THEN data_value END')} AS data_value, qa_flag, CAST(k AS INTEGER) AS rank FROM r WHERE k <= 10""")
def last_ten(t):
    return checks.last_n(observations(t)).withColumn("data_value", r4(F.col("data_value")))


@query("diff_registry", """
WITH old AS (SELECT p_partkey, p_brand || '_wvc_' || CAST(p_partkey AS VARCHAR) AS name, p_type, p_size FROM part),
new AS (SELECT p_partkey, p_brand || '_wvc(' || CAST(p_partkey AS VARCHAR) AS name, CASE WHEN p_size < 5 THEN 'OTHER' ELSE p_type END AS p_type,
               CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_size END AS p_size FROM part WHERE p_partkey % 17 <> 0)
SELECT o.name AS datastream_tablename,
  CASE WHEN n.name IS NULL THEN 'missing' WHEN o.p_type IS DISTINCT FROM n.p_type OR o.p_size IS DISTINCT FROM n.p_size THEN 'different' ELSE 'same' END AS status,
  CASE WHEN n.name IS NOT NULL THEN concat_ws(';', CASE WHEN o.p_type IS DISTINCT FROM n.p_type THEN 'p_type:' || o.p_type || '>' || n.p_type END,
       CASE WHEN o.p_size IS DISTINCT FROM n.p_size THEN 'p_size:' || CAST(o.p_size AS VARCHAR) || '>' || coalesce(CAST(n.p_size AS VARCHAR), '~') END) END AS detail
FROM old o LEFT JOIN new n ON n.name = replace(o.name, 'wvc_', 'wvc(')""")
def diff_registry(t):
    key = F.col("p_partkey").cast("string")
    old = t.part.select(F.concat("p_brand", F.lit("_wvc_"), key).alias("datastream_tablename"), "p_type", "p_size")
    new = t.part.filter("p_partkey % 17 <> 0").select(
        F.concat("p_brand", F.lit("_wvc("), key).alias("datastream_tablename"),
        F.when(F.col("p_size") < 5, "OTHER").otherwise(F.col("p_type")).alias("p_type"),
        F.when(F.col("p_partkey") % 11 != 0, F.col("p_size")).alias("p_size"))
    out = checks.diff_registry(old, new, {"wvc_": "wvc(", "avg_": "avg("}, ["p_type", "p_size"])
    detail = F.array_join(F.transform("differences", lambda d: F.concat(d["field"], F.lit(":"), F.coalesce(d["old"], F.lit("~")), F.lit(">"),
                                                                        F.coalesce(d["new"], F.lit("~")))), ";")
    return out.select("datastream_tablename", "status", detail.alias("detail"))


@query("diff_registry_terms", """
WITH old AS (SELECT 'p_' || p_partkey AS name, p_type AS variable, p_brand AS unit, p_size FROM part),
new AS (SELECT 'p_' || p_partkey AS name, CASE WHEN p_partkey % 7 = 0 THEN 'unknown -1' ELSE p_type END AS variable, CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_brand END AS unit,
               CASE WHEN p_partkey % 5 = 0 THEN p_size + 1 ELSE p_size END AS p_size FROM part WHERE p_partkey % 17 <> 0)
SELECT o.name AS datastream_tablename, 'variable_id' AS field, o.variable AS old, n.variable AS new FROM old o JOIN new n USING (name) WHERE o.variable <> n.variable
UNION ALL SELECT o.name, 'units_id', o.unit, n.unit FROM old o JOIN new n USING (name) WHERE n.unit IS NULL
UNION ALL SELECT o.name, 'p_size', CAST(o.p_size AS VARCHAR), CAST(n.p_size AS VARCHAR) FROM old o JOIN new n USING (name) WHERE o.p_size <> n.p_size
UNION ALL SELECT o.name, 'datastream_tablename', o.name, NULL FROM old o WHERE name NOT IN (SELECT name FROM new)""")
def diff_registry_terms(t):
    """Two registries that number their variables and units differently: only what the ids stand for is compared."""
    def numbered(column, shift):
        return t.part.select(F.col(column).alias("term")).distinct().select((F.xxhash64("term") + shift).alias("id"), "term")

    def side(parts, shift):
        return parts.select(F.concat(F.lit("p_"), F.col("p_partkey").cast("string")).alias("datastream_tablename"), (F.xxhash64("p_type") + shift).alias("variable_id"),
                            (F.xxhash64("p_brand") + shift).alias("units_id"), "p_size", "p_partkey")

    key = F.col("p_partkey")
    new = side(t.part.filter("p_partkey % 17 <> 0"), 1).withColumns({
        "variable_id": F.when(key % 7 == 0, F.lit(-1)).otherwise(F.col("variable_id")), "units_id": F.when(key % 11 != 0, F.col("units_id")),
        "p_size": F.when(key % 5 == 0, F.col("p_size") + 1).otherwise(F.col("p_size"))})
    terms = lambda shift: {"variable_id": (numbered("p_type", shift), "id", "term"), "units_id": (numbered("p_brand", shift), "id", "term")}
    return checks.registry_differences(side(t.part, 0), new, {}, ["variable_id", "units_id", "p_size"], terms(0), terms(1))


def _other_store(t):
    """The same observations with some readings lost, changed or re-flagged."""
    obs = observations(t)
    k, time = F.col("datastream_id"), F.col("utc_time")
    return obs.filter(~((k % 10 == 3) & (time % 50 == 0))).withColumns({
        "data_value": F.when((k % 10 == 5) & (time % 40 == 0), F.col("data_value") + 1).otherwise(F.col("data_value")),
        "qa_flag": F.when((k % 10 == 6) & (time % 30 == 0), "w").otherwise(F.col("qa_flag"))})


_OTHER_SQL = """
other AS (SELECT datastream_id, utc_time, CASE WHEN datastream_id % 10 = 5 AND utc_time % 40 = 0 THEN data_value + 1 ELSE data_value END AS data_value,
                 CASE WHEN datastream_id % 10 = 6 AND utc_time % 30 = 0 THEN 'w' ELSE qa_flag END AS qa_flag
          FROM obs WHERE NOT (datastream_id % 10 = 3 AND utc_time % 50 = 0))"""


@query("diff_data_fast", f"""
WITH {OBS_SQL}, {_OTHER_SQL},
a AS (SELECT datastream_id, utc_time, data_value, qa_flag, count(*) AS n FROM obs GROUP BY ALL),
b AS (SELECT datastream_id, utc_time, data_value, qa_flag, count(*) AS n FROM other GROUP BY ALL),
bad AS (SELECT DISTINCT datastream_id FROM ((FROM a EXCEPT FROM b) UNION ALL (FROM b EXCEPT FROM a)))
SELECT o.datastream_id, (SELECT count(*) FROM obs x WHERE x.datastream_id = o.datastream_id) AS old_rows,
       (SELECT count(*) FROM other x WHERE x.datastream_id = o.datastream_id) AS new_rows, o.datastream_id NOT IN (FROM bad) AS equal
FROM (SELECT DISTINCT datastream_id FROM obs) o""")
def diff_data_fast(t):
    return checks.diff_data_fast(observations(t), _other_store(t))


@query("diff_data_deep", f"""
WITH {OBS_SQL}, {_OTHER_SQL},
a AS (SELECT datastream_id, utc_time, data_value AS v, qa_flag AS f FROM obs WHERE data_value IS NOT NULL AND NOT isnan(data_value)),
b AS (SELECT datastream_id, utc_time, data_value AS v, qa_flag AS f FROM other WHERE data_value IS NOT NULL AND NOT isnan(data_value))
SELECT coalesce(a.datastream_id, b.datastream_id) AS datastream_id, coalesce(a.utc_time, b.utc_time) AS utc_time, a.v AS old_value, b.v AS new_value,
       a.f AS old_flag, b.f AS new_flag, CASE WHEN b.f IS NULL THEN 'removed' WHEN a.f IS NULL THEN 'added' ELSE 'changed' END AS change
FROM a FULL JOIN b ON a.datastream_id = b.datastream_id AND a.utc_time = b.utc_time
WHERE a.v IS DISTINCT FROM b.v OR a.f IS DISTINCT FROM b.f""")
def diff_data_deep(t):
    return checks.diff_data_deep(observations(t), _other_store(t))


NOW = 1706745600


def _named(df):
    return df.withColumn("datastream_tablename", F.concat(F.lit("ds_"), F.col("datastream_id").cast("string")))


@query("freshness", f"""
WITH {OBS_SQL}, actual AS (SELECT datastream_id, max(utc_time) FILTER (qa_flag = 'z') AS l, count(*) FILTER (qa_flag = 'z') AS n FROM obs GROUP BY 1),
loc AS (SELECT datastream_id, l - CASE WHEN datastream_id % 4 = 1 THEN 200000 WHEN datastream_id % 4 = 2 THEN 100 ELSE 0 END AS l,
               n - CASE WHEN datastream_id % 4 IN (1, 2) THEN 1 WHEN datastream_id % 20 = 3 THEN -1 ELSE 0 END AS n FROM actual)
SELECT 'ds_' || CAST(o.datastream_id AS VARCHAR) AS datastream_tablename, o.n AS local_n, r.n AS remote_n,
  CASE WHEN r.n IS NULL THEN 'remote missing' WHEN o.n < r.n AND r.l - o.l > 86400 THEN 'behind more than 24 hours' WHEN o.n < r.n THEN 'behind within 24 hours'
       WHEN o.n = r.n AND {NOW} - o.l > 86400 THEN 'up to date, data older than 24 hours' WHEN o.n = r.n THEN 'up to date' ELSE 'remote has fewer' END AS status
FROM loc o LEFT JOIN (SELECT * FROM actual WHERE datastream_id % 9 <> 0) r ON o.datastream_id = r.datastream_id""")
def freshness(t):
    k = F.col("datastream_id")
    actual = _named(good_summary(observations(t)).select("datastream_id", F.col("last_good").alias("last_measurement_date"),
                                                         F.col("good_count").alias("total_measurement_numbers")))
    local = actual.withColumns({
        "last_measurement_date": F.col("last_measurement_date") - F.when(k % 4 == 1, 200000).when(k % 4 == 2, 100).otherwise(0),
        "total_measurement_numbers": F.col("total_measurement_numbers") - F.when((k % 4).isin(1, 2), 1).when(k % 20 == 3, -1).otherwise(0)})
    return checks.freshness(local, actual.filter(k % 9 != 0), NOW)


_CUT = 1705276800
_SYNC_SQL = f"""
remote AS (SELECT datastream_id AS id, min(utc_time) FILTER (qa_flag = 'z') AS f, max(utc_time) FILTER (qa_flag = 'z') AS l,
                  count(*) FILTER (qa_flag = 'z') AS n FROM obs GROUP BY 1),
half AS (SELECT datastream_id AS id, max(utc_time) FILTER (qa_flag = 'z') AS l, count(*) FILTER (qa_flag = 'z') AS n
         FROM obs WHERE utc_time < {_CUT} AND datastream_id % 8 <> 0 GROUP BY 1),
plan AS (SELECT r.id, r.l AS remote_last, r.n AS remote_n, h.id IS NOT NULL AS known, coalesce(h.n, 0) AS local_n, coalesce(h.l, r.f) AS start
         FROM remote r LEFT JOIN half h ON r.id = h.id)"""


@query("sync_delta", f"""
WITH {OBS_SQL}, {_SYNC_SQL}
SELECT id + 500000 AS datastream_id, utc_time, {sql_r4('CASE WHEN NOT isnan(data_value) THEN data_value END')} AS data_value, qa_flag, remote_last AS new_last, remote_n AS new_count
FROM obs JOIN plan ON id = datastream_id WHERE known AND local_n < remote_n AND utc_time > start AND utc_time <= remote_last""")
def sync_delta(t):
    obs = observations(t)
    uuid = F.concat(F.lit("uuid-"), F.col("datastream_id").cast("string")).alias("datastream_uuid")
    shape = ["datastream_id", uuid, F.col("first_good").alias("first_measurement_date"), F.col("last_good").alias("last_measurement_date"),
             F.col("good_count").alias("total_measurement_numbers")]
    remote = good_summary(obs).select(*shape)
    local = good_summary(obs.filter((F.col("utc_time") < _CUT) & (F.col("datastream_id") % 8 != 0))).select(*shape).withColumn(
        "datastream_id", F.col("datastream_id") + 500000)
    out = checks.sync_delta(local, remote, obs)
    moved = out["registry"].select("datastream_id", F.col("last_measurement_date").alias("new_last"),
                                   F.col("total_measurement_numbers").alias("new_count"))
    return out["rows"].join(moved, "datastream_id").withColumn("data_value", r4(F.col("data_value")))


@query("sync_first_load", f"""
WITH {OBS_SQL}, {_SYNC_SQL}
SELECT id + 500000 AS datastream_id, utc_time, {sql_r4('CASE WHEN NOT isnan(data_value) THEN data_value END')} AS data_value, qa_flag, l AS new_last, n AS new_count
FROM obs JOIN remote ON id = datastream_id WHERE n > 0 AND utc_time >= f AND utc_time <= l""")
def sync_first_load(t):
    """All streams are known and none has a reading yet: the first ones come too."""
    obs = observations(t)
    remote = good_summary(obs).select(
        "datastream_id", F.concat(F.lit("uuid-"), F.col("datastream_id").cast("string")).alias("datastream_uuid"), F.col("first_good").alias("first_measurement_date"),
        F.col("last_good").alias("last_measurement_date"), F.col("good_count").alias("total_measurement_numbers"))
    local = remote.withColumns({"datastream_id": F.col("datastream_id") + 500000} | {
        c: F.lit(None).cast("bigint") for c in ("first_measurement_date", "last_measurement_date", "total_measurement_numbers")})
    out = checks.sync_delta(local, remote, obs)
    moved = out["registry"].select("datastream_id", F.col("last_measurement_date").alias("new_last"), F.col("total_measurement_numbers").alias("new_count"))
    return out["rows"].join(moved, "datastream_id").withColumn("data_value", r4(F.col("data_value")))


@query("snapshot_rows", """
SELECT 'region' AS table_name, count(*) AS row_count, CAST(sum(r_regionkey) AS BIGINT) AS key_sum FROM region
UNION ALL SELECT 'nation', count(*), CAST(sum(n_nationkey) AS BIGINT) FROM nation UNION ALL SELECT 'customer', count(*), CAST(sum(c_custkey) AS BIGINT) FROM customer
UNION ALL SELECT 'orders', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM orders""")
def snapshot_rows(t):
    path = scratch_path(t.spark, "snapshot")
    keys = {"region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "orders": "o_orderkey"}
    frames = {name: getattr(t, name) for name in keys} | {"supplier": t.supplier, "nothing": t.region.limit(0)}
    written = sinks.snapshot(frames, path, exclude=["supplier"])
    out = None
    for name in written:
        read = t.spark.read.schema(frames[name].schema).json(f"{path}/{name}")
        line = read.agg(F.count("*").alias("row_count"), F.sum(keys[name]).alias("key_sum")).select(F.lit(name).alias("table_name"), "*")
        out = line if out is None else out.unionByName(line)
    return out


@query("variables_with_ranges", """
SELECT p_partkey AS variable_id, p_type AS variable_domain_cv, CASE WHEN p_size > 10 THEN CAST(-1.0 * p_size AS DOUBLE) END AS min_valid_range,
       CASE WHEN p_size > 10 THEN p_retailprice END AS max_valid_range FROM part""")
def variables_with_ranges(t):
    v = _variables(t)
    ranges = v.filter("min_valid_range < -10").select("variable_id", "min_valid_range", "max_valid_range")
    return checks.variables_with_ranges(v.select("variable_id", "variable_domain_cv"), ranges)


@query("mapping_changes", """
SELECT 'added' AS change, CAST(1 AS BIGINT) AS times, p_partkey, 'x' || p_name AS p_name FROM part WHERE p_size < 5
UNION ALL SELECT 'removed', 1, p_partkey, p_name FROM part WHERE p_size < 5
UNION ALL SELECT 'removed', 1, p_partkey, p_name FROM part WHERE p_size >= 45""")
def mapping_changes(t):
    old = t.part.select("p_partkey", "p_name")
    new = t.part.filter("p_size < 45").select("p_partkey", F.when(F.col("p_size") < 5, F.concat(F.lit("x"), "p_name")).otherwise(F.col("p_name")).alias("p_name"))
    return sinks.row_changes(old, new)


@query("source_entries", """
WITH d AS (SELECT p_partkey, p_brand || p_partkey AS site, p_brand || p_partkey || '_' || p_type AS device_name, p_size FROM part)
SELECT device_name, p_partkey AS device_id, lower(device_name) AS feeder_table, site, 'proj/hydro/' || device_name AS path
FROM d WHERE device_name NOT IN (SELECT device_name FROM d WHERE p_size = 9)""")
def source_entries(t):
    devices = t.part.select(F.col("p_partkey").alias("id"), F.concat("p_brand", F.col("p_partkey").cast("string")).alias("location"), F.col("p_type").alias("model"))
    existing = t.part.filter("p_size = 9").select(F.concat_ws("_", F.concat("p_brand", F.col("p_partkey").cast("string")), "p_type").alias("device_name"))
    pick = lambda path: F.get_json_object("entry", f"$.{path}")
    return checks.source_entries(devices, existing, "hydro", "proj", "auth.yml").select(
        "device_name", pick("harvesting_info.device_id").cast("bigint").alias("device_id"), pick("ingestion_info.feeder_table").alias("feeder_table"),
        pick("processing_info.sampling_feature_code").alias("site"), pick("shared_info.data_source_path").alias("path"))


@query("stream_downsample", f"""
WITH {OBS_SQL}
SELECT datastream_id, utc_time - utc_time % 86400 AS bucket_epoch, {sql_r4('avg(data_value)')} AS mean, count(data_value) AS count, max(data_value) AS max
FROM obs WHERE qa_flag >= 'z' GROUP BY 1, 2""")
def stream_downsample(t):
    source, target = scratch_path(t.spark, "arrivals"), scratch_path(t.spark, "buckets")
    observations(t).write.parquet(source)
    stream = downsample_stream(read_observations(t.spark, source), "1 day", ["mean", "count", "max"], "1 hour")

    def keep(batch, number):
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    run = (stream.writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", f"{target}-state")
           .trigger(availableNow=True).start())
    run.awaitTermination()
    last = t.spark.read.parquet(target).agg(F.max("batch")).first()[0]
    return t.spark.read.parquet(target).filter(F.col("batch") == last).select(
        "datastream_id", "bucket_epoch", r4(F.col("mean")).alias("mean"), "count", "max")


@query("stream_append", f"WITH {OBS_SQL} SELECT datastream_id, utc_time, qa_flag FROM obs")
def stream_append(t):
    source, target = scratch_path(t.spark, "arrivals"), scratch_path(t.spark, "store")
    obs = observations(t)
    for half in (F.col("utc_time") < _CUT, F.col("utc_time") >= _CUT):
        obs.filter(half).write.mode("append").parquet(source)
        append_new(read_observations(t.spark, source), target, f"{target}-state").awaitTermination()
    return t.spark.read.parquet(target).select("datastream_id", "utc_time", "qa_flag")
