"""Sample processing."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorlake.functions.timezones import label_offset, shift_seconds
from sensorlake.operators import samples
from sensorlake.sources import mappers
from suite.registry import query, stamp

# Cell texts by line number: plain, missing, censored, qualified, both, remark only, timestamp-like, non-detect.
_KIND = "l_linenumber % 8"
_CELL_SQL = f"""CASE {_KIND} WHEN 0 THEN CAST(l_quantity AS VARCHAR) WHEN 1 THEN 'nan' WHEN 2 THEN '< ' || CAST(l_tax AS VARCHAR)
  WHEN 3 THEN CAST(l_quantity AS VARCHAR) || ' dk' WHEN 4 THEN 'E  ' || CAST(l_quantity AS VARCHAR) || ' d' WHEN 5 THEN 'M'
  WHEN 6 THEN '  7.5e1 ' ELSE '2001-02-03 04:05:06' END"""
_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
_KEYS_SQL = ", ".join(_KEYS)
_PARSED_SQL = f"""
p AS (SELECT {_KEYS_SQL}, {_KIND} AS k,
  CASE {_KIND} WHEN 2 THEN '<' WHEN 4 THEN 'E' WHEN 5 THEN 'M' END AS remark,
  CASE {_KIND} WHEN 0 THEN CAST(l_quantity AS VARCHAR) WHEN 1 THEN 'nan' WHEN 2 THEN CAST(l_tax AS VARCHAR) WHEN 3 THEN CAST(l_quantity AS VARCHAR)
    WHEN 4 THEN CAST(l_quantity AS VARCHAR) WHEN 6 THEN '7.5e1' WHEN 7 THEN '2001-02-03 04:05:06' END AS value,
  CASE {_KIND} WHEN 3 THEN 'dk' WHEN 4 THEN 'd' END AS qualifiers FROM lineitem)"""


def cells(t):
    k, quantity = F.col("l_linenumber") % 8, F.col("l_quantity").cast("string")
    cell = (F.when(k == 0, quantity).when(k == 1, "nan").when(k == 2, F.concat(F.lit("< "), F.col("l_tax").cast("string")))
            .when(k == 3, F.concat(quantity, F.lit(" dk"))).when(k == 4, F.concat(F.lit("E  "), quantity, F.lit(" d")))
            .when(k == 5, "M").when(k == 6, "  7.5e1 ").otherwise("2001-02-03 04:05:06"))
    return t.lineitem.select(*_KEYS, cell.alias("cell"))


def _dims(t):
    return (mappers.table(t.spark, mappers.REMARKS_COLUMNS, mappers.REMARKS),
            mappers.table(t.spark, mappers.QUALIFIERS_COLUMNS, mappers.QUALIFIERS))


@query("annotated_values", f"WITH {_PARSED_SQL} SELECT {_KEYS_SQL}, remark, value, qualifiers FROM p")
def annotated_values(t):
    return samples.annotate(cells(t), "cell").drop("cell")


_NAMES = dict(mappers.QUALIFIERS)


@query("qualifier_expand", f"""
WITH {_PARSED_SQL}
SELECT {_KEYS_SQL}, CASE remark WHEN '<' THEN 'lessThan' WHEN 'E' THEN 'estimated' WHEN 'M' THEN 'presentButNotQuantified' END AS censor_code,
  CASE qualifiers WHEN 'dk' THEN '{_NAMES["d"]}|{_NAMES["k"]}' WHEN 'd' THEN '{_NAMES["d"]}' ELSE '' END AS names, 0 AS unknown FROM p""")
def qualifier_expand(t):
    out = samples.expand_qualifiers(samples.annotate(cells(t), "cell"), *_dims(t))
    return out.select(*_KEYS, "censor_code", F.array_join("qualifier_names", "|").alias("names"), F.size("unknown_codes").alias("unknown"))


@query("result_qualifiers", f"""
WITH {_PARSED_SQL}
SELECT {_KEYS_SQL}, 'lessThan' AS property_value FROM p WHERE k = 2
UNION ALL SELECT {_KEYS_SQL}, 'estimated' FROM p WHERE k = 4
UNION ALL SELECT {_KEYS_SQL}, '{_NAMES["d"]}' FROM p WHERE k IN (3, 4)
UNION ALL SELECT {_KEYS_SQL}, '{_NAMES["k"]}' FROM p WHERE k = 3""")
def result_qualifiers(t):
    out = samples.expand_qualifiers(samples.annotate(cells(t), "cell"), *_dims(t))
    return samples.result_qualifiers(out, _KEYS).drop("property_name")


@query("samples_unpivot", """
WITH w AS (SELECT l_orderkey, l_linenumber, 'flow' AS column_name, CASE WHEN l_discount = 0 THEN 'nan' ELSE CAST(l_quantity AS VARCHAR) END AS cell,
                  'streamFlow' AS variable_term, 'cubicFootPerSecond' AS units_term, 0 AS missing FROM lineitem
           UNION ALL SELECT l_orderkey, l_linenumber, 'ph', CASE WHEN l_tax < 0.03 THEN '< ' || CAST(l_tax AS VARCHAR) ELSE CAST(l_tax AS VARCHAR) END, 'waterpH', 'ph', 0 FROM lineitem
           UNION ALL SELECT NULL, NULL, 'turbidity', NULL, NULL, NULL, 1)
SELECT l_orderkey, l_linenumber, column_name, cell, variable_term, units_term, missing FROM w WHERE missing = 1 OR cell <> 'nan'""")
def samples_unpivot(t):
    wide = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_discount") == 0, "nan").otherwise(F.col("l_quantity").cast("string")).alias("flow"),
        F.when(F.col("l_tax") < 0.03, F.concat(F.lit("< "), F.col("l_tax").cast("string"))).otherwise(F.col("l_tax").cast("string")).alias("ph"),
        F.col("l_returnflag").alias("turbidity"))
    column_map = t.spark.sql("SELECT * FROM VALUES ('flow', 'streamFlow'), ('ph', 'waterpH') AS m(column_name, variable_term)")
    units = t.spark.sql("SELECT * FROM VALUES ('flow', 'cubicFootPerSecond'), ('ph', 'ph'), ('turbidity', 'ntu') AS u(column_name, units_term)")
    known, to_add = samples.samples_to_results(wide, ["l_orderkey", "l_linenumber"], ["flow", "ph", "turbidity"], column_map, units)
    return known.withColumn("missing", F.lit(0)).unionByName(to_add.withColumn("missing", F.lit(1)), allowMissingColumns=True)


def _samples(t):
    """One water sample per line item, collected at the supplier's site."""
    return t.lineitem.select(
        F.concat(F.lit("site-"), F.col("l_suppkey").cast("string")).alias("sampling_feature_code"),
        shift_seconds(F.col("l_shipdate"), F.col("l_linenumber") * 3600).alias("timestamp"),
        F.col("l_returnflag").alias("file"), F.when(F.col("l_linestatus") == "F", "EST").otherwise("local").alias("timezone"))


_SAMPLES_SQL = """
s AS (SELECT DISTINCT l_suppkey, l_shipdate + l_linenumber * INTERVAL 1 HOUR AS ts,
             'site-' || CAST(l_suppkey AS VARCHAR) || '_geochem' || strftime(l_shipdate + l_linenumber * INTERVAL 1 HOUR, '%Y-%m-%d-%H-%M-%S') AS code
      FROM lineitem)"""


@query("make_specimens", f"""
WITH {_SAMPLES_SQL}
SELECT code, 'Specimen collected at site-' || CAST(l_suppkey AS VARCHAR) AS description, s_acctbal AS elevation_m, CAST(l_suppkey AS DOUBLE) AS latitude,
       'specimen' AS kind, 'wasCollectedAt' AS relation, 'grab' AS specimen_type, CAST(77 AS BIGINT) AS collection
FROM s JOIN supplier ON s_suppkey = l_suppkey WHERE code NOT LIKE '%1998-03-%'""")
def make_specimens(t):
    sites = t.supplier.select(
        F.concat(F.lit("site-"), F.col("s_suppkey").cast("string")).alias("sampling_feature_code"), F.lit("POINT(0 0)").alias("feature_geometry_wkt"),
        F.col("s_acctbal").alias("elevation_m"), F.col("s_suppkey").cast("double").alias("latitude"), F.lit(0.0).alias("longitude"))
    code = samples.specimen_code(F.col("sampling_feature_code"), F.col("timestamp"))
    stored = _samples(t).filter("year(timestamp) = 1998 AND month(timestamp) = 3").select(code.alias("sampling_feature_code")).distinct()
    out = samples.make_specimens(_samples(t), sites.unionByName(stored, allowMissingColumns=True), "wasCollectedAt", 77)
    joined = (out["features"].join(out["edges"], "sampling_feature_id").join(out["specimens"], "sampling_feature_id")
              .join(out["collections"], "sampling_feature_id"))
    return joined.select(F.col("sampling_feature_code").alias("code"), F.col("sampling_feature_description").alias("description"), "elevation_m",
                         "latitude", F.col("sampling_feature_type_cv").alias("kind"), F.col("relationship_type_cv").alias("relation"),
                         F.col("specimen_type_cv").alias("specimen_type"), F.col("specimen_collection_id").alias("collection"))


@query("feature_actions", """
WITH s AS (SELECT l_returnflag AS file, l_suppkey, l_shipdate + l_linenumber * INTERVAL 1 HOUR AS ts, l_linestatus FROM lineitem)
SELECT file, min(CAST(epoch_us(ts) // 1000000 AS BIGINT)) AS begin_time, -4 AS utc_offset, count(DISTINCT (l_suppkey, ts)) AS specimens FROM s GROUP BY file""")
def feature_actions(t):
    out = samples.make_actions(_samples(t), "file")
    linked = out["feature_actions"].groupBy("action_id").agg(F.count("*").alias("specimens"))
    return out["actions"].join(linked, "action_id").select(
        "file", stamp(F.col("begin_date_time")).alias("begin_time"), F.col("begin_date_time_utc_offset").alias("utc_offset"), "specimens")


@query("tz_label_offset", """
SELECT l_orderkey, l_linenumber, CASE l_linenumber % 4 WHEN 0 THEN -4 WHEN 1 THEN -7 WHEN 2 THEN -8 ELSE 0 END AS utc_offset FROM lineitem""")
def tz_label_offset(t):
    k = F.col("l_linenumber") % 4
    label = F.when(k == 0, "Eastern Standard Time").when(k == 1, "mst").when(k == 2, "PST").otherwise("local")
    return t.lineitem.select("l_orderkey", "l_linenumber", label_offset(label).alias("utc_offset"))


@query("result_rows", """
WITH long AS (
  SELECT o_orderkey, i, i = 1 AS is_stddev, o_orderdate,
    CASE WHEN i = 0 AND o_custkey % 5 = 0 THEN 'n.d.' WHEN i = 2 AND o_custkey % 7 = 0 THEN 'trace' ELSE CAST(o_totalprice AS VARCHAR) END AS cell,
    CASE WHEN i = 2 THEN CAST(1.5 AS DOUBLE) END AS depth, o_orderstatus = 'P' AS annotated FROM orders, (VALUES (0), (1), (2)) v(i))
SELECT o_orderkey, CASE WHEN i = 2 THEN 2 ELSE 0 END AS reading,
  CASE WHEN cell IN ('n.d.', 'trace') THEN 0.0 ELSE CAST(cell AS DOUBLE) END AS data_value,
  CASE WHEN is_stddev THEN 'standardDeviation' ELSE 'instrumentReading' END AS statistic,
  CASE WHEN cell = 'n.d.' THEN 'nonDetect' ELSE 'notCensored' END AS censor_code,
  CASE WHEN annotated THEN 'marginal' ELSE 'notAssessed' END AS quality_code, -7 AS utc_offset, depth AS z_location, 'complete' AS status
FROM long""")
def result_rows(t):
    specimen = F.concat(F.lit("sp-"), F.col("o_orderkey").cast("string")).alias("specimen_code")
    base = t.orders.select("o_orderkey", "o_custkey", specimen, F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("position"),
                           "o_totalprice", "o_orderdate", "o_orderstatus")
    i = F.col("position")
    cell = (F.when((i == 0) & (F.col("o_custkey") % 5 == 0), "n.d.").when((i == 2) & (F.col("o_custkey") % 7 == 0), "trace")
            .otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string")))
    long = base.select("o_orderkey", "specimen_code", "position", F.lit("streamFlow").alias("variable_term"), F.lit("foot").alias("units_term"),
                       cell.alias("cell"), F.col("o_orderdate").alias("timestamp"), F.lit("MST").alias("timezone"),
                       F.when(i == 2, 1.5).alias("depth_m"), (i == 1).alias("is_stddev"), (F.col("o_orderstatus") == "P").alias("annotated"))
    out = samples.make_results(long)
    keys = base.filter("position <> 1").select("o_orderkey", F.col("position").alias("reading"),
                                               F.xxhash64("specimen_code", "position").alias("result_id"))
    depth = out["measurement_results"].select("result_id", F.col("z_location").alias("depth"))
    status = out["results"].select("result_id", F.col("status_cv").alias("status"))
    rows = out["values"].join(keys, "result_id").join(depth, "result_id").join(status, "result_id")
    return rows.select("o_orderkey", "reading", "data_value", F.col("aggregation_statistic_cv").alias("statistic"),
                       F.col("censor_code_cv").alias("censor_code"), F.col("quality_code_cv").alias("quality_code"),
                       F.col("value_date_time_utc_offset").alias("utc_offset"), F.col("depth").alias("z_location"), "status")
