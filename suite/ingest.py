"""File sources and shaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorlake.functions.names import CSV_HEADER_REPLACEMENTS, HEADER_REPLACEMENTS, clean_name_col
from sensorlake.functions.numbers import coerce_numeric
from sensorlake.functions.timezones import ntz_to_epoch, shift_seconds, utc_to_local
from sensorlake.operators import mapping, shaping
from sensorlake.plans.stages import ingest_files
from sensorlake.session import scratch_path
from sensorlake.sources import manifest, mappers, readers, sinks, store, waterml
from suite.registry import query, r4, sql_r4, sql_stamp, stamp
from suite.views import RAW_SQL, raw_values


def _time():
    """Distinct-looking reading time of a line item: ship date plus hours and minutes from its keys."""
    seconds = F.col("l_linenumber") * 3600 + F.col("l_partkey") % 3600
    return shift_seconds(F.col("l_shipdate"), seconds)


_TIME_SQL = "(l_shipdate + (l_linenumber * 3600 + l_partkey % 3600) * INTERVAL 1 SECOND)"


@query("csv_source_roundtrip", f"""
SELECT DISTINCT {sql_stamp(_TIME_SQL)} AS timestamp, l_quantity AS flow_rate,
       CASE WHEN l_orderkey % 2 = 0 THEN l_tax END AS ph, CASE WHEN l_orderkey % 2 = 1 THEN l_extendedprice END AS level_m FROM lineitem""")
def csv_source_roundtrip(t):
    path = scratch_path(t.spark, "csv")
    base = t.lineitem.withColumn("datetime", F.date_format(_time().cast("timestamp"), "yyyy-MM-dd HH:mm:ss"))
    even, odd = base.filter("l_orderkey % 2 = 0"), base.filter("l_orderkey % 2 = 1")
    sinks.write_csv(even.select("datetime", F.col("l_quantity").alias("Flow rate"), F.col("l_tax").alias("pH")), f"{path}/a")
    sinks.write_csv(odd.select(F.col("l_extendedprice").alias("Level-m"), "datetime", F.col("l_quantity").alias("Flow rate")), f"{path}/b")
    df = readers.read_csv_source(t.spark, path)
    value = lambda c: F.nanvl(c, F.lit(None).cast("double")).alias(c)
    return df.select(stamp(F.col("timestamp")).alias("timestamp"), value("flow_rate"), value("ph"), value("level_m"))


def _dat_files(t):
    """One logger folder per line number, four header lines each."""
    path = scratch_path(t.spark, "dat")
    cells = F.concat_ws(",", F.date_format(_time().cast("timestamp"), '"yyyy-MM-dd HH:mm:ss"').alias("ts"),
                        F.col("l_quantity").cast("string"),
                        F.when(F.col("l_discount") == 0.05, '"NAN"').otherwise(F.col("l_tax").cast("string")))
    lines = t.lineitem.select(F.col("l_linenumber").alias("logger"), F.lit(9).alias("position"), cells.alias("value"))
    heads = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(x).alias("value")) for i, x in enumerate(
        ('"TOA5","station","CR1000"', '"TIMESTAMP","Batt_V","Temp_C"', '"TS","Volts","Deg C"', '"","Min","Avg"'))])
    header = t.lineitem.select(F.col("l_linenumber").alias("logger")).distinct().select(
        "logger", F.explode(heads).alias("h")).select("logger", "h.*")
    (lines.unionByName(header).repartition("logger").sortWithinPartitions("logger", "position").select("logger", "value")
     .write.partitionBy("logger").text(path))
    return path


@query("logger_dat_ingest", f"""
SELECT DISTINCT {sql_stamp(_TIME_SQL)} AS timestamp, l_quantity AS batt_v,
       CASE WHEN l_discount <> 0.05 THEN l_tax END AS temp_c FROM lineitem""")
def logger_dat_ingest(t):
    df = readers.read_logger_dat(t.spark, _dat_files(t), glob="*.txt")
    value = lambda c: F.nanvl(c, F.lit(None).cast("double")).alias(c)
    return df.select(stamp(F.col("timestamp")).alias("timestamp"), value("batt_v"), value("temp_c"))


@query("prune_stale_files", """
WITH f AS (SELECT o_orderstatus AS source, o_orderstatus || '_' || strftime(o_orderdate, '%Y%m') AS file,
                  max(o_orderdate) AS last_time FROM orders GROUP BY 1, 2)
SELECT source, file, CAST(epoch_us(last_time) // 1000000 AS BIGINT) AS last_time FROM f
WHERE source = 'P' OR last_time > CASE source WHEN 'O' THEN TIMESTAMP '1998-06-15' ELSE TIMESTAMP '1996-02-29' END""")
def prune_stale_files(t):
    """Real files, one per status and month: the last line of each says how far it goes."""
    path = scratch_path(t.spark, "orders")
    rows = t.orders.select("o_orderstatus", F.date_format("o_orderdate", "yyyyMM").alias("month"),
                           F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd HH:mm:ss").alias("datetime"), "o_totalprice")
    (rows.repartition("o_orderstatus", "month").sortWithinPartitions("o_orderstatus", "month", "datetime")
     .write.partitionBy("o_orderstatus", "month").option("header", "true").csv(path))
    looks = manifest.look(t.spark, manifest.list_files(t.spark, path, "*.csv"))
    part = lambda name: F.regexp_extract("file", f"{name}=([^/]+)", 1)
    files = readers.last_times(t.spark, looks, "datetime").select(
        part("o_orderstatus").alias("source"), F.concat(part("o_orderstatus"), F.lit("_"), part("month")).alias("file"), "last_time")
    water = t.spark.sql("SELECT source, CAST(d AS TIMESTAMP_NTZ) AS stored_time FROM VALUES ('O', '1998-06-15'), "
                        "('F', '1996-02-29') AS v(source, d)")
    return readers.prune_files(files, water).withColumn("last_time", stamp(F.col("last_time")))


@query("csv_missing_time", f"""
SELECT 'row' AS part, {sql_stamp("date_trunc('second', ts)")} AS timestamp, value, NULL AS folder FROM events WHERE event_type NOT IN ('error', 'view') GROUP BY ALL
UNION ALL SELECT DISTINCT 'file', NULL, NULL, event_type FROM events WHERE event_type IN ('error', 'view')""")
def csv_missing_time(t):
    """A folder of files per kind of event; two kinds have no time column, one of them has the word in its cells."""
    path = scratch_path(t.spark, "events")
    time = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss")
    for kind in ("click", "error", "purchase", "signup", "view"):
        rows = t.events.filter(F.col("event_type") == kind)
        named = rows.select(time.alias("when"), F.lit("datetime").alias("value")) if kind in ("error", "view") else rows.select("value", time.alias("datetime"))
        sinks.write_csv(named, f"{path}/{kind}")
    good = readers.read_csv_source(t.spark, path, missing="skip").select(
        F.lit("row").alias("part"), stamp(F.col("timestamp")).alias("timestamp"), "value", F.lit(None).cast("string").alias("folder"))
    bad = readers.files_without_time(t.spark, path).select(
        F.lit("file").alias("part"), F.lit(None).cast("bigint").alias("timestamp"), F.lit(None).cast("double").alias("value"),
        F.regexp_extract("file", "/([a-z]+)/[^/]+$", 1).alias("folder")).distinct()
    return good.unionByName(bad)


@query("manifest_load", f"""
SELECT {sql_stamp("date_trunc('second', ts)")} AS timestamp, CAST(min(event_id) AS DOUBLE) AS number, true AS unchanged_files_skipped, true AS stale_files_skipped
FROM events WHERE ts < TIMESTAMP '2024-01-21' GROUP BY 1""")
def manifest_load(t):
    """Three deliveries into one folder: new files are read, files seen before are not, and files that end before the newest time are not either."""
    path, table = scratch_path(t.spark, "deliveries"), store.feeder_layout(scratch_path(t.spark, "feeder"))
    seen = manifest.manifest_layout(scratch_path(t.spark, "manifest"))

    def deliver(name, condition):
        rows = t.events.filter(condition).select(F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss").alias("datetime"), F.col("event_id").alias("number"))
        sinks.write_csv(rows.repartitionByRange("datetime").sortWithinPartitions("datetime"), f"{path}/{name}")
        return ingest_files(t.spark, path, table, seen)

    day = lambda k: F.lit(f"2024-01-{k:02d} 00:00:00").cast("timestamp_ntz")
    deliver("a", F.col("ts") < day(11))
    deliver("b", (F.col("ts") >= day(11)) & (F.col("ts") < day(21)))
    again = ingest_files(t.spark, path, table, seen)
    old = deliver("c", F.col("ts") < day(5))
    return store.read(t.spark, table).select(
        stamp(F.col("timestamp")).alias("timestamp"), "number", F.lit(again.new == 0 and again.listed > 1).alias("unchanged_files_skipped"),
        F.lit(old.new > 0 and old.stale == old.new and old.rows is None).alias("stale_files_skipped"))


@query("header_repair", f"""
SELECT DISTINCT {sql_stamp(_TIME_SQL)} AS timestamp, l_quantity AS wind, l_tax AS precipitation_type, l_discount AS battery FROM lineitem""")
def header_repair(t):
    path = scratch_path(t.spark, "weather")
    header = "time_epoch[s],wind[m/s],precipitation_type<0,none,1,rain>,battery[V]"
    rows = t.lineitem.select(
        F.lit(9).alias("position"), F.pmod("l_orderkey", F.lit(4)).alias("part"),
        F.concat_ws(",", ntz_to_epoch(_time()), "l_quantity", "l_tax", "l_discount").alias("value"))
    head = t.spark.range(4).select(F.lit(0).alias("position"), F.col("id").alias("part"), F.lit(header).alias("value"))
    (rows.unionByName(head).repartition("part").sortWithinPartitions("part", "position").select("part", "value")
     .write.partitionBy("part").text(path))
    df = readers.read_epoch_csv(t.spark, path, "time_epoch[s]", "precipitation_type", 4, glob="*.txt")
    return df.select(stamp(F.col("timestamp")).alias("timestamp"), F.col("`wind[m/s]`").alias("wind"),
                     F.col("`precipitation_type<0,none,1,rain>`").alias("precipitation_type"),
                     F.col("`battery[v]`").alias("battery"))


@query("payload_flatten", f"""
WITH r AS (SELECT l_orderkey AS device, CAST(epoch_us(l_shipdate) // 1000000 AS BIGINT) AS timestamp, l_linestatus, l_quantity FROM lineitem)
SELECT device, timestamp, min(l_quantity) FILTER (l_linestatus = 'F') AS temperature_c,
       min(l_quantity) FILTER (l_linestatus = 'O') AS ph_ph, CAST(NULL AS DOUBLE) AS depth_m
FROM r GROUP BY 1, 2""")
def payload_flatten(t):
    reading = F.struct(ntz_to_epoch(F.col("l_shipdate")).alias("timestamp"), F.col("l_quantity").alias("value"))
    per_parameter = t.lineitem.groupBy("l_orderkey", "l_linestatus").agg(F.collect_list(reading).alias("readings"))
    warm = F.col("l_linestatus") == "F"
    parameter = F.struct(F.when(warm, "1").otherwise("17").alias("parameterId"),
                         F.when(warm, "1").otherwise("145").alias("unitId"), "readings")
    payloads = per_parameter.groupBy(F.col("l_orderkey").alias("device")).agg(
        F.to_json(F.struct(F.collect_list(parameter).alias("parameters"))).alias("body"))
    wide = readers.flatten_payload(
        payloads, "body", ["device"], mappers.table(t.spark, mappers.HYDROVU_PARAMETERS_COLUMNS, mappers.HYDROVU_PARAMETERS),
        mappers.table(t.spark, mappers.HYDROVU_UNITS_COLUMNS, mappers.HYDROVU_UNITS),
        ["Temperature[C]", "pH[pH]", "Depth[m]"])
    return wide.select("device", "timestamp", F.col("`Temperature[C]`").alias("temperature_c"),
                       F.col("`pH[pH]`").alias("ph_ph"), F.col("`Depth[m]`").alias("depth_m"))


def _series_xml(t):
    """One timeSeries element per order, one value per line item."""
    value = F.format_string('<value dateTime="%s" censorCode="%s" methodID="%s" qualifiers="%s">%s</value>',
                            F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lower("l_returnflag"),
                            F.lit("7"), F.col("l_linestatus"), F.col("l_quantity").cast("string"))
    grouped = t.lineitem.groupBy("l_orderkey").agg(F.concat_ws("", F.collect_list(value)).alias("values"))
    return grouped.select("l_orderkey", F.format_string(
        '<timeSeries><sourceInfo><siteName>Site %s</siteName><siteCode network="NET">S%s</siteCode></sourceInfo>'
        '<variable><variableCode vocabulary="V" variableID="3">VAR%s</variableCode><variableName>level</variableName>'
        '<unit><unitName>meter</unitName><unitAbbreviation>m</unitAbbreviation></unit></variable>'
        '<values>%s<method methodID="7"><methodDescription>float</methodDescription></method></values></timeSeries>',
        F.col("l_orderkey").cast("string"), F.col("l_orderkey").cast("string"), F.pmod("l_orderkey", F.lit(10)).cast("string"),
        F.col("values")).alias("xml"))


@query("waterml_values", """
SELECT 'S' || CAST(l_orderkey AS VARCHAR) AS site_code, 'VAR' || CAST(l_orderkey % 10 AS VARCHAR) AS variable_code,
       'meter' AS units, '7' AS method_id, CAST(epoch_us(l_shipdate) // 1000000 AS BIGINT) AS timestamp,
       l_quantity AS value, lower(l_returnflag) AS censor_code, l_linestatus AS qualifiers FROM lineitem""")
def waterml_values(t):
    path = scratch_path(t.spark, "waterml")
    part = F.pmod("l_orderkey", F.lit(8)).alias("part")
    rows = _series_xml(t).select(part, F.lit(1).alias("position"), F.col("xml").alias("value"))
    ends = t.spark.range(8).select(F.col("id").alias("part"), F.explode(F.array(
        F.struct(F.lit(0).alias("position"), F.lit("<timeSeriesResponse>").alias("value")),
        F.struct(F.lit(2).alias("position"), F.lit("</timeSeriesResponse>").alias("value")))).alias("e"))
    (rows.unionByName(ends.select("part", "e.*")).repartition("part").sortWithinPartitions("part", "position")
     .select("part", "value").write.partitionBy("part").text(path))
    series = waterml.read_xml(t.spark, path, "timeSeries", waterml.TIME_SERIES)
    return waterml.values(series).select("site_code", "variable_code", "units", "method_id",
                                         stamp(F.col("timestamp")).alias("timestamp"), "value", "censor_code", "qualifiers")


def _site_xml(t):
    c = lambda name: F.col(name).cast("string")
    return t.orders.select("o_orderkey", F.format_string(
        '<site><siteInfo><siteName>Creek %s</siteName><siteCode network="NET" agencyCode="A">%s</siteCode>'
        '<timeZoneInfo siteUsesDaylightSavingsTime="true"><defaultTimeZone zoneAbbreviation="MST" zoneOffset="-07:00"/></timeZoneInfo>'
        '<geoLocation><geogLocation srs="EPSG:4326"><latitude>%s</latitude><longitude>-105.5</longitude></geogLocation></geoLocation>'
        '<elevation_m>%s</elevation_m><siteProperty name="Site Type">%s</siteProperty><siteProperty name="County">%s</siteProperty></siteInfo>'
        '<seriesCatalog><series><variable><variableCode vocabulary="V">Q</variableCode><variableName>flow</variableName></variable>'
        '<valueCount>%s</valueCount><variableTimeInterval><beginDateTime>1990-01-01</beginDateTime></variableTimeInterval></series>'
        '<series><variable><variableCode vocabulary="V">T</variableCode><variableName>temperature</variableName></variable>'
        '<valueCount>5</valueCount></series></seriesCatalog></site>',
        c("o_orderkey"), c("o_orderkey"), (F.pmod("o_custkey", F.lit(90)) + 0.5).cast("string"), c("o_totalprice"),
        F.col("o_orderstatus"), F.col("o_orderpriority"), c("o_custkey")).alias("xml"))


@query("waterml_sites", """
SELECT CAST(o_orderkey AS VARCHAR) AS code, 'Creek ' || CAST(o_orderkey AS VARCHAR) AS name, 'A' AS agency,
       CAST(o_custkey % 90 + 0.5 AS DOUBLE) AS latitude, o_totalprice AS elevation_m, true AS uses_dst, '-07:00' AS utc_offset,
       o_orderstatus AS site_type, o_orderpriority AS county, v AS variable_code,
       CASE v WHEN 'Q' THEN o_custkey ELSE 5 END AS value_count
FROM orders, (VALUES ('Q'), ('T')) s(v)""")
def waterml_sites(t):
    rows = waterml.sites(waterml.parse_xml(_site_xml(t), "xml", "site", waterml.SITE, ["o_orderkey"]))
    return rows.select("code", "name", "agency", "latitude", "elevation_m", "uses_dst", "utc_offset",
                       F.col("properties")["site_type"].alias("site_type"), F.col("properties")["county"].alias("county"),
                       "variable_code", "value_count")


@query("waterml_variables", """
SELECT 'VAR' || CAST(p_size AS VARCHAR) AS variable_code, 'V' AS vocabulary, 'size ' || CAST(p_size AS VARCHAR) AS variable_name,
       'meter' AS units, 'm' AS units_abbreviation FROM part GROUP BY p_size""")
def waterml_variables(t):
    size = F.col("p_size").cast("string")
    xml = t.part.select("p_partkey", F.format_string(
        '<variable><variableCode vocabulary="V" variableID="%s">VAR%s</variableCode><variableName>size %s</variableName>'
        '<unit><unitName>meter</unitName><unitAbbreviation>m</unitAbbreviation></unit></variable>',
        size, size, size).alias("xml"))
    rows = waterml.variables(waterml.parse_xml(xml, "xml", "variable", waterml.VARIABLE, ["p_partkey"]))
    return rows.select("variable_code", "vocabulary", "variable_name", "units", "units_abbreviation")


@query("waterml_site_infos", """
SELECT CAST(o_orderkey AS VARCHAR) AS code, 'Creek ' || CAST(o_orderkey AS VARCHAR) AS name, 'NET' AS network,
       CAST(o_custkey % 90 + 0.5 AS DOUBLE) AS latitude, CAST(-105.5 AS DOUBLE) AS longitude, o_totalprice AS elevation_m FROM orders""")
def waterml_site_infos(t):
    info = F.concat(F.substring_index(F.substring_index("xml", "<site>", -1), "</siteInfo>", 1), F.lit("</siteInfo>"))
    elements = waterml.parse_xml(_site_xml(t).withColumn("xml", info), "xml", "siteInfo", waterml.SITE_INFO, ["o_orderkey"])
    return waterml.site_infos(elements.drop("o_orderkey")).select("code", "name", "network", "latitude", "longitude", "elevation_m")


@query("waterml_side_tables", """
SELECT DISTINCT 'VAR' || CAST(l_orderkey % 10 AS VARCHAR) AS variable_code, '7' AS method_id, 'float' AS method_description FROM lineitem""")
def waterml_side_tables(t):
    series = waterml.parse_xml(_series_xml(t), "xml", "timeSeries", waterml.TIME_SERIES, ["l_orderkey"])
    return waterml.side_table(series, "method").select("variable_code", F.col("_methodID").alias("method_id"),
                                                       F.col("methodDescription").alias("method_description"))


_SNOTEL_IDS = ", ".join(f"('{r[0]}', {i})" for i, r in enumerate(mappers.SNOTEL_VARIABLES))


@query("series_semi_join", f"""
WITH ids AS (SELECT * FROM (VALUES {_SNOTEL_IDS}) v(id, n))
SELECT p_partkey, 'SNOTEL:' || p_brand || ':' || coalesce(id, 'OTHER') AS series_code
FROM part LEFT JOIN ids ON n = p_size WHERE id IS NOT NULL""")
def series_semi_join(t):
    ids = F.array(*[F.lit(r[0]) for r in mappers.SNOTEL_VARIABLES])
    code = F.concat_ws(":", F.lit("SNOTEL"), "p_brand", F.coalesce(F.get(ids, F.col("p_size")), F.lit("OTHER")))
    series = t.part.select("p_partkey", code.alias("series_code"))
    return shaping.select_series(series, mappers.table(t.spark, mappers.SNOTEL_VARIABLES_COLUMNS, mappers.SNOTEL_VARIABLES))


_KINDS = ("click", "view", "error", "purchase", "signup", "refund")


@query("assemble_wide_pivot", "SELECT user_id, CAST(epoch_us(CAST(date_trunc('day', ts) AS TIMESTAMP)) // 1000000 AS BIGINT) AS day, "
       + ", ".join(f"arg_min(value, event_id) FILTER (event_type = '{k}') AS {k}" for k in _KINDS) + " FROM events GROUP BY 1, 2")
def assemble_wide_pivot(t):
    long = t.events.select("user_id", ntz_to_epoch(F.date_trunc("day", "ts").cast("timestamp_ntz")).alias("day"),
                           "event_type", "value", "event_id")
    return shaping.assemble_wide(long, ["user_id", "day"], "event_type", "value", list(_KINDS), order="event_id")


@query("mapper_projection", """
SELECT l_orderkey, l_linenumber, l_quantity AS temperature, l_extendedprice AS discharge FROM lineitem""")
def mapper_projection(t):
    raw = t.lineitem.withColumnsRenamed({"l_quantity": "00010", "l_extendedprice": "00060", "l_discount": "00010_cd",
                                         "l_tax": "00065_discontinued"})
    names = {r[0]: r[1] for r in mappers.NWIS}
    return shaping.prune_and_rename(raw, names, ["l_orderkey", "l_linenumber"])


@query("dedupe_first_per_ts", """
SELECT DISTINCT ON (l_suppkey, l_shipdate) l_suppkey, CAST(epoch_us(l_shipdate) // 1000000 AS BIGINT) AS ts,
       l_orderkey, l_linenumber, l_partkey, l_quantity
FROM lineitem ORDER BY l_suppkey, l_shipdate, l_orderkey, l_linenumber, l_partkey, l_quantity""")
def dedupe_first_per_ts(t):
    df = t.lineitem.select("l_suppkey", ntz_to_epoch(F.col("l_shipdate")).alias("ts"), "l_orderkey", "l_linenumber",
                           "l_partkey", "l_quantity")
    return shaping.dedupe_first(df, ["l_suppkey", "ts"], ["l_orderkey", "l_linenumber", "l_partkey"])


@query("utc_to_local", f"""
SELECT event_id, {sql_stamp("((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Denver')")} AS denver,
       {sql_stamp("((ts AT TIME ZONE 'UTC') AT TIME ZONE 'Asia/Kolkata')")} AS kolkata FROM events""")
def utc_to_local_query(t):
    return t.events.select("event_id", stamp(utc_to_local(F.col("ts"), "America/Denver")).alias("denver"),
                           stamp(utc_to_local(F.col("ts"), "Asia/Kolkata")).alias("kolkata"))


def _replace_sql(expression, pairs):
    for old, new in pairs:
        expression = f"replace({expression}, '{old}', '{new}')"
    return expression


_HEADER_SQL = "p_name || ' - ' || p_type || ' [µS/cm²]: 5% ^' || p_brand || '°'"


@query("clean_name_column", f"""
SELECT p_partkey, lower({_replace_sql(_HEADER_SQL, HEADER_REPLACEMENTS)}) AS name,
       {_replace_sql("lower(p_name || ' - ' || p_type || ' [m³/s] °C')", CSV_HEADER_REPLACEMENTS)} AS csv_name FROM part""")
def clean_name_column(t):
    header = F.concat("p_name", F.lit(" - "), "p_type", F.lit(" [µS/cm²]: 5% ^"), "p_brand", F.lit("°"))
    csv_header = F.concat("p_name", F.lit(" - "), "p_type", F.lit(" [m³/s] °C"))
    return t.part.select("p_partkey", clean_name_col(header).alias("name"), clean_name_col(csv_header, "csv").alias("csv_name"))


@query("expand_wildcards", """
SELECT p_partkey, p_brand || x AS name FROM part, (VALUES ('_a'), ('_b')) v(x)
UNION ALL SELECT p_partkey, p_type FROM part
UNION ALL SELECT p_partkey, 'Standard_' || p_type FROM part WHERE p_size > 25""")
def expand_wildcards(t):
    columns = F.array(F.concat("p_brand", F.lit("_a")), F.col("p_type"), F.concat("p_brand", F.lit("_b")),
                      F.concat(F.when(F.col("p_size") > 25, "Standard_").otherwise("Other_"), "p_type"))
    patterns = F.array(F.concat("p_brand", F.lit("_*")), F.col("p_type"), F.lit("Standard*"))
    return t.part.select("p_partkey", F.explode(mapping.expand_patterns(patterns, columns)).alias("name"))


@query("split_feeder_blocks", """
SELECT 'feeder_logger_creek' AS feeder_table, l_orderkey, l_linenumber, 'l_quantity' AS column_name, l_quantity AS value FROM lineitem
UNION ALL SELECT 'feeder_logger_creek', l_orderkey, l_linenumber, 'l_tax', l_tax FROM lineitem
UNION ALL SELECT 'feeder_logger_ridge', l_orderkey, l_linenumber, 'l_extendedprice', l_extendedprice FROM lineitem""")
def split_feeder_blocks(t):
    blocks = t.spark.sql("SELECT * FROM VALUES ('l_quantity', 'feeder_logger_creek'), ('l_tax', 'feeder_logger_creek'), "
                         "('l_extendedprice', 'feeder_logger_ridge') AS b(column_name, feeder_table)")
    df = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_tax", "l_extendedprice")
    return shaping.split_blocks_long(df, blocks, ["l_quantity", "l_tax", "l_extendedprice"], ["l_orderkey", "l_linenumber"])


@query("two_row_header", f"""
SELECT DISTINCT {sql_stamp(_TIME_SQL)} AS timestamp, 'flow' AS column_name, 'cubicFootPerSecond' AS units_term,
       CAST(l_quantity AS VARCHAR) AS cell FROM lineitem
UNION SELECT DISTINCT {sql_stamp(_TIME_SQL)}, 'ph', 'ph', CASE WHEN l_tax < 0.02 THEN '< 0.02' ELSE CAST(l_tax AS VARCHAR) END FROM lineitem""")
def two_row_header(t):
    path = scratch_path(t.spark, "geochem")
    cells = F.concat_ws(",", F.date_format(_time().cast("timestamp"), "yyyy-MM-dd HH:mm:ss"), "l_quantity",
                        F.when(F.col("l_tax") < 0.02, "< 0.02").otherwise(F.col("l_tax").cast("string")))
    head = [F.lit("datetime,flow,ph"), F.lit("timestamp,cubicFootPerSecond,ph")]
    # Every task writes a file of its own, and puts the header lines before its first row.
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    rows = t.lineitem.select(cells.alias("value"), first.alias("first"))
    lines = rows.select(F.explode(F.when(F.col("first"), F.array(*head, "value")).otherwise(F.array("value"))).alias("value"))
    # One more has no rows, so a header is there even if no line item is.
    empty = t.spark.range(0, 1, 1, 1).select(F.explode(F.array(*head)).alias("value"))
    lines.unionByName(empty).write.text(path)
    samples, units = readers.read_two_row_header(t.spark, path, glob="*.txt")
    long = samples.select(stamp(F.col("timestamp")).alias("timestamp"), "flow", "ph").unpivot(
        ["timestamp"], ["flow", "ph"], "column_name", "cell")
    return long.distinct().join(units, "column_name")


@query("coerce_numeric", f"""
WITH r AS (SELECT event_id, value, event_id % 11 AS k FROM events)
SELECT event_id, CASE WHEN k IN (5, 7) THEN NULL WHEN k IN (1, 2, 3) THEN NULL WHEN k = 9 THEN value * 1000 ELSE value END AS number,
       k IN (1, 2, 3) AS is_nan FROM r""")
def coerce_numeric_query(t):
    k, v = F.col("event_id") % 11, F.col("value").cast("string")
    text = (F.when(k == 1, "NAN").when(k == 2, "").when(k == 3, "Null").when(k == 5, F.concat(v, F.lit("d")))
            .when(k == 7, "ice").when(k == 9, F.concat(v, F.lit("e3"))).otherwise(F.concat(F.lit(" "), v)))
    number = coerce_numeric(text)
    return t.events.select("event_id", F.when(~F.isnan(number), number).alias("number"),
                           F.coalesce(F.isnan(number), F.lit(False)).alias("is_nan"))


@query("incremental_append", """
SELECT event_id, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS timestamp, value, event_type AS sensor, 
       (SELECT count(*) FROM events) AS rows_read, (SELECT count(*) FROM events WHERE event_id % 50 = 0) AS rows_without_time,
       (SELECT count(*) FROM events WHERE event_id % 50 <> 0 AND ts <= (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-16')) AS rows_not_newer
FROM events WHERE ts >= TIMESTAMP '2024-01-16' AND event_id % 50 <> 0""")
def incremental_append(t):
    existing = t.events.select("event_id", F.col("ts").alias("timestamp"), "value").filter("timestamp < TIMESTAMP_NTZ '2024-01-16'")
    new = t.events.select("event_id", F.when(F.col("event_id") % 50 != 0, F.col("ts")).alias("timestamp"), "value",
                          F.col("event_type").alias("sensor"))
    delta, stats = shaping.append_feeder(existing, new)
    out = delta.withColumn("timestamp", stamp(F.col("timestamp")))
    for name in ("rows_read", "rows_without_time", "rows_not_newer"):
        out = out.withColumn(name, stats.select(name).scalar())
    return out


@query("reconcile_append", """
SELECT o_orderkey, o_totalprice, o_orderstatus, NULL AS o_orderpriority FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, o_totalprice, NULL, o_orderpriority FROM orders WHERE o_orderstatus <> 'F'""")
def reconcile_append(t):
    old = t.orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice", "o_orderstatus")
    new = t.orders.filter("o_orderstatus <> 'F'").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return shaping.reconcile_append(old, new)


@query("copy_incremental", """
SELECT o_orderkey, o_totalprice, CAST(NULL AS VARCHAR) AS remark FROM orders
WHERE o_orderkey > (SELECT max(o_orderkey) FROM orders WHERE o_orderdate < TIMESTAMP '1995-01-05')""")
def copy_incremental(t):
    target = t.orders.filter("o_orderdate < TIMESTAMP_NTZ '1995-01-05'").select(
        "o_orderkey", "o_totalprice", F.lit(None).cast("string").alias("remark"))
    return shaping.copy_incremental(t.orders, target, "o_orderkey")


@query("ragged_rows", """
SELECT event_id, event_type AS kind, CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS who,
       CASE WHEN event_id % 3 = 2 THEN CAST(event_id AS VARCHAR) END AS number FROM events""")
def ragged_rows(t):
    kind, who, number = F.concat(F.lit(" "), "event_type", F.lit("  ")), F.col("user_id").cast("string"), F.col("event_id").cast("string")
    k = F.col("event_id") % 3
    cells = F.when(k == 0, F.array(kind, F.lit("  "))).when(k == 1, F.array(kind, who)).otherwise(
        F.array(kind, who, number, F.lit("extra"), F.lit("more")))
    return shaping.normalize_ragged(t.events.select("event_id", cells.alias("cells")), "cells", ["kind", "who", "number"], ["event_id"])


@query("image_metadata_clean", """
SELECT CAST(event_id AS VARCHAR) AS id, event_type || '.jpg' AS name, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS time,
       CAST(user_id % 5 * 100 AS INTEGER) AS width, 480 AS height, 'Cam' AS cameraMake FROM events
WHERE event_type <> 'error' AND event_id % 13 <> 0 AND user_id % 5 <> 0""")
def image_metadata_clean(t):
    time = F.when(F.col("event_id") % 13 != 0, F.date_format("ts", "yyyy:MM:dd HH:mm:ss")).otherwise("unknown")
    name = F.concat(F.when(F.col("event_type") == "error", ".").otherwise(" "), "event_type", F.lit(".jpg"))
    files = t.events.select(F.col("event_id").cast("string").alias("id"), name.alias("name"), F.struct(
        time.alias("time"), (F.col("user_id") % 5 * 100).cast("int").alias("width"), F.lit(480).alias("height"),
        F.lit("Cam ").alias("cameraMake")).alias("imageMediaMetadata"))
    return shaping.clean_image_metadata(files).withColumn("time", stamp(F.col("time")))


_MAP_VARS = ", ".join(f"('{r[1]}', '{r[2]}', {i})" for i, r in enumerate(mappers.SNOTEL_VARIABLES))
_MAP_UNITS = ", ".join(f"('{r[0]}', '{r[2]}', {i})" for i, r in enumerate(mappers.SNOTEL_UNITS))


@query("generate_column_map", f"""
WITH v AS (SELECT * FROM (VALUES {_MAP_VARS}) v(clean_name, cv_term, n)), u AS (SELECT * FROM (VALUES {_MAP_UNITS}) u(clean_name, cv_term, n)),
cols AS (SELECT DISTINCT p_brand AS equipment_uuid, coalesce(v.clean_name, 'unheard') || '[' || coalesce(u.clean_name, 'zz') || ']' AS column_name,
                v.cv_term AS variable_term, u.cv_term AS units_term
         FROM part LEFT JOIN v ON v.n = p_size % 10 LEFT JOIN u ON u.n = p_partkey % 7)
SELECT equipment_uuid, column_name, 'instrumentMeasurement' AS variable_domain_cv, variable_term, units_term, true AS expose_as_datastream
FROM cols WHERE variable_term IS NOT NULL AND equipment_uuid <> 'Brand#1'
UNION ALL SELECT DISTINCT p_brand, 'timestamp', 'instrumentTimestamp', 'nonedefined', 'datalogger_time_stamp', false FROM part""")
def generate_column_map(t):
    names = F.array(*[F.lit(r[1]) for r in mappers.SNOTEL_VARIABLES])
    units = F.array(*[F.lit(r[0]) for r in mappers.SNOTEL_UNITS])
    column = F.concat(F.coalesce(F.get(names, F.col("p_size") % 10), F.lit("unheard")), F.lit("["),
                      F.coalesce(F.get(units, (F.col("p_partkey") % 7).cast("int")), F.lit("zz")), F.lit("]"))
    columns = t.part.select(F.col("p_brand").alias("equipment_uuid"), column.alias("column_name")).distinct()
    existing = columns.filter("equipment_uuid = 'Brand#1'")
    out = mapping.generate_column_map(
        columns, mappers.table(t.spark, mappers.SNOTEL_VARIABLES_COLUMNS, mappers.SNOTEL_VARIABLES),
        mappers.table(t.spark, mappers.SNOTEL_UNITS_COLUMNS, mappers.SNOTEL_UNITS), existing)
    return out.select("equipment_uuid", "column_name", "variable_domain_cv", "variable_term", "units_term", "expose_as_datastream")


@query("sensor_map", """
WITH s AS (SELECT o_orderkey AS block, o_orderstatus, i,
             CASE WHEN i = 1 AND o_orderstatus = 'F' THEN o_custkey ELSE NULL END AS own_start FROM orders, (VALUES (0), (1), (2)) x(i)),
c AS (SELECT block, i, o_orderstatus,
        CASE WHEN i >= 1 AND o_orderstatus = 'F' THEN (SELECT o_custkey FROM orders WHERE o_orderkey = block) ELSE 1000 + block END AS start_time FROM s),
p AS (SELECT * FROM (VALUES (0, 'temp_a'), (0, 'temp_b'), (1, 'flow_1'), (2, 'temp_a'), (2, 'temp_b'), (2, 'flow_1')) v(i, column_name)),
terms AS (SELECT * FROM (VALUES ('temp_a', 'airTemperature', 'degreeCelsius', true), ('temp_b', 'airTemperature', 'degreeFahrenheit', false),
                                ('flow_1', 'streamFlow', 'liter', true)) v(column_name, variable_term, units_term, expose))
SELECT block, CASE c.i WHEN 1 THEN 'code_1' ELSE 'sensor ' || CAST(c.i AS VARCHAR) END AS equipment_code, start_time AS position_start_date_utc,
       p.column_name, variable_term, units_term, units_term <> 'liter' AS unit_conversion, expose AS expose_as_datastream
FROM c JOIN p ON p.i = c.i JOIN terms ON terms.column_name = p.column_name""")
def sensor_map(t):
    def sensor(i, code, start, columns):
        return F.struct(F.lit(f"sensor {i}").alias("sensor_name"), F.lit(code).cast("string").alias("sensor_code"),
                        F.lit("s").alias("serial_number"), F.lit(0.5).alias("sensor_z_offset"), start.alias("start_timestamp"),
                        F.lit(None).cast("bigint").alias("end_timestamp"), F.array(*map(F.lit, columns)).alias("columns"))

    none = F.lit(None).cast("bigint")
    config = t.orders.select(
        F.col("o_orderkey").alias("block"), (F.col("o_orderkey") + 1000).alias("start_timestamp"), none.alias("end_timestamp"),
        F.array(*map(F.lit, ["temp_a", "temp_b", "flow_1"])).alias("columns"),
        F.array(sensor(0, None, none, ["Temp*"]), sensor(1, "code_1", F.when(F.col("o_orderstatus") == "F", F.col("o_custkey")), ["flow-1"]),
                sensor(2, None, none, ["temp*", "Flow 1"])).alias("attached_sensors"))
    terms = t.spark.sql("SELECT * FROM VALUES ('temp_a', 'airTemperature', 'degreeCelsius', true), "
                        "('temp_b', 'airTemperature', 'degreeFahrenheit', false), ('flow_1', 'streamFlow', 'liter', true) "
                        "AS v(column_name, variable_cv, unit_cv, expose)")
    out = mapping.generate_sensor_map(config, terms, ["liter"])
    return out.select("block", "equipment_code", "position_start_date_utc", "column_name", "variable_term", "units_term",
                      "unit_conversion", "expose_as_datastream")
