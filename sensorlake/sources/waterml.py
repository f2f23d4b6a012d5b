"""WaterML documents with Spark's XML reader: series values, sites and variables as tables.

The readers ignore namespaces; attributes arrive with a leading underscore and element text as ``_VALUE``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.schemas import split_fields

_CODE = "struct<_VALUE:string,_network:string,_vocabulary:string,_variableID:string,_agencyCode:string>"
_ZONE = "struct<_zoneAbbreviation:string,_zoneOffset:string>"
SITE_INFO = (
    f"siteName string, siteCode {_CODE}, "
    "geoLocation struct<geogLocation:struct<_srs:string,latitude:double,longitude:double>>, elevation_m string, "
    f"timeZoneInfo struct<_siteUsesDaylightSavingsTime:string,defaultTimeZone:{_ZONE},daylightSavingsTimeZone:{_ZONE}>, "
    "note array<struct<_VALUE:string,_title:string>>, siteProperty array<struct<_VALUE:string,_name:string>>")
_UNIT = "struct<_unitID:string,unitName:string,unitType:string,unitAbbreviation:string,unitCode:string>"
VARIABLE = (
    f"variableCode {_CODE}, variableName string, variableDescription string, valueType string, dataType string, "
    f"generalCategory string, sampleMedium string, noDataValue string, unit {_UNIT}, units {_UNIT}, "
    "options struct<option:array<struct<_VALUE:string,_name:string,_optionCode:string>>>, "
    f"timeScale struct<_isRegular:string,unit:{_UNIT},timeSupport:string>")
_VALUE_ROW = ("struct<_VALUE:string,_dateTime:string,_censorCode:string,_methodID:string,_qualifiers:string,"
              "_qualityControlLevelID:string,_sourceID:string,_offsetValue:string>")
_VALUES = (f"struct<value:array<{_VALUE_ROW}>,"
           "method:array<struct<_methodID:string,methodCode:string,methodDescription:string>>,"
           "qualifier:array<struct<_qualifierID:string,qualifierCode:string,qualifierDescription:string>>,"
           "source:array<struct<_sourceID:string,organization:string,sourceDescription:string>>,"
           "censorCode:array<struct<censorCode:string,censorCodeDescription:string>>,"
           "offset:array<struct<_offsetTypeID:string,offsetValue:string,offsetDescription:string>>,"
           "qualityControlLevel:array<struct<_qualityControlLevelID:string,qualityControlLevelCode:string,definition:string>>>")


def _as_struct(fields: str) -> str:
    """``a int, b struct<...>`` to ``struct<a:int,b:struct<...>>``."""
    return "struct<" + ",".join(part.replace(" ", ":", 1) for part in split_fields(fields)) + ">"


TIME_SERIES = f"sourceInfo {_as_struct(SITE_INFO)}, variable {_as_struct(VARIABLE)}, values array<{_VALUES}>"
SERIES = (f"variable {_as_struct(VARIABLE)}, valueCount string, "
          "variableTimeInterval struct<beginDateTime:string,endDateTime:string>, "
          "method struct<_methodID:string,methodDescription:string>, source struct<_sourceID:string,organization:string>")
SITE = f"siteInfo {_as_struct(SITE_INFO)}, seriesCatalog array<struct<series:array<{_as_struct(SERIES)}>>>"


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: str) -> DataFrame:
    """Elements ``row_tag`` of all files below ``path``."""
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)


def parse_xml(df: DataFrame, column: str, row_tag: str, schema: str, keep: list[str]) -> DataFrame:
    """A text column with one element per row."""
    return df.select(*keep, F.from_xml(column, schema, {"rowTag": row_tag}).alias("x")).select(*keep, "x.*")


def _second(text: Column) -> Column:
    return F.date_trunc("second", F.try_to_timestamp(text)).cast("timestamp_ntz")


def values(series: DataFrame, method: str | None = None) -> DataFrame:
    """Readings of ``timeSeries`` elements: site, variable, time cut to seconds, value and its code columns.

    Without ``method`` a series with more than one block is an error; ``"all"`` takes every block and appends the
    method id to the code of such series; any other value takes the blocks of that method.
    """
    statistic = F.get(F.filter("variable.options.option", lambda o: o["_name"] == "Statistic"), F.lit(0))["_optionCode"]
    code = F.concat(F.col("variable.variableCode._VALUE"), F.coalesce(F.concat(F.lit(":"), statistic), F.lit("")))
    blocks = F.size("values")
    base = series.select(
        F.col("sourceInfo.siteCode._VALUE").alias("site_code"), F.col("sourceInfo.siteCode._network").alias("network"),
        code.alias("variable_code"), F.col("variable.variableName").alias("variable_name"),
        F.coalesce("variable.unit.unitName", "variable.units.unitName").alias("units"), blocks.alias("blocks"),
        F.explode("values").alias("b"))
    method_id = F.get(F.col("b.method"), F.lit(0))["_methodID"]
    if method is None:
        many = F.raise_error(F.concat(F.lit("found more than one method for "), F.col("variable_code"))).cast("boolean")
        base = base.filter(F.when(F.col("blocks") > 1, many).otherwise(F.lit(True)))
    elif method == "all":
        base = base.withColumn("variable_code", F.when(
            F.col("blocks") > 1, F.concat("variable_code", F.lit(":"), method_id)).otherwise(F.col("variable_code")))
    else:
        base = base.filter(F.exists("b.method", lambda m: m["_methodID"] == method))
    return base.select(
        "site_code", "network", "variable_code", "variable_name", "units", method_id.alias("method_id"),
        F.explode("b.value").alias("v")).select(
        "site_code", "network", "variable_code", "variable_name", "units", "method_id",
        _second(F.col("v._dateTime")).alias("timestamp"), F.col("v._VALUE").try_cast("double").alias("value"),
        F.col("v._censorCode").alias("censor_code"), F.col("v._qualifiers").alias("qualifiers"),
        F.col("v._qualityControlLevelID").alias("quality_control_level"), F.col("v._sourceID").alias("source_id"))


SIDE_TABLES = ("method", "qualifier", "source", "censorCode", "offset", "qualityControlLevel")


def side_table(series: DataFrame, name: str) -> DataFrame:
    """One of the per-series lookups (methods, qualifiers, sources, ...) with its variable code."""
    if name not in SIDE_TABLES:
        raise ValueError(f"unknown lookup {name!r}, expected one of {SIDE_TABLES}")
    code = F.col("variable.variableCode._VALUE").alias("variable_code")
    blocks = series.select(code, F.explode("values").alias("b"))
    return blocks.select("variable_code", F.explode(f"b.{name}").alias("row")).select("variable_code", "row.*").distinct()


def _snake(text: Column) -> Column:
    spaced = F.regexp_replace(F.replace(text, F.lit(" "), F.lit("")), r"(.)([A-Z][a-z]+)", "$1_$2")
    return F.lower(F.regexp_replace(spaced, r"([a-z0-9])([A-Z])", "$1_$2"))


def _site_columns(prefix: str) -> list[Column]:
    c = lambda path: F.col(f"{prefix}{path}")
    entries = lambda path, name: F.map_from_entries(
        F.transform(c(path), lambda e: F.struct(_snake(e[name]).alias("key"), e["_VALUE"].alias("value"))))
    return [
        c("siteCode._VALUE").alias("code"), c("siteName").alias("name"), c("siteCode._network").alias("network"),
        c("siteCode._agencyCode").alias("agency"),
        c("geoLocation.geogLocation.latitude").alias("latitude"), c("geoLocation.geogLocation.longitude").alias("longitude"),
        c("elevation_m").cast("double").alias("elevation_m"),
        (c("timeZoneInfo._siteUsesDaylightSavingsTime") == "true").alias("uses_dst"),
        c("timeZoneInfo.defaultTimeZone._zoneOffset").alias("utc_offset"),
        entries("note", "_title").alias("notes"), entries("siteProperty", "_name").alias("properties"),
    ]


def _variable_columns(prefix: str) -> list[Column]:
    c = lambda path: F.col(f"{prefix}{path}")
    return [
        c("variableCode._VALUE").alias("variable_code"), c("variableCode._vocabulary").alias("vocabulary"),
        c("variableCode._variableID").alias("variable_id"), c("variableName").alias("variable_name"),
        c("variableDescription").alias("description"), c("valueType").alias("value_type"), c("dataType").alias("data_type"),
        F.coalesce(c("unit.unitName"), c("units.unitName")).alias("units"),
        F.coalesce(c("unit.unitAbbreviation"), c("units.unitAbbreviation")).alias("units_abbreviation"),
    ]


def sites(site_elements: DataFrame) -> DataFrame:
    """Site catalogue: site columns and one row per series."""
    catalog = F.flatten(F.transform("seriesCatalog", lambda s: s["series"]))
    rows = site_elements.select(*_site_columns("siteInfo."), F.explode_outer(catalog).alias("s"))
    return rows.select(
        *[F.col(c) for c in rows.columns if c != "s"], *_variable_columns("s.variable."),
        F.col("s.valueCount").cast("bigint").alias("value_count"),
        F.col("s.variableTimeInterval.beginDateTime").alias("begin_time"),
        F.col("s.variableTimeInterval.endDateTime").alias("end_time"),
        F.col("s.method._methodID").alias("method_id"), F.col("s.source.organization").alias("organization"))


def site_infos(elements: DataFrame) -> DataFrame:
    """``siteInfo`` elements, one row per site code."""
    infos = elements.select(*_site_columns(""))
    rest = [c for c in infos.columns if c not in ("code", "notes", "properties")]
    return infos.groupBy("code").agg(F.min(F.struct(*rest)).alias("r")).select("code", "r.*")


def variables(elements: DataFrame) -> DataFrame:
    """``variable`` elements, one row per variable code."""
    rows = elements.select(*_variable_columns(""))
    rest = [c for c in rows.columns if c != "variable_code"]
    return rows.groupBy("variable_code").agg(F.min(F.struct(*rest)).alias("r")).select("variable_code", "r.*")
