"""Column maps: which column is which variable, unit and instrument."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.functions.names import clean_name_col

NO_RANGES = "array<struct<datetime_start:string,datetime_end:string,qa_flag:string,qa_note:string>>"

# The row every new column map starts with.
TIME_ROW = {"column_name": "timestamp", "variable_domain_cv": "instrumentTimestamp", "variable_term": "nonedefined",
            "units_term": "datalogger_time_stamp"}


def map_rows(df: DataFrame, keep: list[str], domain: str | Column, unit_conversion: Column | None = None,
             expose: Column | None = None) -> DataFrame:
    """Fill the defaults of a column-map row."""
    return df.select(
        *keep, "column_name", (F.lit(domain) if isinstance(domain, str) else domain).alias("variable_domain_cv"),
        "variable_term", "units_term",
        (F.lit(True) if unit_conversion is None else unit_conversion).alias("unit_conversion"),
        (F.lit(True) if expose is None else expose).alias("expose_as_datastream"),
        F.lit(None).cast(NO_RANGES).alias("datastream_manual_qa_list"),
        F.lit("measured").alias("sensor_type"), F.lit(None).cast("string").alias("notes"))


def time_row(devices: DataFrame, key: str) -> DataFrame:
    """The seeded timestamp row of every device."""
    seeded = devices.select(key).distinct().withColumns({k: F.lit(v) for k, v in TIME_ROW.items() if k != "variable_domain_cv"})
    return map_rows(seeded, [key], TIME_ROW["variable_domain_cv"], expose=F.lit(False))


def generate_column_map(columns: DataFrame, variables: DataFrame, units: DataFrame, existing: DataFrame,
                        key: str = "equipment_uuid") -> DataFrame:
    """Rows for columns ``name[unit]`` that are not mapped yet; unmapped names are skipped.

    ``columns`` has ``key, column_name``; ``variables`` and ``units`` map ``clean_name`` to ``cv_term``.
    """
    parts = columns.join(existing.select(key, "column_name"), [key, "column_name"], "left_anti").withColumns({
        "_name": F.regexp_extract("column_name", r"^([^\[]*)\[", 1),
        "_unit": F.regexp_extract("column_name", r"\[(.*)\]$", 1),
    })
    mapped = (parts.join(variables.select(F.col("clean_name").alias("_name"), F.col("cv_term").alias("variable_term")), "_name")
              .join(units.select(F.col("clean_name").alias("_unit"), F.col("cv_term").alias("units_term")), "_unit", "left")
              .filter("variable_term IS NOT NULL"))
    return map_rows(mapped, [key], "instrumentMeasurement").unionByName(
        time_row(columns, key).join(existing.select(key, "column_name"), [key, "column_name"], "left_anti"))


def expand_patterns(patterns: Column, columns: Column) -> Column:
    """``abc*`` entries of an array to all ``columns`` with that prefix, other entries unchanged."""
    def one(pattern: Column) -> Column:
        prefix = F.regexp_replace(pattern, r"\*$", "")
        return F.when(pattern.endswith("*"), F.filter(columns, lambda c: c.startswith(prefix))).otherwise(F.array(pattern))

    return F.flatten(F.transform(patterns, one))


def inherit(sensors: Column, field: str, base: Column) -> Column:
    """Array of a sensor field where a missing value takes the last one set before it, first of all ``base``."""
    def at(_, i: Column) -> Column:
        known = F.filter(F.slice(sensors, F.lit(1), i + 1), lambda s: s[field].isNotNull())
        return F.coalesce(F.try_element_at(known, F.lit(-1))[field], base)

    return F.transform(sensors, at)


def attached_sensors(config: DataFrame) -> DataFrame:
    """One row per attached sensor of a block, with inherited start and end times and its code.

    ``config``: ``block, start_timestamp, end_timestamp, columns, attached_sensors`` where a sensor has
    ``sensor_name, sensor_code, serial_number, sensor_z_offset, start_timestamp, end_timestamp, columns``. All
    inheritance happens inside the block's own array; no shuffle.
    """
    sensors = F.col("attached_sensors")
    rows = config.select("block", "columns", F.posexplode(F.arrays_zip(
        sensors.alias("s"), inherit(sensors, "start_timestamp", F.col("start_timestamp")).alias("start"),
        inherit(sensors, "end_timestamp", F.col("end_timestamp")).alias("end"))).alias("position", "z"))
    return rows.select(
        "block", "position", F.coalesce("z.s.sensor_code", "z.s.sensor_name").alias("equipment_code"),
        F.col("z.s.sensor_name").alias("equipment_name"), F.col("z.s.serial_number").alias("serial_number"),
        F.col("z.s.sensor_z_offset").alias("equipment_z_offset_m"),
        F.col("z.start").alias("position_start_date_utc"), F.col("z.end").alias("position_end_date_utc"),
        expand_patterns(F.transform("z.s.columns", lambda c: clean_name_col(c)), F.col("columns")).alias("columns"))


def generate_sensor_map(config: DataFrame, column_terms: DataFrame, keep_units: list[str]) -> DataFrame:
    """Column-map rows of all attached sensors.

    ``column_terms``: ``column_name, variable_cv, unit_cv, expose``. Units in ``keep_units`` are not converted.
    """
    rows = attached_sensors(config).select("block", "equipment_code", "position_start_date_utc", "position_end_date_utc",
                                           F.explode("columns").alias("column_name"))
    terms = column_terms.select("column_name", F.col("variable_cv").alias("variable_term"),
                                F.col("unit_cv").alias("units_term"), F.col("expose").alias("_expose"))
    joined = rows.join(terms, "column_name")
    convert = ~F.col("units_term").isin(*keep_units) if keep_units else F.lit(True)
    return map_rows(joined, ["block", "equipment_code", "position_start_date_utc", "position_end_date_utc"],
                    "instrumentMeasurement", unit_conversion=convert, expose=F.col("_expose"))
