"""Laboratory samples: annotated cells, specimens, results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sensorlake.functions.numbers import annotated_parts, annotated_tokens, is_number, to_number
from sensorlake.functions.timezones import label_offset

# What a relation to the parent makes of the child.
RELATIONS = {
    "wasCollectedAt": ("specimen", "Specimen collected at"),
    "isSubSpecimenOf": ("specimen", "Subspecimen of"),
    "isPartOf": ("depthInterval", "Depth interval of"),
}
# Fixed values of a result row.
NO_DATA_VALUE = -999.999
NON_DETECT_TEXTS = ("nd",)


def annotate(df: DataFrame, cell: str) -> DataFrame:
    """Add ``remark``, ``value`` (text) and ``qualifiers`` of a laboratory cell."""
    read = df.withColumns(annotated_tokens(F.col(cell))).withColumns(annotated_parts(F.col(cell)))
    return read.drop("_text", "_tokens", "_plain", "_leads")


def _code_map(table: DataFrame, code: str, name: str) -> Column:
    """A code table (one entry per code letter) as one map value."""
    return table.agg(F.map_from_entries(F.collect_list(F.struct(code, name)))).scalar()


def expand_qualifiers(df: DataFrame, remarks: DataFrame, qualifier_names: DataFrame) -> DataFrame:
    """Add ``censor_code`` of the remark and ``qualifier_names`` (array, in the order of the letters).

    ``unknown_codes`` lists letters and remarks that the code tables lack; rows with any are to be rejected. The
    code tables travel as map values, so the samples are neither exploded nor shuffled.
    """
    remark_map = _code_map(remarks, "remark_cd", "censor_cv")
    name_map = _code_map(qualifier_names, "val_qual_cd", "val_qual_nm")
    mapped = df.withColumns({"_r": remark_map, "_q": name_map})
    letters = F.filter(F.split(F.coalesce("qualifiers", F.lit("")), ""), lambda c: c != "")
    unknown_remark = F.when(F.col("remark").isNotNull() & F.try_element_at("_r", F.col("remark")).isNull(), F.col("remark"))
    unknown_letters = F.filter(letters, lambda c: F.try_element_at("_q", c).isNull())
    return mapped.withColumns({
        "censor_code": F.try_element_at("_r", F.col("remark")),
        "qualifier_names": F.filter(F.transform(letters, lambda c: F.try_element_at("_q", c)), lambda n: n.isNotNull()),
        "unknown_codes": F.array_compact(F.concat(F.array(unknown_remark), unknown_letters)),
    }).drop("_r", "_q")


def samples_to_results(wide: DataFrame, keys: list[str], columns: list[str], column_map: DataFrame,
                       units: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Wide samples to one row per sample and measured parameter, plus the parameters still to be added.

    Cells that read ``nan`` (or are empty) are not results. Each cell takes its own variable and unit:
    ``column_map`` has ``column_name, variable_term``, ``units`` has ``column_name, units_term``.
    """
    long = wide.unpivot(keys, columns, "column_name", "cell").filter("cell IS NOT NULL AND trim(cell) NOT IN ('nan', '')")
    known = long.join(column_map, "column_name").join(units, "column_name", "left")
    to_add = long.select("column_name").distinct().join(column_map, "column_name", "left_anti")
    return known, to_add


def specimen_code(site: Column, timestamp: Column) -> Column:
    """``<site>_geochem<time with dashes>``."""
    return F.concat(site, F.lit("_geochem"), F.date_format(timestamp, "yyyy-MM-dd-HH-mm-ss"))


def make_specimens(samples: DataFrame, features: DataFrame, relation: str = "wasCollectedAt",
                   collection_id: int | None = None) -> dict[str, DataFrame]:
    """New specimens below their sites: ``features``, ``edges``, ``specimens``, ``collections``.

    ``samples`` has ``sampling_feature_code`` and ``timestamp``. A specimen inherits place and elevation from its
    site; a code that already exists is reused, not written again; an unknown site is an error. Ids are hashes of
    the code, so a repeated load makes the same ids.
    """
    if relation not in RELATIONS:
        raise ValueError(f"unknown relation {relation!r}, expected one of {list(RELATIONS)}")
    kind, phrase = RELATIONS[relation]
    wanted = samples.select(F.col("sampling_feature_code").alias("parent_code"), "timestamp").distinct().withColumn(
        "sampling_feature_code", specimen_code(F.col("parent_code"), F.col("timestamp")))
    existing = features.select("sampling_feature_code")
    new = wanted.join(existing, "sampling_feature_code", "left_anti")
    parent = features.select(
        F.col("sampling_feature_code").alias("parent_code"), F.lit(True).alias("_site"), "feature_geometry_wkt", "elevation_m",
        "latitude", "longitude")
    placed = new.join(parent, "parent_code", "left")
    no_site = F.raise_error(F.concat(F.lit("no sampling feature "), F.col("parent_code"))).cast("boolean")
    placed = placed.filter(F.coalesce("_site", no_site)).withColumn("sampling_feature_id", F.xxhash64("sampling_feature_code"))
    return {
        "features": placed.select(
            "sampling_feature_id", F.lit(kind).alias("sampling_feature_type_cv"), "sampling_feature_code",
            F.col("sampling_feature_code").alias("sampling_feature_name"),
            F.concat(F.lit(phrase + " "), "parent_code").alias("sampling_feature_description"),
            F.lit("point").alias("sampling_feature_geotype_cv"), "feature_geometry_wkt", "elevation_m", "latitude", "longitude"),
        "edges": placed.select("sampling_feature_id", F.lit(relation).alias("relationship_type_cv"),
                               F.xxhash64("parent_code").alias("related_feature_id")),
        "specimens": placed.select("sampling_feature_id", F.lit("grab").alias("specimen_type_cv"),
                                   F.lit("liquidAqueous").alias("specimen_medium_cv"), F.lit(True).alias("is_field_specimen")),
        "collections": placed.select("sampling_feature_id", F.lit(collection_id).cast("bigint").alias("specimen_collection_id")),
    }


def make_actions(samples: DataFrame, file_col: str, method_id: int | None = None) -> dict[str, DataFrame]:
    """One analysis action per file and one feature action per specimen of the file."""
    action_id = F.xxhash64(F.lit("specimenAnalysis"), F.col(file_col)).alias("action_id")
    offset = F.min(label_offset(F.col("timezone"))).alias("begin_date_time_utc_offset")
    actions = samples.groupBy(file_col).agg(F.min("timestamp").alias("begin_date_time"), offset).select(
        action_id, F.lit("specimenAnalysis").alias("action_type_cv"), F.lit(method_id).cast("bigint").alias("method_id"),
        file_col, "begin_date_time", "begin_date_time_utc_offset")
    code = specimen_code(F.col("sampling_feature_code"), F.col("timestamp"))
    bridge = samples.select(action_id, F.xxhash64(code).alias("sampling_feature_id")).distinct().withColumn(
        "feature_action_id", F.xxhash64("action_id", "sampling_feature_id"))
    return {"actions": actions, "feature_actions": bridge}


def make_results(long: DataFrame) -> dict[str, DataFrame]:
    """Result tables from sample rows.

    ``long``: ``specimen_code, position, variable_term, units_term, cell, timestamp, timezone, depth_m, is_stddev,
    annotated``. A standard deviation attaches to the reading before it in the same specimen. ``nd``/``n.d.`` is a
    non-detect with value 0; other text without number is 0; annotated readings are ``marginal``.
    """
    inside = W.partitionBy("specimen_code").orderBy("position").rowsBetween(W.unboundedPreceding, W.currentRow)
    reading = F.last(F.when(~F.col("is_stddev"), F.col("position")), ignorenulls=True).over(inside)
    text = F.lower(F.replace("cell", F.lit("."), F.lit("")))
    non_detect = text.isin(*NON_DETECT_TEXTS)
    rows = long.withColumn("_reading", reading).withColumns({
        "result_id": F.xxhash64("specimen_code", "_reading"),
        "utc_offset": label_offset(F.col("timezone")),
        "data_value": F.when(non_detect, 0.0).otherwise(F.coalesce(to_number(F.col("cell")), F.lit(0.0))),
        "censor_code_cv": F.when(non_detect, "nonDetect").otherwise("notCensored"),
        "quality_code_cv": F.when(F.col("annotated"), "marginal").otherwise("notAssessed"),
    })
    readings = rows.filter(~F.col("is_stddev"))
    return {
        "results": readings.select(
            "result_id", "specimen_code", F.lit("measurement").alias("result_type_cv"), "variable_term", "units_term",
            F.col("timestamp").alias("result_date_time"), F.col("utc_offset").alias("result_date_time_utc_offset"),
            F.lit("complete").alias("status_cv"), F.lit(1).alias("value_count"), F.lit(NO_DATA_VALUE).alias("no_data_value")),
        "measurement_results": readings.select(
            "result_id", F.col("depth_m").alias("z_location"), F.when(F.col("depth_m").isNotNull(), "meter").alias("z_location_units")),
        "values": rows.select(
            "result_id", "data_value", F.col("timestamp").alias("value_date_time"),
            F.col("utc_offset").alias("value_date_time_utc_offset"),
            F.when(F.col("is_stddev"), "standardDeviation").otherwise("instrumentReading").alias("aggregation_statistic_cv"),
            "censor_code_cv", "quality_code_cv"),
    }


def result_qualifiers(expanded: DataFrame, keys: list[str]) -> DataFrame:
    """One extension value per remark and qualifier of every annotated result that has a number."""
    values = F.array_distinct(F.array_compact(F.concat(F.array("censor_code"), "qualifier_names")))
    measured = F.when(is_number(F.col("value")), values)
    return (expanded.select(*keys, F.explode(measured).alias("property_value"))
            .withColumn("property_name", F.lit("value_qualifier_code")))
