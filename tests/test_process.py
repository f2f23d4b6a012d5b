import json
import math
import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sensorlake.functions.flags import parse_ranges
from sensorlake.functions.names import clean_name, clean_name_col, datastream_name, expand_columns
from sensorlake.operators import checks, process as p


def obs(spark, rows):
    return spark.createDataFrame(rows, "datastream_id long, utc_time long, data_value double, qa_flag string")


def bounds(spark, ranges):
    df = spark.createDataFrame([(1, 0.0, 10.0, ranges)], "datastream_id long, lower double, upper double, "
                               "r array<struct<datetime_start:string,datetime_end:string,qa_flag:string>>")
    return df.withColumn("manual_ranges", parse_ranges(F.col("r")))


def test_automatic_flags(spark):
    rows = [(1, i, v, "a") for i, v in enumerate([5.0, -1.0, 11.0, float("inf"), float("-inf"), float("nan"), None, 0.0, 10.0])]
    out = p.flag_observations(obs(spark, rows), bounds(spark, None)).orderBy("utc_time").collect()
    assert "".join(r.qa_flag for r in out) == "zffbbcdzz"
    folded = p.flag_observations(obs(spark, rows), bounds(spark, None), null_as_nan=True).filter("data_value IS NULL").first()
    assert folded.qa_flag == "c"


def test_manual_ranges_last_wins_and_open_ends(spark):
    ranges = [(None, "1970-01-01 00:00:10", "b"), ("1970-01-01 00:00:05", "1970-01-01 00:00:07", "w"), ("1970-01-01 00:00:20", None, "k")]
    rows = [(1, i, 5.0, "a") for i in (0, 5, 7, 8, 10, 11, 20, 99)]
    out = p.flag_observations(obs(spark, rows), bounds(spark, ranges)).orderBy("utc_time").collect()
    assert "".join(r.qa_flag for r in out) == "bwwbbzkk"


def test_manual_flag_must_be_a_letter(spark):
    with pytest.raises(PySparkException):
        p.flag_observations(obs(spark, [(1, 0, 5.0, "a")]), bounds(spark, [(None, None, "7")])).collect()


def test_two_loads_equal_one(spark, values):
    rows = [(s, t * 60, float(t), "z") for s in (1, 2) for t in range(20)]
    whole, first = obs(spark, rows), obs(spark, [r for r in rows if r[1] < 600])
    delta = p.materialize(whole, first)
    assert values(first.unionByName(delta)) == values(whole)
    assert p.materialize(whole, whole).count() == 0
    registry = spark.createDataFrame([], "datastream_id long, first_measurement_date long, last_measurement_date long, total_measurement_numbers long")
    once = p.update_registry(registry, whole)
    twice = p.update_registry(p.update_registry(registry, first), delta)
    assert values(once) == values(twice)
    assert checks.check_registry(twice, whole).isEmpty()


def test_registry_keeps_first_date_and_survives_bad_only_loads(spark):
    registry = spark.createDataFrame([(1, 5, 9, 3)], "datastream_id long, first_measurement_date long, last_measurement_date long, total_measurement_numbers long")
    row = p.update_registry(registry, obs(spark, [(1, 20, 1.0, "f")])).first()
    assert tuple(row) == (1, 5, 9, 3)


def test_unit_conversion_and_default_unit(spark):
    units = spark.sql("SELECT 'degF' AS term, 'temp' AS quantity_kind_cv, 0.5D AS conversion_multiplier, -32D AS conversion_offset")
    df = spark.sql("SELECT * FROM VALUES ('degF', true, 52D), ('degF', false, 52D), ('odd', true, 52D) AS v(units_term, unit_conversion, data_value)")
    assert sorted(r.data_value for r in p.convert_units(df, units).collect()) == [10.0, 52.0, 52.0]
    kinds = spark.sql("SELECT 'temp' AS term, 'degC' AS default_unit")
    with pytest.raises(PySparkException):
        p.resolve_default_unit(df, units, kinds).collect()
    assert {r.target_units_term for r in p.resolve_default_unit(df.filter("units_term = 'degF'"), units, kinds).collect()} == {"degC", "degF"}


def test_bounds_of_an_unconverted_stream(spark):
    streams = spark.sql("SELECT 1L AS datastream_id, 't' AS variable_term, 'degF' AS units_term, false AS unit_conversion")
    ranges = spark.sql("SELECT 't' AS variable_term, 0D AS min_valid_range, 10D AS max_valid_range")
    units = spark.sql("SELECT 'degF' AS term, 0.5D AS conversion_multiplier, -32D AS conversion_offset")
    row = p.qa_bounds(streams, ranges, units).first()
    assert (row.lower, row.upper) == (32.0, 52.0)


def test_offsets_report_cycles(spark):
    equipment = spark.createDataFrame([(i,) for i in range(6)], "equipment_id long")
    positions = spark.createDataFrame([(i, 1, -1.0) for i in range(5)] + [(0, 9, 2.5), (0, None, 99.0)],
                                      "equipment_id long, position_start_date_utc long, equipment_z_offset_m double")
    edges = spark.createDataFrame([(1, 0, 5), (1, 2, 1), (2, 1, 5), (3, 4, 1), (4, 3, 1)], "equipment_id long, related_equipment_id long, relationship_start_date_time_utc long")
    out = {r.equipment_id: (r.cyclic, r.attribute, r.offset_m) for r in p.accumulate_offsets(
        equipment, positions, edges.withColumn("relationship_type_cv", F.lit("isAttachedTo"))).collect()}
    assert out[0] == (False, "sensor_elevation", 2.5)
    assert out[1] == (False, "sensor_elevation", 1.5)
    assert out[2] == (False, "sensor_elevation", 0.5)
    assert out[3] == out[4] == (True, None, None)
    assert out[5] == (False, "sensor_elevation", 0.0)


def test_water_level_needs_casing(spark):
    streams = spark.createDataFrame([(1, 10, 100.0, None)], "datastream_id long, level_id long, elevation_m double, casing_m double")
    with pytest.raises(PySparkException):
        p.water_level(obs(spark, [(1, 0, 2.0, "z")]), streams).collect()
    out = p.water_level(obs(spark, [(1, 0, 2.0, "z"), (1, 1, 2.0, "f")]), streams.fillna(1.5)).collect()
    assert [tuple(r) for r in out] == [(10, 0, 99.5)]


def test_names(spark):
    assert clean_name("Flow - Rate [m³/s] 5%") == "flow___rate_[m3_s]_5percent".replace("___", "__")
    assert clean_name("ΩX", "default") == "ohmx"
    with pytest.raises(ValueError):
        clean_name("ωx")
    with pytest.raises(PySparkException):
        spark.range(1).select(clean_name_col(F.lit("λ"))).collect()
    assert expand_columns(["a*", "x", "b*"], ["ab", "ac", "b1"]) == ["ab", "ac", "x", "b1"]
    long = "feeder_" + "é" * 40
    name = spark.range(1).select(datastream_name(F.lit(long), F.lit("c"), F.lit("measured"))).first()[0]
    assert name.endswith("_meas") and len(name[:-5].encode()) <= 53 and name[:-5] == long.encode()[:53].decode(errors="ignore")
    short = spark.range(1).select(datastream_name(F.lit("a"), F.lit("b_ _"), F.lit("calculated"))).first()[0]
    assert short == "a_b_calc"


def test_piecewise_outside_unchanged(spark):
    segments = spark.sql("SELECT 1L AS datastream_id, 10D AS casing_ft, array(named_struct('start_epoch', 5L, 'end_epoch', 6L, 'elevation_ft', 1D)) AS ranges")
    out = p.piecewise_calc(obs(spark, [(1, 4, 1.0, "z"), (1, 5, 1.0, "z"), (2, 5, 1.0, "z")]), segments).orderBy("datastream_id", "utc_time").collect()
    assert [round(r.data_value, 6) for r in out] == [1.0, 1.3048, 1.0] and not math.isnan(out[0].data_value)


def _registry_inputs(spark, loop=False):
    registry = spark.createDataFrame([(1, "u-1", "derived", 10, 20, 2)],
                                     "datastream_id long, datastream_uuid string, datastream_type string, first_measurement_date long, "
                                     "last_measurement_date long, total_measurement_numbers long")
    delta = spark.createDataFrame([(1, 30, "z"), (2, 5, "z"), (2, 7, "b")], "datastream_id long, utc_time long, qa_flag string")
    streams = spark.createDataFrame([(1, "a", "e1", 4, 5, 6), (2, "b", "e2", 4, 5, 6)],
                                    "datastream_id long, datastream_tablename string, equipment_uuid string, sampling_feature_id long, variable_id long, units_id long")
    equipment = spark.createDataFrame([(1, "e1", "c1"), (2, "e2", "c2")], "equipment_id long, equipment_uuid string, equipment_code string")
    positions = spark.createDataFrame([(1, 100, -1.5), (2, 100, 4.0)], "equipment_id long, position_start_date_utc long, equipment_z_offset_m double")
    pairs = [(2, 1)] + ([(1, 2)] if loop else [])
    edges = spark.createDataFrame([(a, b, 9, "isAttachedTo") for a, b in pairs],
                                  "equipment_id long, related_equipment_id long, relationship_start_date_time_utc long, relationship_type_cv string")
    return registry, delta, streams, equipment, positions, edges


def test_registry_rows_are_whole(spark):
    rows = {r["datastream_id"]: r.asDict() for r in p.register_streams(*_registry_inputs(spark)).collect()}
    assert (rows[1]["datastream_uuid"], rows[1]["datastream_type"], rows[1]["last_measurement_date"], rows[1]["total_measurement_numbers"]) == ("u-1", "derived", 30, 3)
    assert json.loads(rows[1]["datastream_attribute"]) == {"sensor_depth": 1.5, "sensor_depth_units": "meter", "instrument": "c1"}
    assert rows[2]["datastream_uuid"] == str(uuid.uuid5(uuid.NAMESPACE_URL, "datastreams/b")) and rows[2]["datastream_type"] == "physicalsensor"
    assert json.loads(rows[2]["datastream_attribute"])["sensor_elevation"] == 2.5 and rows[2]["total_measurement_numbers"] == 1
    looped = p.register_streams(*_registry_inputs(spark, loop=True)).collect()
    assert [r["datastream_attribute"] for r in looped] == [None, None]


def test_registry_refuses_what_nobody_describes(spark):
    registry, delta, streams, *rest = _registry_inputs(spark)
    with pytest.raises(PySparkException, match="nothing describes datastream 2"):
        p.register_streams(registry, delta, streams.where("datastream_id = 1"), *rest).collect()
    with pytest.raises(PySparkException, match="no equipment e9"):
        p.register_streams(registry, delta, streams.withColumn("equipment_uuid", F.lit("e9")), *rest).collect()
    left = p.register_streams(registry, delta.where("datastream_id = 1"), streams.limit(0), *rest).collect()
    assert [(r["datastream_uuid"], r["equipment_id"], r["total_measurement_numbers"]) for r in left] == [("u-1", None, 3)]
