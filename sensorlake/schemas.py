"""Table shapes shared by the operators."""

from pyspark.sql import types as T

OBSERVATION = T.StructType([
    T.StructField("datastream_id", T.LongType(), False),
    T.StructField("utc_time", T.LongType(), False),
    T.StructField("data_value", T.DoubleType(), True),
    T.StructField("qa_flag", T.StringType(), False),
])

REGISTRY = T.StructType([
    T.StructField("datastream_id", T.LongType(), False),
    T.StructField("datastream_uuid", T.StringType(), False),
    T.StructField("datastream_tablename", T.StringType(), False),
    T.StructField("equipment_id", T.LongType(), True),
    T.StructField("sampling_feature_id", T.LongType(), True),
    T.StructField("datastream_type", T.StringType(), True),
    T.StructField("variable_id", T.LongType(), True),
    T.StructField("units_id", T.LongType(), True),
    T.StructField("first_measurement_date", T.LongType(), True),
    T.StructField("last_measurement_date", T.LongType(), True),
    T.StructField("total_measurement_numbers", T.LongType(), True),
    T.StructField("datastream_attribute", T.StringType(), True),
])

MANUAL_RANGE = T.StructType([
    T.StructField("datetime_start", T.StringType(), True),
    T.StructField("datetime_end", T.StringType(), True),
    T.StructField("qa_flag", T.StringType(), False),
    T.StructField("qa_note", T.StringType(), True),
])

COLUMN_MAP = T.StructType([
    T.StructField("column_name", T.StringType(), False),
    T.StructField("variable_domain_cv", T.StringType(), False),
    T.StructField("acquiring_instrument_uuid", T.StringType(), True),
    T.StructField("variable_term", T.StringType(), True),
    T.StructField("units_term", T.StringType(), True),
    T.StructField("unit_conversion", T.BooleanType(), False),
    T.StructField("expose_as_datastream", T.BooleanType(), False),
    T.StructField("datastream_manual_qa_list", T.ArrayType(MANUAL_RANGE), True),
    T.StructField("sensor_type", T.StringType(), True),
    T.StructField("notes", T.StringType(), True),
])

# Quality flags. The alphabetical order of the letters is the quality order.
QUALITY_FLAGS = {
    "notAssessed": "a",
    "bad": "b",
    "NaN": "c",
    "Null": "d",
    "outOfRange": "f",
    "flatLining": "h",
    "noisy": "k",
    "statisticsChange": "m",
    "dataJump": "p",
    "auxDataDiscrepancy": "s",
    "marginal": "w",
    "good": "z",
}


def split_fields(fields: str) -> list[str]:
    """Top-level parts of a field list; commas inside angle brackets stay."""
    parts, depth, start = [], 0, 0
    for i, ch in enumerate(fields):
        depth += (ch == "<") - (ch == ">")
        if ch == "," and depth == 0:
            parts.append(fields[start:i].strip())
            start = i + 1
    return [*parts, fields[start:].strip()]
