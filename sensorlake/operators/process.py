"""From raw wide tables to quality-flagged observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sensorlake.functions import timezones as tz_fn
from sensorlake.functions.flags import auto_flag, manual_flag
from sensorlake.operators.trees import ancestor_sums
from sensorlake.session import small_side

UNKNOWN = "unknown"


def to_observations(feeder: DataFrame, mapping: DataFrame, columns: list[str], ids: list[str]) -> DataFrame:
    """Wide to long: every exposed column of the feeder becomes a datastream.

    ``columns`` is the feeder's sensor header. One ``unpivot`` reads the feeder once; the mapping (one row per
    column, configuration-sized) joins on the column name, and on ``feeder_table`` where it has one, since two sources may
    use a name for different things. Missing terms become ``unknown``.
    """
    exposed = mapping.filter("expose_as_datastream").withColumns({
        "variable_term": F.coalesce("variable_term", F.lit(UNKNOWN)),
        "units_term": F.coalesce("units_term", F.lit(UNKNOWN)),
    })
    long = feeder.unpivot(ids, columns, "column_name", "data_value")
    keys = [c for c in ("feeder_table", "column_name") if c in exposed.columns and c in long.columns]
    return long.join(exposed, keys)


def convert_units(df: DataFrame, units: DataFrame, value: str = "data_value") -> DataFrame:
    """``multiplier * (offset + value)`` by ``units_term``; ``unit_conversion=false`` keeps the value."""
    factors = units.select(F.col("term").alias("units_term"), "conversion_multiplier", "conversion_offset")
    joined = df.join(factors, "units_term", "left")
    multiplier = F.when(F.col("unit_conversion"), F.col("conversion_multiplier"))
    offset = F.when(F.col("unit_conversion"), F.col("conversion_offset"))
    converted = F.coalesce(multiplier, F.lit(1.0)) * (F.coalesce(offset, F.lit(0.0)) + F.col(value))
    return joined.withColumn(value, converted).drop("conversion_multiplier", "conversion_offset")


def resolve_default_unit(mapping: DataFrame, units: DataFrame, kinds: DataFrame) -> DataFrame:
    """Add ``target_units_term``: the default unit of the unit's quantity kind, or the unit itself when it is not
    converted. A converted unit without a default is an error."""
    by_kind = (units.select(F.col("term").alias("units_term"), F.col("quantity_kind_cv").alias("kind"))
               .join(kinds.select(F.col("term").alias("kind"), "default_unit"), "kind", "left"))
    joined = mapping.join(by_kind, "units_term", "left")
    missing = F.raise_error(F.concat(F.lit("no default unit for "), F.col("units_term"))).cast("string")
    target = F.when(~F.col("unit_conversion"), F.col("units_term")).otherwise(F.coalesce("default_unit", missing))
    return joined.withColumn("target_units_term", target).drop("kind", "default_unit")


def local_to_epoch(df: DataFrame, ts: str, tz: str | Column, keys: list[str], order: list[str]) -> DataFrame:
    """Local wall clock to ``utc_time`` with ``dst_status`` (``plain``, ``first_pass``, ``second_pass``, ``gap``).

    In the hour that occurs twice, reading order tells the passes apart: within a stream and date, everything
    from the first backward step on belongs to the second pass. Only rows of that hour are windowed; all others
    are converted in place. Times the clock skips get no ``utc_time``; filter on ``dst_status`` to reject them.
    """
    local = F.col(ts)
    repeated = F.coalesce(tz_fn.is_repeated(local, tz), F.lit(False))
    first = tz_fn.ntz_to_epoch(tz_fn.local_to_utc(local, tz))
    gap = tz_fn.is_gap(local, tz)
    plain = df.filter(~repeated).withColumns({
        "utc_time": F.when(~gap, first),
        "dst_status": F.when(gap, "gap").otherwise("plain"),
    })
    day = W.partitionBy(*keys, F.to_date(local)).orderBy(*order)
    stepped = df.filter(repeated).withColumn("_back", F.coalesce(F.lag(local).over(day) > local, F.lit(False)))
    running = day.rowsBetween(W.unboundedPreceding, W.currentRow)
    second = F.max("_back").over(running)
    twice = stepped.withColumn("_second", second).withColumns({
        "utc_time": first + F.when(F.col("_second"), tz_fn.fall_back_seconds(local, tz)).otherwise(F.lit(0)),
        "dst_status": F.when(F.col("_second"), "second_pass").otherwise("first_pass"),
    }).drop("_back", "_second")
    return plain.unionByName(twice)


def high_water(observations: DataFrame) -> DataFrame:
    """Newest stored time per stream."""
    return observations.groupBy("datastream_id").agg(F.max("utc_time").alias("last_time"))


def materialize(raw: DataFrame, observations: DataFrame | None = None, marks: DataFrame | None = None) -> DataFrame:
    """Rows of ``raw`` later than the newest stored time of their stream (0 when nothing is stored).

    The newest times are the ``marks`` of a stored table (``datastream_id, last``), which no load has to scan the table for, or else come
    from ``observations``; without both, all rows are new. One row per stream: while they are small the raw rows are not shuffled.
    """
    if marks is not None:
        newest = marks.select("datastream_id", F.col("last").alias("last_time"))
    elif observations is not None:
        newest = small_side(high_water(observations))
    else:
        return raw
    return (raw.join(newest, "datastream_id", "left")
            .filter(F.col("utc_time") > F.coalesce("last_time", F.lit(0)))
            .drop("last_time"))


def qa_bounds(streams: DataFrame, ranges: DataFrame, units: DataFrame) -> DataFrame:
    """Valid range of each stream in the stream's own unit.

    Ranges are stored in the default unit. A stream that is not converted keeps its unit, so the bound is
    inverted with that unit's factors: ``bound / multiplier - offset``.
    """
    factors = units.select(F.col("term").alias("units_term"), "conversion_multiplier", "conversion_offset")
    joined = streams.join(ranges, "variable_term", "left").join(factors, "units_term", "left")

    def bound(name: str) -> Column:
        inverted = F.col(name) / F.coalesce("conversion_multiplier", F.lit(1.0)) - F.coalesce("conversion_offset", F.lit(0.0))
        return F.when(F.col("unit_conversion"), F.col(name)).otherwise(inverted)

    return joined.withColumns({"lower": bound("min_valid_range"), "upper": bound("max_valid_range")}).drop(
        "conversion_multiplier", "conversion_offset", "min_valid_range", "max_valid_range")


def flag_observations(df: DataFrame, bounds: DataFrame, null_as_nan: bool = False) -> DataFrame:
    """Automatic flags, then the stream's hand-made ranges.

    ``bounds`` has one row per stream: ``datastream_id, lower, upper, manual_ranges``.
    """
    joined = df.join(bounds.select("datastream_id", "lower", "upper", "manual_ranges"), "datastream_id", "left")
    automatic = auto_flag(F.col("data_value"), F.col("lower"), F.col("upper"), null_as_nan)
    return joined.withColumn("qa_flag", manual_flag(F.col("utc_time"), automatic, F.col("manual_ranges"))).drop(
        "lower", "upper", "manual_ranges")


def good_summary(observations: DataFrame) -> DataFrame:
    """First time, last time and number of good readings per stream, in one partial aggregate."""
    good = F.col("qa_flag") == "z"
    return observations.groupBy("datastream_id").agg(
        F.min(F.when(good, F.col("utc_time"))).alias("first_good"),
        F.max(F.when(good, F.col("utc_time"))).alias("last_good"),
        F.count_if(good).alias("good_count"),
        F.count("*").alias("row_count"))


def update_registry(registry: DataFrame, delta: DataFrame) -> DataFrame:
    """Registry after a load: the first date is set once, the last date and the count move on; identity columns
    stay. An older delta does not move the last date back. Streams that are new in ``delta`` get a row with only these columns."""
    news = good_summary(delta)
    joined = registry.join(news, "datastream_id", "full")
    return joined.withColumns({
        "first_measurement_date": F.coalesce("first_measurement_date", "first_good"),
        "last_measurement_date": F.greatest("last_good", "last_measurement_date"),
        "total_measurement_numbers":
            F.coalesce("total_measurement_numbers", F.lit(0)) + F.coalesce("good_count", F.lit(0)),
    }).drop("first_good", "last_good", "good_count", "row_count")


def latest_position(positions: DataFrame) -> DataFrame:
    """Position row with the newest non-null start per equipment."""
    rest = [c for c in positions.columns if c not in ("equipment_id", "position_start_date_utc")]
    newest = F.max(F.struct("position_start_date_utc", *rest))
    return (positions.filter(F.col("position_start_date_utc").isNotNull())
            .groupBy("equipment_id").agg(newest.alias("p")).select("equipment_id", "p.*"))


def newest_parent(edges: DataFrame) -> DataFrame:
    """Newest dated ``isAttachedTo`` edge per equipment."""
    usable = edges.filter((F.col("relationship_type_cv") == "isAttachedTo")
                          & F.col("relationship_start_date_time_utc").isNotNull())
    newest = F.max(F.struct("relationship_start_date_time_utc", "related_equipment_id"))
    return usable.groupBy("equipment_id").agg(newest.alias("e")).select(
        "equipment_id", F.col("e.related_equipment_id").alias("parent_id"))


def accumulate_offsets(equipment: DataFrame, positions: DataFrame, edges: DataFrame) -> DataFrame:
    """Sum of the z-offsets of each equipment and all its ancestors; equipment on a cycle is reported as ``cyclic``
    with a NULL offset. A negative sum is a depth, otherwise an elevation."""
    start = (equipment.select("equipment_id")
             .join(latest_position(positions).select("equipment_id", "equipment_z_offset_m"), "equipment_id", "left")
             .join(newest_parent(edges), "equipment_id", "left")
             .select(F.col("equipment_id").alias("id"), "parent_id",
                     F.coalesce("equipment_z_offset_m", F.lit(0.0)).alias("weight")))
    total = F.col("total")
    return ancestor_sums(start).select(
        F.col("id").alias("equipment_id"), "cyclic",
        F.when(total < 0, "sensor_depth").when(total >= 0, "sensor_elevation").alias("attribute"),
        F.abs(total).alias("offset_m"))


def datastream_attribute(df: DataFrame) -> DataFrame:
    """Add the JSON text ``{<sensor_depth|sensor_elevation>: m, <..._units>: "meter", "instrument": code}``."""
    depth = F.col("attribute") == "sensor_depth"
    as_depth = F.to_json(F.struct(F.col("offset_m").alias("sensor_depth"), F.lit("meter").alias("sensor_depth_units"),
                                  F.col("equipment_code").alias("instrument")))
    as_elevation = F.to_json(F.struct(F.col("offset_m").alias("sensor_elevation"),
                                      F.lit("meter").alias("sensor_elevation_units"),
                                      F.col("equipment_code").alias("instrument")))
    return df.withColumn("datastream_attribute", F.when(depth, as_depth).otherwise(as_elevation))


def name_uuid(name: Column, namespace: str = "6ba7b811-9dad-11d1-80b4-00c04fd430c8") -> Column:
    """Version 5 UUID of a name: a task that runs again gives the same name the same UUID."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), name.cast("binary")))
    variant = F.translate(F.substring(h, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)),
                       F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def register_streams(registry: DataFrame, delta: DataFrame, streams: DataFrame, equipment: DataFrame, positions: DataFrame, edges: DataFrame,
                     stream_type: str = "physicalsensor", database: str = "datastreams") -> DataFrame:
    """Whole registry rows after a load.

    ``streams`` describes what the load covers: ``datastream_id, datastream_tablename, equipment_uuid, sampling_feature_id, variable_id, units_id``;
    ``equipment`` has ``equipment_id, equipment_uuid, equipment_code``. UUID and type are set once, the others follow the description; dates and count move as
    in ``update_registry``. Rows that the load does not cover keep all but those. The attribute names the summed offset of the equipment and what carries
    it, and is NULL for equipment on a cycle. Unknown equipment and readings of a stream that nobody describes are errors.
    """
    placed = datastream_attribute(accumulate_offsets(equipment.select("equipment_id"), positions, edges)
                                  .join(equipment.select("equipment_id", "equipment_uuid", "equipment_code"), "equipment_id"))
    unknown = F.raise_error(F.concat(F.lit("no equipment "), F.coalesce("equipment_uuid", F.lit("NULL")))).cast("bigint")
    described = (streams.join(placed, "equipment_uuid", "left").select(
        "datastream_id", F.lit(True).alias("_described"), F.lit(database).alias("datastream_database"), "datastream_tablename",
        F.coalesce("equipment_id", unknown).alias("equipment_id"), "sampling_feature_id", "variable_id", "units_id",
        F.when(~F.col("cyclic"), F.col("datastream_attribute")).alias("datastream_attribute")))
    renewed = [c for c in described.columns if c not in ("datastream_id", "_described")]
    moved = update_registry(registry, delta)
    joined = moved.join(described.withColumnsRenamed({c: f"_{c}" for c in renewed}), "datastream_id", "full")
    old = {c: F.col(c) if c in registry.columns else F.lit(None) for c in ["datastream_uuid", "datastream_type", *renewed]}
    lost = F.raise_error(F.concat(F.lit("nothing describes datastream "), F.col("datastream_id").cast("string"))).cast("string")
    made = F.when(F.col("_described"), name_uuid(F.concat_ws("/", F.lit(database), "_datastream_tablename"))).otherwise(lost)
    return joined.select(
        "datastream_id", F.coalesce(old["datastream_uuid"], made).alias("datastream_uuid"),
        F.coalesce(old["datastream_type"], F.lit(stream_type)).alias("datastream_type"),
        *[F.when(F.col("_described"), F.col(f"_{c}")).otherwise(old[c]).alias(c) for c in renewed],
        "first_measurement_date", "last_measurement_date", F.coalesce("total_measurement_numbers", F.lit(0)).alias("total_measurement_numbers"),
        *[c for c in registry.columns if c not in {*old, "datastream_id", "first_measurement_date", "last_measurement_date", "total_measurement_numbers"}])


def water_level(observations: DataFrame, streams: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Water level above datum, ``(casing height + elevation) - depth``, from good depth readings.

    ``streams`` maps each depth stream to ``level_id, elevation_m, casing_m``; a depth stream without casing
    height is an error. With ``existing`` only readings later than the stored level come out.
    """
    missing = F.raise_error(F.concat(F.lit("no casing height for datastream "), F.col("datastream_id").cast("string")))
    casing = F.coalesce("casing_m", missing.cast("double"))
    levels = (observations.filter(F.col("qa_flag") == "z").join(streams, "datastream_id")
              .select(F.col("level_id").alias("datastream_id"), "utc_time",
                      ((casing + F.col("elevation_m")) - F.col("data_value")).alias("data_value")))
    return levels if existing is None else materialize(levels, existing)


# Fixed value: metres per foot.
FOOT_M = 0.3048


def piecewise_calc(observations: DataFrame, segments: DataFrame) -> DataFrame:
    """Calculated stream with time-ranged sensor elevations.

    ``segments`` has one row per stream: ``datastream_id, casing_ft`` and ``ranges``, an array of
    ``(start_epoch, end_epoch, elevation_ft)``. Inside an inclusive range the value becomes
    ``casing - (casing - elevation) + value`` in metres; the last matching range wins, outside nothing changes.
    """
    t = F.col("utc_time")
    hits = F.filter("ranges", lambda r: (t >= r["start_epoch"]) & (t <= r["end_epoch"]))
    elevation = F.try_element_at(hits, F.lit(-1))["elevation_ft"] * FOOT_M
    casing = F.col("casing_ft") * FOOT_M
    moved = casing - (casing - elevation) + F.col("data_value")
    return (observations.join(segments, "datastream_id", "left")
            .withColumn("data_value", F.coalesce(moved, F.col("data_value")))
            .drop("ranges", "casing_ft"))
