"""The stages of a load as functions from frames to frames: ingest, process, check."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.functions.flags import parse_ranges
from sensorlake.functions.names import datastream_name
from sensorlake.operators import checks, process, shaping
from sensorlake.operators.tables import upsert_natural
from sensorlake.session import small_side, written
from sensorlake.sources import manifest, readers, store

NO_RANGES = "array<struct<start_epoch:bigint,end_epoch:bigint,qa_flag:string>>"


def populate_stage(vocabularies: dict[str, tuple[DataFrame | None, DataFrame]], id_col: str = "units_id",
                   unique: str = "term", update_only: bool = False) -> dict[str, DataFrame]:
    """New versions of vocabulary tables from ``name -> (stored, incoming)``: terms that exist are replaced."""
    out = {}
    for name, (stored, incoming) in vocabularies.items():
        if stored is None or id_col not in stored.columns:
            base = incoming if stored is None else stored.join(incoming.select(unique), unique, "left_anti").unionByName(incoming)
            out[name] = base
        else:
            out[name] = upsert_natural(stored, incoming, id_col, [unique], [unique], update_only)
    return out


def ingest_stage(stored: DataFrame | None, incoming: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows to append to a raw table, one per time, and the load statistics."""
    first = shaping.dedupe_first(incoming, ["timestamp"], [c for c in incoming.columns if c != "timestamp"])
    return shaping.append_feeder(stored, first)


@dataclass(frozen=True)
class FilesLoaded:
    """What became of the files of a source, and of the rows of those that were read (None if none was)."""

    listed: int
    new: int
    stale: int
    without_time: int
    rows: store.Loaded | None


def ingest_files(spark: SparkSession, path: str, table: store.Layout, seen: store.Layout, time_col: str = "datetime",
                 fmt: str = "yyyy-MM-dd HH:mm:ss", glob: str = readers.CSV_GLOB, late: str = "drop") -> FilesLoaded:
    """Load the CSV files below ``path`` into a raw table, those that the manifest ``seen`` does not know or that have changed.

    Of such a file the two ends are read. One that ends before the newest stored time is stale: it is noted and not read any further,
    unless late rows are wanted. Files without the time column are noted and counted. The manifest is written after the rows, so a load that
    breaks off in between reads the same files again and finds their rows stored.
    """
    listing = manifest.list_files(spark, path, glob)
    new = written(manifest.unseen(listing, manifest.seen_files(spark, seen)), "new-files")
    looks = manifest.look(spark, new)
    without = set(readers.file_layouts(looks, time_col)[1])
    timed = [x for x in looks if x.file not in without]
    stale: set[str] = set()
    if timed and late == "drop" and store.latest(spark, table):
        newest = store.marks(spark, table).select("last").scalar()
        ends = readers.last_times(spark, timed, time_col, fmt)
        stale = {r["file"] for r in ends.filter(F.col("last_time") <= newest).select("file").collect()}
    fresh = [x for x in timed if x.file not in stale]
    loaded = None
    if fresh:
        rows = readers.read_csv_source(spark, path, time_col, fmt, glob=glob, looks=fresh)
        first = shaping.dedupe_first(rows, ["timestamp"], [c for c in rows.columns if c != "timestamp"])
        loaded = store.load(written(first, "rows"), table, late)
    if looks:
        manifest.record(new, looks, seen)
    return FilesLoaded(listing.count(), len(looks), len(stale), len(without), loaded)


def process_stage(feeder: DataFrame, tz: str, columns: list[str], order: list[str], mapping: DataFrame, units: DataFrame,
                  kinds: DataFrame, ranges: DataFrame, observations: DataFrame | None = None,
                  marks: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Raw wide rows in local time to new flagged observations, and the streams they belong to. New is what is later than the ``marks`` of a
    store, or than the stored ``observations`` themselves; without both, everything is.

    ``feeder``: ``feeder_table``, ``timestamp``, the order columns and the sensors. The zone step runs on the wide
    rows, before they multiply; the mapping, unit and range tables are configuration. Times the clock skips are
    rejected. A mapping with ``feeder_table`` holds per source, and ``sensor_type`` replaces ``measured``. The whole stage shuffles nothing while the per-stream tables are small enough to broadcast.
    """
    timed = process.local_to_epoch(feeder, "timestamp", tz, ["feeder_table"], order).filter("dst_status <> 'gap'")
    # A column without a unit is a stream of unknown unit, which nothing converts.
    exposed = mapping.filter("expose_as_datastream").withColumns({
        "unit_conversion": F.coalesce("unit_conversion", F.lit(False)) & F.col("units_term").isNotNull(),
        "units_term": F.coalesce("units_term", F.lit(process.UNKNOWN)), "variable_term": F.coalesce("variable_term", F.lit(process.UNKNOWN))})
    terms = process.resolve_default_unit(exposed, units, kinds)
    long = process.to_observations(timed.select("feeder_table", "utc_time", *columns), terms, columns, ["feeder_table", "utc_time"])
    sensor_type = F.coalesce("sensor_type", F.lit("measured")) if "sensor_type" in mapping.columns else F.lit("measured")
    name = datastream_name(F.col("feeder_table"), F.col("column_name"), sensor_type)
    named = long.withColumn("datastream_id", F.xxhash64(name))
    manual = F.lit(None).cast(NO_RANGES)
    if "datastream_manual_qa_list" in mapping.columns:
        manual = parse_ranges(F.col("datastream_manual_qa_list"))
    tables = feeder.select("feeder_table").distinct().select("feeder_table", F.explode(F.array(*map(F.lit, columns))).alias("column_name"))
    keys = ["feeder_table", "column_name"] if "feeder_table" in mapping.columns else ["column_name"]
    streams = (tables.join(terms, keys)
               .select(F.xxhash64(name).alias("datastream_id"), name.alias("datastream_tablename"), "column_name", "variable_term",
                       "units_term", "target_units_term", "unit_conversion", manual.alias("manual_ranges")))
    bounds = small_side(process.qa_bounds(streams, ranges, units))
    converted = process.convert_units(named, units).select("datastream_id", "utc_time", "data_value")
    flagged = process.flag_observations(process.materialize(converted, observations, marks), bounds)
    return flagged, bounds


def load_stage(feeder: DataFrame, tz: str, columns: list[str], order: list[str], mapping: DataFrame, units: DataFrame, kinds: DataFrame,
               ranges: DataFrame, layout: store.Layout, late: str = "drop") -> tuple[store.Loaded, DataFrame]:
    """``process_stage`` into a stored table: its marks say what is new, and late rows are counted and dropped or put in place."""
    rows, streams = process_stage(feeder, tz, columns, order, mapping, units, kinds, ranges)
    return store.load(rows.select("datastream_id", "utc_time", "data_value", "qa_flag"), layout, late), streams


def check_stage(registry: DataFrame, observations: DataFrame) -> DataFrame:
    """Registry rows that disagree with the stored observations."""
    return checks.check_registry(registry, observations)
