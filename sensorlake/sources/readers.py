"""File sources: CSV directories, data-logger files, two-row headers, split headers, JSON payloads.

Header lines are taken by their place in the file: only the first block of each file is read for them. Data is read by Spark's own
readers, one scan per header layout.
"""

from __future__ import annotations

import csv
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.functions.names import clean_name
from sensorlake.functions.numbers import coerce_numeric
from sensorlake.operators.shaping import assemble_wide
from sensorlake.sources import manifest

CSV_GLOB = "*.[cC][sS][vV]"
DAT_GLOB = "*.[dD][aA][tT]"
MISSING = ("error", "skip")


@dataclass(frozen=True)
class Layout:
    """Files that begin with the same lines: the names of their columns, the one of the time, and the lines."""

    names: tuple[str, ...]
    time: str
    lines: tuple[str, ...]
    files: tuple[str, ...]


class MissingTime(ValueError):
    """Files without the time column; ``files`` are their paths."""

    def __init__(self, time_col: str, files: list[str]):
        super().__init__(f"no {time_col!r} column in {len(files)} files: {', '.join(files[:5])}")
        self.files = files


def file_layouts(looks: list[manifest.Look], time_col: str, line: int = 0, repair=lambda names: names) -> tuple[list[Layout], list[str]]:
    """Files by header, and the files whose header has no ``time_col``. The names are in line number ``line``."""
    layouts: dict[tuple, list[str]] = {}
    for x in looks:
        layouts.setdefault(x.lines, []).append(x.file)
    good, without = [], []
    for lines, files in layouts.items():
        names = tuple(repair(split_header(lines[line]))) if len(lines) > line else ()
        time = [n for n in names if n.casefold() == time_col.casefold()]
        if time:
            good.append(Layout(tuple(_unique(list(names))), time[0], lines, tuple(files)))
        else:
            without += files
    return good, sorted(without)


def _layouts(spark: SparkSession, path: str, glob: str, time_col: str, count: int, line: int, missing: str, looks: list[manifest.Look] | None = None,
             repair=lambda names: names) -> list[Layout]:
    if missing not in MISSING:
        raise ValueError(f"missing must be one of {MISSING}")
    if looks is None:
        looks = manifest.look(spark, manifest.list_files(spark, path, glob), count)
    layouts, without = file_layouts(looks, time_col, line, repair)
    if without and missing == "error":
        raise MissingTime(time_col, without)
    if not layouts:
        raise ValueError(f"no file {glob} with a {time_col!r} column in {path}")
    return layouts


def split_header(line: str) -> list[str]:
    """Names of a CSV header line."""
    return [name.strip() for name in next(csv.reader([line]), [""])]


def _unique(names: list[str]) -> list[str]:
    if len(names) != len(set(names)):
        raise ValueError(f"column names must be unique: {names}")
    return names


def _text_schema(names: list[str]) -> str:
    return ", ".join(f"`{name.replace('`', '``')}` STRING" for name in names)


def _column(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def read_csv_source(spark: SparkSession, path: str, time_col: str = "datetime", fmt: str = "yyyy-MM-dd HH:mm:ss", ordered: bool = False,
                    glob: str = CSV_GLOB, missing: str = "error", looks: list[manifest.Look] | None = None) -> DataFrame:
    """All CSV files of one source as one wide frame: ``timestamp`` first, sensors as doubles, cleaned names, full duplicates dropped. Files may have
    different columns. A file without ``time_col`` in its first line is an error that names it, or with ``missing="skip"`` left out
    (``files_without_time`` lists them). ``looks`` limits the source to files that were looked at before."""
    parts = []
    for x in _layouts(spark, path, glob, time_col, 1, 0, missing, looks):
        raw = spark.read.schema(_text_schema(x.names)).option("header", "true").csv(list(x.files))
        parts.append(raw.select(
            F.to_timestamp_ntz(_column(x.time), F.lit(fmt)).alias("timestamp"),
            *[coerce_numeric(_column(n)).alias(clean_name(n, "csv")) for n in x.names if n != x.time]))
    out = _union(parts).dropDuplicates()
    return out.orderBy("timestamp") if ordered else out


def files_without_time(spark: SparkSession, path: str, time_col: str = "datetime", glob: str = CSV_GLOB) -> DataFrame:
    """``file, columns`` of the files whose first line has no ``time_col``. Files without bytes are not listed."""
    looks = manifest.look(spark, manifest.list_files(spark, path, glob))
    without = set(file_layouts(looks, time_col)[1])
    return spark.createDataFrame([(x.file, split_header(x.lines[0]) if x.lines else []) for x in looks if x.file in without], "file string, columns array<string>")


def _is_line(names: tuple[str, ...], line: str) -> Column:
    """Whether a row has just the cells of a header line. A reader that has no name for a cell drops it, and pads a short row."""
    cells = (split_header(line) + [""] * len(names))[:len(names)] if line else [""] * len(names)
    same = F.lit(True)
    for name, cell in zip(names, cells):
        same &= F.trim(F.coalesce(_column(name), F.lit(""))) == cell
    return same


def read_logger_dat(spark: SparkSession, path: str, ordered: bool = False, glob: str = DAT_GLOB, missing: str = "error",
                    looks: list[manifest.Look] | None = None) -> DataFrame:
    """Data-logger files: four header lines (station, names, units, processing) of which only the names count.

    The header lines are the first four of the file; rows like them are left out wherever a file is split between tasks, and any other
    row without a time is an error. The frame keeps ``source_file`` for incremental loads.
    """
    parts = []
    for x in _layouts(spark, path, glob, "timestamp", 4, 1, missing, looks, lambda names: [n.lower() for n in names]):
        raw = spark.read.schema(_text_schema(x.names)).csv(list(x.files)).select("*", F.col("_metadata.file_name").alias("source_file"))
        header = F.lit(False)
        for line in x.lines:
            header |= _is_line(x.names, line)
        time = F.try_to_timestamp(_column(x.time))
        bad = F.raise_error(F.concat(F.lit("no time in "), F.col("source_file"), F.lit(": "), F.coalesce(_column(x.time), F.lit("NULL")))).cast("timestamp")
        parts.append(raw.filter(~header).select(
            F.coalesce(time, bad).cast("timestamp_ntz").alias("timestamp"), "source_file",
            *[coerce_numeric(_column(n)).alias(n) for n in x.names if n != x.time]))
    merged = _union(parts)
    out = merged.dropDuplicates([c for c in merged.columns if c != "source_file"])
    return out.orderBy("timestamp") if ordered else out


def last_times(spark: SparkSession, looks: list[manifest.Look], time_col: str, fmt: str = "yyyy-MM-dd HH:mm:ss", line: int = 0) -> DataFrame:
    """``file, last_time`` from the last line of each file; NULL if that is no reading."""
    rows = []
    for x in looks:
        names = [n.casefold() for n in split_header(x.lines[line])] if len(x.lines) > line else []
        cells = split_header(x.last_line) if x.last_line else []
        at = names.index(time_col.casefold()) if time_col.casefold() in names else len(cells)
        rows.append((x.file, cells[at] if at < len(cells) else None))
    found = spark.createDataFrame(rows, "file string, cell string")
    return found.select("file", F.try_to_timestamp("cell", F.lit(fmt)).cast("timestamp_ntz").alias("last_time"))


def prune_files(manifest: DataFrame, high_water: DataFrame, key: str = "source") -> DataFrame:
    """Files that still hold readings newer than the stored ones.

    ``manifest`` has one row per file (``source, file, last_time``), ``high_water`` one per source
    (``source, stored_time``); a source without stored data keeps all files, and so does a file without a last time.
    """
    joined = manifest.join(high_water, key, "left")
    return joined.filter(F.col("stored_time").isNull() | F.col("last_time").isNull() | (F.col("last_time") > F.col("stored_time"))).drop("stored_time")


def repair_split_header(names: list[str], prefix: str, parts: int) -> list[str]:
    """Rejoin a header name that itself holds commas and was read as ``parts`` names."""
    for i, name in enumerate(names):
        if name.startswith(prefix):
            return names[:i] + [",".join(names[i:i + parts])] + names[i + parts:]
    return names


def read_epoch_csv(spark: SparkSession, path: str, time_col: str, prefix: str, parts: int,
                   glob: str = CSV_GLOB, missing: str = "error") -> DataFrame:
    """CSV with an epoch column and one header name that was split at its commas.

    Data lines have one field per real column, so the repaired header is the schema. An epoch outside the
    timestamp range is an error.
    """
    frames = []
    for x in _layouts(spark, path, glob, time_col, 1, 0, missing, repair=lambda names: [n.lower() for n in repair_split_header(names, prefix, parts)]):
        raw = spark.read.schema(_text_schema(x.names)).option("header", "true").csv(list(x.files))
        epoch = _column(x.time).cast("bigint")
        bad = F.raise_error(F.concat(F.lit("timestamp cannot be converted: "), epoch.cast("string")))
        safe = F.when(epoch.between(-62135596800, 253402300799), F.timestamp_seconds(epoch)).otherwise(bad.cast("timestamp"))
        frames.append(raw.select(
            safe.cast("timestamp_ntz").alias("timestamp"),
            *[coerce_numeric(_column(n)).alias(n) for n in x.names if n != x.time]))
    return _union(frames).dropDuplicates()


def read_two_row_header(spark: SparkSession, path: str, time_col: str = "datetime",
                        time_unit: str = "timestamp", glob: str = CSV_GLOB, missing: str = "error") -> tuple[DataFrame, DataFrame]:
    """CSV whose second line holds units: ``(samples as text, column_name/units_term table)``.

    The time cell of the second line has to be the word ``time_unit``. The units come from the headers that the driver has looked at, so
    they are marked for broadcast: a shuffle of the samples by column name would leave a task for each column.
    """
    samples, units = [], []
    for x in _layouts(spark, path, glob, time_col, 2, 0, missing):
        second = (split_header(x.lines[1]) if len(x.lines) > 1 else []) + [""] * len(x.names)
        if second[x.names.index(x.time)] != time_unit:
            raise ValueError(f"the second line holds no units: {', '.join(x.files[:5])}")
        raw = spark.read.schema(_text_schema(x.names)).option("header", "true").csv(list(x.files))
        cells = [n for n in x.names if n != x.time]
        samples.append(raw.filter(~_is_line(x.names, x.lines[1])).select(
            F.to_timestamp_ntz(_column(x.time), F.lit("yyyy-MM-dd HH:mm:ss")).alias("timestamp"),
            *[_column(n) for n in cells]))
        units += [(n, second[k] or None) for k, n in enumerate(x.names) if n != x.time]
    return _union(samples), F.broadcast(spark.createDataFrame(list(dict.fromkeys(units)), "column_name string, units_term string"))


PAYLOAD_SCHEMA = ("struct<parameters:array<struct<parameterId:string,unitId:string,"
                  "readings:array<struct<timestamp:bigint,value:double>>>>>")


def flatten_payload(payloads: DataFrame, body: str, keys: list[str], parameters: DataFrame, units: DataFrame,
                    names: list[str]) -> DataFrame:
    """Device payloads to one wide row per device and epoch, columns ``<parameter>[<unit>]``.

    ``parameters`` and ``units`` map provider ids to names; ``names`` lists the wide columns.
    An id that is not among them is an error.
    """
    def unknown(name: str) -> Column:
        return F.raise_error(F.concat(F.lit(f"unknown {name} "), F.coalesce(name, F.lit("NULL")))).cast("string")

    parsed = payloads.select(*keys, F.explode(F.from_json(body, PAYLOAD_SCHEMA)["parameters"]).alias("p"))
    readings = parsed.select(*keys, "p.parameterId", "p.unitId", F.explode("p.readings").alias("r"))
    named = (readings.join(parameters.select(F.col("id").alias("parameterId"), F.col("nice_name").alias("parameter")), "parameterId", "left")
             .join(units.select(F.col("id").alias("unitId"), F.col("nice_name").alias("unit")), "unitId", "left")
             .withColumns({"parameter": F.coalesce("parameter", unknown("parameterId")), "unit": F.coalesce("unit", unknown("unitId"))})
             .select(*keys, F.col("r.timestamp").alias("timestamp"),
                     F.concat("parameter", F.lit("["), "unit", F.lit("]")).alias("name"), F.col("r.value").alias("value")))
    return assemble_wide(named, [*keys, "timestamp"], "name", "value", names)
