"""Stored tables that grow by loads: cells, high-water marks, late rows, merges.

A table is split into cells by partition columns, such as stream bucket and year. A commit writes its rows into a folder of its own, and
beside it two small tables: which folders hold which cell from now on, and the newest stored value of each stream (its mark). So

* a load reads the marks and the new rows, never the stored rows;
* a merge rewrites the cells in which something changes, and no file of any other cell;
* a reader takes the folders of one commit, and of those only the cells it asks for.

A commit counts once its number is claimed. The claim is a file that must not exist yet, so of two writers that started from the same
commit one gets the number, and the other one starts again from what is stored by then. What an interrupted or beaten writer leaves
behind is referred to by nothing.

Marks and cells are rewritten whole with each commit: one row per stream, and one per cell and folder. ``compact`` brings cells that many
loads have added to back to one folder. Folders that later commits have replaced are kept, as older versions are read from them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from sensorlake.session import written
from sensorlake.sources.versions import claim

LATE = ("drop", "upsert")
#: Times a writer starts again after another one was faster.
ATTEMPTS = 5


class Conflict(RuntimeError):
    """Other writers were faster each time."""


@dataclass(frozen=True)
class Layout:
    """Where a table is and how it is split.

    ``cells`` are partition columns (whole numbers) as SQL over the rows. ``unique`` names the columns that identify a row, ``keys`` those of
    a stream (none: the table is one stream), ``order`` the column whose greatest value per stream is its mark. ``spread``, SQL over
    the rows, deals the rows of a large cell to several writers.
    """

    path: str
    cells: dict[str, str]
    unique: tuple[str, ...]
    order: str
    keys: tuple[str, ...] = ()
    spread: str | None = None

    def cell_columns(self) -> dict[str, Column]:
        return {name: F.expr(sql).cast("int") for name, sql in self.cells.items()}


def observation_layout(path: str, buckets: int = 64) -> Layout:
    """Observations by stream bucket and year; a dominant stream is written by month."""
    return Layout(path, {"bucket": f"pmod(xxhash64(datastream_id), {buckets})", "year": "year(timestamp_seconds(utc_time))"},
                  ("datastream_id", "utc_time"), "utc_time", ("datastream_id",), "month(timestamp_seconds(utc_time))")


def feeder_layout(path: str, ts: str = "timestamp") -> Layout:
    """A raw wide table by year, with one mark for all of it."""
    return Layout(path, {"year": f"year({ts})"}, (ts,), ts, (), f"dayofyear({ts})")


def keyed_layout(path: str, key: str, buckets: int = 64) -> Layout:
    """A metadata table by key bucket."""
    return Layout(path, {"bucket": f"pmod(xxhash64({key}), {buckets})"}, (key,), key)


@dataclass(frozen=True)
class Loaded:
    """What became of the rows of a load."""

    version: int
    rows_read: int
    rows_new: int
    rows_late: int
    rows_without_order: int


def _commits(spark: SparkSession, layout: Layout) -> DataFrame | None:
    try:
        return spark.read.schema("version bigint, token string, parent string, columns string").json(f"{layout.path}/_commits")
    except AnalysisException:
        return None


def _state(spark: SparkSession, layout: Layout, version: int | None = None) -> dict | None:
    """The commit of a version, the newest by default; one row reaches the driver."""
    commits = _commits(spark, layout)
    if commits is None:
        return None
    if version is not None:
        commits = commits.filter(F.col("version") == version)
    row = commits.orderBy(F.col("version").desc()).limit(1).collect()
    if version is not None and not row:
        raise ValueError(f"no version {version} of {layout.path}")
    return row[0].asDict() if row else None


def latest(spark: SparkSession, layout: Layout) -> int:
    """Newest version, 0 for a table without any."""
    state = _state(spark, layout)
    return state["version"] if state else 0


def _table(spark: SparkSession, layout: Layout, kind: str, state: dict) -> DataFrame:
    return spark.read.parquet(f"{layout.path}/_{kind}/{state['token']}")


def marks(spark: SparkSession, layout: Layout, version: int | None = None) -> DataFrame:
    """``keys, last``: the newest stored value of each stream, one row without columns of a stream. An empty store has none."""
    state = _state(spark, layout, version)
    if state is None:
        raise ValueError(f"nothing is stored at {layout.path}")
    return _table(spark, layout, "marks", state)


def _folder(cell: dict, names: list[str]) -> str:
    values = ("__HIVE_DEFAULT_PARTITION__" if cell[n] is None else cell[n] for n in names)
    return "/".join([f"load={cell['load']}", *(f"{n}={v}" for n, v in zip(names, values))])


def _read_cells(spark: SparkSession, layout: Layout, state: dict, where: Column | None = None) -> DataFrame:
    """Rows of the cells that ``where`` (over cell columns) keeps, with the cell columns. The driver gets the folder names."""
    names = list(layout.cells)
    cells = _table(spark, layout, "cells", state)
    folders = [_folder(c.asDict(), names) for c in (cells if where is None else cells.filter(where)).collect()]
    columns = StructType.fromJson(json.loads(state["columns"]))
    for name in names:
        columns = columns.add(name, IntegerType())
    if not folders:
        return spark.createDataFrame([], columns)
    rows = spark.read.schema(columns).option("basePath", f"{layout.path}/rows").parquet(*(f"{layout.path}/rows/{f}" for f in folders)).select(*columns.names)
    # The same condition on the partition columns: it holds already, and shows in the plan.
    return rows if where is None else rows.filter(where)


def read(spark: SparkSession, layout: Layout, version: int | None = None, where: Column | None = None, cells: bool = False) -> DataFrame:
    """Rows of a version, the newest by default. ``where``, a condition on cell columns, leaves whole cells out before any file is
    looked at; ``cells`` keeps the cell columns."""
    state = _state(spark, layout, version)
    if state is None:
        raise ValueError(f"nothing is stored at {layout.path}")
    rows = _read_cells(spark, layout, state, where)
    return rows if cells else rows.drop(*layout.cells)


def _same(names: tuple[str, ...], left: str, right: str) -> Column:
    condition = F.lit(True)
    for name in names:
        condition &= F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return condition


def _in_cells(cells: list[dict], names: list[str]) -> Column:
    """Rows of the given cells. Cells that differ in the last column only are one condition."""
    together: dict[tuple, list] = {}
    for cell in cells:
        together.setdefault(tuple(cell[n] for n in names[:-1]), []).append(cell[names[-1]])
    keep = F.lit(False)
    for front, lasts in together.items():
        condition = F.lit(True)
        for name, value in zip(names, front):
            condition &= F.col(name).eqNullSafe(F.lit(value).cast("int"))
        known = [v for v in lasts if v is not None]
        here = F.col(names[-1]).isin(known) if known else F.lit(False)
        if len(known) < len(lasts):
            here = F.coalesce(here, F.lit(False)) | F.col(names[-1]).isNull()
        keep |= condition & F.coalesce(here, F.lit(False))
    return keep


def _write(spark: SparkSession, layout: Layout, state: dict | None, rows: DataFrame, replaced: list[dict]) -> int | None:
    """Write ``rows`` as the next commit, in which they take the place of the ``replaced`` cells; the version, or None if another writer
    has it by now."""
    # The letter in front keeps the folder name from being read as a number.
    names, token = list(layout.cells), f"c{uuid.uuid4().hex}"
    placed = rows.withColumns(layout.cell_columns())
    dealt = [F.expr(layout.spread).alias("_spread")] if layout.spread else []
    order = [n for n in (*layout.keys, layout.order) if n not in names]
    folder = f"{layout.path}/rows/load={token}"
    (placed.repartition(*names, *dealt).sortWithinPartitions(*names, *order).write.partitionBy(*names).parquet(folder))
    new = spark.read.schema(placed.schema).parquet(folder)
    here = new.select(*names).distinct().withColumn("load", F.lit(token))
    newest = new.groupBy(*layout.keys).agg(F.max(layout.order).alias("last")).filter("last IS NOT NULL")
    schema = rows.schema
    if state:
        kept = _table(spark, layout, "cells", state)
        here = (kept.filter(~_in_cells(replaced, names)) if replaced else kept).unionByName(here)
        newest = _table(spark, layout, "marks", state).unionByName(newest).groupBy(*layout.keys).agg(F.max("last").alias("last")).filter("last IS NOT NULL")
        known = StructType.fromJson(json.loads(state["columns"]))
        schema = StructType(known.fields + [f for f in rows.schema.fields if f.name not in known.names])
    here.coalesce(1).write.parquet(f"{layout.path}/_cells/{token}")
    newest.write.parquet(f"{layout.path}/_marks/{token}")
    commit = {"version": (state["version"] if state else 0) + 1, "token": token, "parent": state["token"] if state else None,
              "columns": json.dumps(schema.jsonValue())}
    return commit["version"] if claim(spark, f"{layout.path}/_commits/{commit['version']:020d}.json", json.dumps(commit)) else None


def _again(layout: Layout, attempt: Callable[[], int | None]) -> int:
    for _ in range(ATTEMPTS):
        version = attempt()
        if version is not None:
            return version
    raise Conflict(f"other writers to {layout.path} were faster {ATTEMPTS} times")


def _marked(layout: Layout, rows: DataFrame, stored: DataFrame | None) -> DataFrame:
    """``rows`` with ``_late``: not newer than the mark of their stream. The marks are a table of their own: the optimizer knows its size."""
    if stored is None:
        return rows.withColumn("_late", F.lit(False))
    if layout.keys:
        newest = stored.select(F.col("last").alias("_last"), *(F.col(k).alias(f"_key_{k}") for k in layout.keys))
        same = F.lit(True)
        for k in layout.keys:
            same &= F.col(k).eqNullSafe(F.col(f"_key_{k}"))
        joined = rows.join(newest, same, "left").drop(*(f"_key_{k}" for k in layout.keys))
    else:
        joined = rows.withColumn("_last", stored.select("last").scalar())
    return joined.withColumn("_late", F.coalesce(F.col(layout.order) <= F.col("_last"), F.lit(False))).drop("_last")


def _single(layout: Layout, rows: DataFrame, repeated: str) -> DataFrame:
    """One row per ``unique`` columns: the greatest by the other columns in their order, or an error if there is more than one."""
    rest = [c for c in rows.columns if c not in layout.unique]
    best = F.max(F.struct(*rest)).alias("_row") if rest else F.lit(None).alias("_row")
    grouped = rows.groupBy(*layout.unique).agg(best, F.count("*").alias("_n"))
    if repeated == "error":
        name = F.concat_ws(", ", *(F.col(c).cast("string") for c in layout.unique))
        grouped = grouped.withColumn("_n", F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("more than one row for "), name)).cast("long")).otherwise(F.col("_n")))
    return grouped.filter("_n >= 1").select(*(F.col(c) if c in layout.unique else F.col(f"_row.{c}").alias(c) for c in rows.columns))


def _shaped(rows: DataFrame, columns: StructType) -> DataFrame:
    """``rows`` in stored order, columns they lack as NULL, new ones behind."""
    there = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in columns]
    return rows.select(*there, *[c for c in rows.columns if c not in columns.names])


def _changes(spark: SparkSession, layout: Layout, state: dict, delta: DataFrame) -> tuple[DataFrame, list[dict]]:
    """The rows of ``delta`` (one per key) that are not stored like that, and the cells they belong to. Columns that ``delta`` lacks keep
    their stored values."""
    names = list(layout.cells)
    wanted = [r.asDict() for r in delta.withColumns(layout.cell_columns()).select(*names).distinct().collect()]
    if not wanted:
        return delta, []
    stored = _read_cells(spark, layout, state, _in_cells(wanted, names)).drop(*names)
    lacking = [c for c in stored.columns if c not in delta.columns]
    if lacking:
        before = stored.groupBy(*layout.unique).agg(F.max(F.struct(*lacking)).alias("_before"))
        delta = delta.alias("d").join(before.alias("s"), _same(layout.unique, "d", "s"), "left").select("d.*", *(F.col(f"s._before.{c}").alias(c) for c in lacking))
    shaped = _shaped(delta, stored.schema)
    if len(shaped.columns) == len(stored.columns):
        shaped = shaped.alias("d").join(stored.alias("s"), _same(tuple(stored.columns), "d", "s"), "left_anti")
    news = written(shaped, "changes")
    return news, [r.asDict() for r in news.withColumns(layout.cell_columns()).select(*names).distinct().collect()]


def _rewritten(spark: SparkSession, layout: Layout, state: dict, news: DataFrame, touched: list[dict]) -> DataFrame:
    """The rows of the touched cells after the changes."""
    stored = _read_cells(spark, layout, state, _in_cells(touched, list(layout.cells))).drop(*layout.cells)
    kept = stored.alias("s").join(news.select(*layout.unique).alias("d"), _same(layout.unique, "s", "d"), "left_anti")
    return kept.unionByName(news, allowMissingColumns=True)


def load(rows: DataFrame, layout: Layout, late: str = "drop") -> Loaded:
    """Append what is newer than the mark of its stream. Rows that are not newer are late: they are counted, and dropped, or with ``upsert`` put in
    place by their ``unique`` columns (one that is stored alike changes nothing; of several with one key the greatest by the other columns
    counts). Rows without a value of ``order`` are counted and left out. New columns are added, missing ones are NULL. All of it is one commit.
    """
    if late not in LATE:
        raise ValueError(f"late must be one of {LATE}")
    spark, found = rows.sparkSession, {}

    def attempt() -> int | None:
        state = _state(spark, layout)
        marked = _marked(layout, rows, _table(spark, layout, "marks", state) if state else None)
        # Counted in a pass of its own over the columns of stream and order: a count on the way would count a retried task twice.
        found.update(marked.agg(F.count("*").alias("all"), F.count_if("_late").alias("late"),
                                F.count_if(F.col(layout.order).isNull()).alias("without")).first().asDict())
        timed = marked.filter(F.col(layout.order).isNotNull())
        new, touched = timed.filter(~F.col("_late")).drop("_late"), []
        if state:
            new = _shaped(new, StructType.fromJson(json.loads(state["columns"])))
        if late == "upsert" and found["late"]:
            news, touched = _changes(spark, layout, state, _single(layout, timed.filter("_late").drop("_late"), "greatest"))
            if touched:
                new = _rewritten(spark, layout, state, news, touched).unionByName(new, allowMissingColumns=True)
        if state and not touched and found["all"] == found["late"] + found["without"]:
            return state["version"]
        return _write(spark, layout, state, new, touched)

    version = _again(layout, attempt)
    return Loaded(version, found["all"], found["all"] - found["late"] - found["without"], found["late"], found["without"])


def merge(delta: DataFrame, layout: Layout, repeated: str = "error") -> int:
    """Insert or replace by the ``unique`` columns, whatever the marks say. Only cells with a change are rewritten. A key that ``delta`` has
    twice is an error, or with ``repeated="greatest"`` the greatest row counts. Without a change the version stays."""
    if repeated not in ("error", "greatest"):
        raise ValueError("repeated must be error or greatest")
    spark = delta.sparkSession

    def attempt() -> int | None:
        state, single = _state(spark, layout), _single(layout, delta, repeated)
        if state is None:
            return _write(spark, layout, None, single, [])
        news, touched = _changes(spark, layout, state, single)
        if not touched:
            return state["version"]
        return _write(spark, layout, state, _rewritten(spark, layout, state, news, touched), touched)

    return _again(layout, attempt)


def compact(spark: SparkSession, layout: Layout, folders: int = 1) -> int:
    """Rewrite cells that are spread over more than ``folders`` folders into one; the version."""
    def attempt() -> int | None:
        state = _state(spark, layout)
        if state is None:
            return 0
        cells = _table(spark, layout, "cells", state).groupBy(*layout.cells).count().filter(F.col("count") > folders).drop("count")
        many = [r.asDict() for r in cells.collect()]
        if not many:
            return state["version"]
        return _write(spark, layout, state, _read_cells(spark, layout, state, _in_cells(many, list(layout.cells))).drop(*layout.cells), many)

    return _again(layout, attempt)


def rebuild_marks(spark: SparkSession, layout: Layout) -> DataFrame:
    """The marks as the stored rows say, from a scan of all of them: to compare with ``marks`` and to repair them."""
    return read(spark, layout).groupBy(*layout.keys).agg(F.max(layout.order).alias("last")).filter("last IS NOT NULL")
