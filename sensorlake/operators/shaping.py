"""Shaping raw frames: wide assembly, pruning, dedupe, incremental append."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_series(series: DataFrame, mapper: DataFrame, code: str = "series_code") -> DataFrame:
    """Keep series whose code suffix (after the last colon) is a mapper id."""
    ids = mapper.select(F.col("id").alias("_id")).distinct()
    return series.join(ids, F.substring_index(F.col(code), ":", -1) == F.col("_id"), "left_semi")


def assemble_wide(long: DataFrame, keys: list[str], variable: str, value: str, variables: list[str],
                  order: str | None = None) -> DataFrame:
    """One row per key with one column per variable; a variable without data becomes a NULL column.

    A repeated (key, variable) keeps its first value by ``order`` (the smallest value without one). One conditional
    aggregate per column: a single shuffle, reduced before it.
    """
    def cell(name: str) -> Column:
        here = F.col(variable) == name
        if order is None:
            return F.min(F.when(here, F.col(value)))
        return F.min(F.when(here, F.struct(order, F.col(value).alias("v"))))["v"]

    return long.groupBy(*keys).agg(*[cell(name).alias(name) for name in variables])


def prune_columns(columns: list[str], mapper: dict[str, str], keep: list[str]) -> tuple[dict[str, str], list[str]]:
    """Columns to keep with their clean names, and the skipped ones.

    Dropped are quality columns (``_cd``), discontinued sensors, and everything the mapper does not know.
    """
    chosen, skipped = {}, []
    for name in columns:
        if name in keep:
            chosen[name] = name
        elif "_cd" in name or "discontinued" in name or name not in mapper:
            skipped.append(name)
        else:
            chosen[name] = mapper[name]
    return chosen, skipped


def prune_and_rename(df: DataFrame, mapper: dict[str, str], keep: list[str]) -> DataFrame:
    """Project to the mapped columns under their clean names; the rest is never read."""
    chosen, _ = prune_columns(df.columns, mapper, keep)
    return df.select(*[F.col(f"`{name}`").alias(clean) for name, clean in chosen.items()])


def dedupe_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row per key by an explicit order, as one aggregate that is reduced before the shuffle."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    first = F.min(F.struct(*order, *rest)).alias("r")
    return df.groupBy(*keys).agg(first).select(*keys, *[F.col(f"r.{c}") for c in df.columns if c not in keys])


def clean_image_metadata(df: DataFrame) -> DataFrame:
    """Flatten the nested metadata, trim texts, parse the camera time, drop hidden files, unknown times and
    zero-sized images."""
    flat = df.select(*[c for c in df.columns if c != "imageMediaMetadata"], "imageMediaMetadata.*")
    trimmed = flat.select(*[F.trim(c).alias(c) if t == "string" else F.col(c) for c, t in flat.dtypes])
    return (trimmed.filter(~flat["name"].startswith("."))
            .withColumn("time", F.try_to_timestamp("time", F.lit("yyyy:MM:dd HH:mm:ss")).cast("timestamp_ntz"))
            .filter("time IS NOT NULL AND width <> 0 AND height <> 0"))


def normalize_ragged(df: DataFrame, values: str, headers: list[str], keep: list[str]) -> DataFrame:
    """Ragged cell arrays to columns: short rows padded, long rows cut, text trimmed, blank to NULL."""
    def cell(i: int) -> Column:
        return F.nullif(F.trim(F.coalesce(F.get(F.col(values), F.lit(i)), F.lit(""))), F.lit(""))

    return df.select(*keep, *[cell(i).alias(name) for i, name in enumerate(headers)])


def append_feeder(existing: DataFrame | None, new: DataFrame, ts: str = "timestamp") -> tuple[DataFrame, DataFrame]:
    """Rows to append and load statistics.

    Kept are rows with a time later than everything stored; the newest stored time is a scalar subquery. New
    columns are allowed (append with ``mergeSchema``), missing ones become NULL. Rows without time are counted.
    """
    if len(new.columns) != len(set(new.columns)):
        raise ValueError("column names must be unique")
    first = new.select(ts, *[c for c in new.columns if c != ts])
    delta = first.filter(F.col(ts).isNotNull())
    late = F.lit(False)
    if existing is not None:
        newest = existing.agg(F.max(ts)).scalar()
        late = F.coalesce(F.col(ts) <= newest, F.lit(False))
        delta = delta.filter(~late)
        missing = [f for f in existing.schema.fields if f.name not in first.columns]
        delta = delta.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}) if missing else delta
    stats = first.select(F.col(ts).isNull().alias("no_time"), late.alias("late")).agg(
        F.count("*").alias("rows_read"), F.count_if("no_time").alias("rows_without_time"),
        F.count_if("late").alias("rows_not_newer"))
    return delta, stats


class HeaderError(ValueError):
    """New data does not fit the stored header."""


def reconcile_append(old: DataFrame, new: DataFrame, ignore_missing: bool = True, update_added: bool = True) -> DataFrame:
    """Append with header check: nothing in common is an error; missing or added columns follow the two policies."""
    before, after = set(old.columns), set(new.columns)
    missing, added = sorted(before - after), sorted(after - before)
    if not before & after:
        raise HeaderError("new data has no column in common with the stored data")
    if missing and not ignore_missing:
        raise HeaderError(f"new data lacks columns {missing} (extra columns {added})")
    if added and not update_added:
        raise HeaderError(f"new data has unexpected columns {added}")
    return old.unionByName(new, allowMissingColumns=True)


def copy_incremental(source: DataFrame, target: DataFrame | None, id_col: str, target_id_col: str | None = None) -> DataFrame:
    """Rows of ``source`` beyond the target's largest id, shaped like the target. Without target: everything."""
    if target is None:
        return source
    common = [c for c in target.columns if c in source.columns]
    if not common:
        raise ValueError("no common columns")
    if id_col != (target_id_col or id_col) or id_col not in common:
        raise ValueError("id column mismatch")
    newest = target.agg(F.max(id_col)).scalar()
    shaped = [F.col(f.name) if f.name in common else F.lit(None).cast(f.dataType).alias(f.name) for f in target.schema.fields]
    return source.filter(newest.isNull() | (F.col(id_col) > newest)).select(*shaped)


def split_blocks(df: DataFrame, blocks: dict[str, list[str]], time_col: str) -> dict[str, DataFrame]:
    """One projection per configured block; each reads only its own columns."""
    return {table: df.select(F.col(time_col).alias("timestamp"), *columns).dropDuplicates() for table, columns in blocks.items()}


def split_blocks_long(df: DataFrame, block_of: DataFrame, columns: list[str], ids: list[str]) -> DataFrame:
    """All blocks in one pass as ``feeder_table, ids, column_name, value``; write with ``partitionBy``."""
    return df.unpivot(ids, columns, "column_name", "value").join(block_of, "column_name")
