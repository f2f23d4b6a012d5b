"""Generic table work: upsert, ids, lookups, filters, paging. Every change yields a new table version."""

from __future__ import annotations

import difflib
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sensorlake.session import durable, small_side


def check_columns(df: DataFrame, names) -> None:
    """Unknown column names are an error with a hint."""
    for name in names:
        if name not in df.columns:
            close = difflib.get_close_matches(name, df.columns, n=1)
            raise ValueError(f"unknown column {name!r}" + (f", did you mean {close[0]!r}?" if close else ""))


def upsert(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Insert or replace by primary key; columns the updates do not carry keep their stored value. A key that the updates
    have twice is an error."""
    check_columns(target, updates.columns)
    twice = F.raise_error(F.concat(F.lit(f"more than one update for {key} "), F.col(key).cast("string")))
    single = updates.groupBy(key).agg(F.count("*").alias("_n"), F.first(F.struct(*updates.columns)).alias("_row")).select(
        F.when(F.col("_n") == 1, F.col("_row")).otherwise(twice.cast(updates.select(F.struct(*updates.columns).alias("r")).schema["r"].dataType)).alias("_row"))
    new = single.select("_row.*").select(*[F.col(c).alias(f"_new_{c}") for c in updates.columns], F.lit(True).alias("_hit"))
    joined = target.join(new, F.col(key) == F.col(f"_new_{key}"), "full")

    def merged(name: str) -> Column:
        if name not in updates.columns:
            return F.col(name)
        return F.when(F.col("_hit"), F.col(f"_new_{name}")).otherwise(F.col(name)).alias(name)

    return joined.select(*[merged(c) for c in target.columns])


def bulk_insert(target: DataFrame, rows: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Append rows; a column that is NULL in every new row counts as omitted, so its default applies."""
    check_columns(target, rows.columns)
    present = rows.agg(*[F.count(c).alias(c) for c in rows.columns]).first()
    omitted = [c for c in target.columns if c not in rows.columns or present[c] == 0]
    types = dict(target.dtypes)
    filled = rows.withColumns({c: F.lit(defaults.get(c)).cast(types[c]) for c in omitted}) if omitted else rows
    return target.unionByName(filled.select(*target.columns))


def assign_ids(df: DataFrame, id_col: str, order: list[str], start: int | Column = 1) -> DataFrame:
    """Dense ids from ``start`` in the given order.

    Rows are range-partitioned and sorted once and checkpointed, so both passes see the same layout: the first
    counts rows per partition, the second adds each partition's offset to the row's position. The offset table
    has one row per partition, which is why it may be broadcast.
    """
    placed = durable(df.repartitionByRange(*order).sortWithinPartitions(*order))
    numbered = placed.withColumn("_m", F.monotonically_increasing_id()).withColumns({
        "_part": F.shiftright("_m", 33), "_pos": F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))})
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = numbered.groupBy("_part").agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    first = F.lit(start) if isinstance(start, int) else start
    return (numbered.join(F.broadcast(offsets), "_part")
            .withColumn(id_col, (first + F.col("_offset") + F.col("_pos")).cast("bigint"))
            .drop("_m", "_part", "_pos", "_offset"))


def next_id(target: DataFrame, id_col: str) -> Column:
    """Scalar: one more than the largest id, 1 for an empty table."""
    return target.agg((F.coalesce(F.max(id_col), F.lit(0)) + 1).alias("n")).scalar()


def upsert_natural(target: DataFrame, rows: DataFrame, id_col: str, unique_cols: list[str | tuple[str, ...]], order: list[str],
                   update_only: bool = False) -> DataFrame:
    """Upsert rows that may lack an id.

    The first unique column that hits a stored row gives the id, or the first tuple of columns that do together; rows
    without any hit get new ids. With ``update_only`` a new row is an error.
    """
    found = rows if id_col in rows.columns else rows.withColumn(id_col, F.lit(None).cast("bigint"))
    for unique in unique_cols:
        parts = unique if isinstance(unique, tuple) else (unique,)
        given = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in parts])
        key = F.struct(*parts) if len(parts) > 1 else F.col(parts[0])
        lookup = target.filter(given).groupBy(key.alias("_key")).agg(F.min(id_col).alias("_id"))
        found = (found.join(lookup, key == F.col("_key"), "left")
                 .withColumn(id_col, F.coalesce(id_col, "_id")).drop("_key", "_id"))
    new = found.filter(F.col(id_col).isNull()).drop(id_col)
    known = found.filter(F.col(id_col).isNotNull())
    if update_only:
        if not new.isEmpty():
            raise ValueError("new rows are not allowed in update-only mode")
        return upsert(target, known, id_col)
    return upsert(target, known.unionByName(assign_ids(new, id_col, order, next_id(target, id_col))), id_col)


def split_variables(df: DataFrame, id_col: str = "variable_id") -> tuple[DataFrame, DataFrame]:
    """Variable rows with ranges to the ``variables`` table and the ``variable_qa_min_max`` table."""
    ranges = ("min_valid_range", "max_valid_range")
    variables = df.select(*[c for c in df.columns if c not in ranges])
    return variables, df.select(id_col, "variable_term", *ranges)


def resolve_ids(df: DataFrame, dim: DataFrame, on: list[tuple[str, str]], dim_id: str, as_col: str,
                required: bool = False, count_first: bool = False) -> DataFrame:
    """Add ``as_col``, the id of the first ``(column, dim column)`` pair that matches; a required one must exist.

    With ``count_first`` the names and ids are computed once and broadcast if they are few, so wide rows of ``df`` stay where they are."""
    out, candidates = df, []
    for i, (column, dim_column) in enumerate(on):
        lookup = dim.filter(F.col(dim_column).isNotNull()).groupBy(F.col(dim_column).alias(f"_k{i}")).agg(
            F.min(dim_id).alias(f"_i{i}"))
        if count_first:
            lookup = small_side(lookup)
        out = out.join(lookup, F.col(column) == F.col(f"_k{i}"), "left")
        candidates.append(F.col(f"_i{i}"))
    found = F.coalesce(*candidates)
    if required:
        missing = F.raise_error(F.concat(F.lit(f"no {dim_id} for "), F.coalesce(F.col(on[0][0]).cast("string"), F.lit("NULL"))))
        found = F.coalesce(found, missing.cast("bigint"))
    return out.withColumn(as_col, found).drop(*[f"_{x}{i}" for i in range(len(on)) for x in "ki"])


def find_orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Rows whose foreign key names no parent; NULL keys are allowed."""
    keys = parent.select(F.col(pk).alias("_pk"))
    return child.filter(F.col(fk).isNotNull()).join(keys, F.col(fk) == F.col("_pk"), "left_anti")


def find_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their number."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def read(df: DataFrame, **equal) -> DataFrame:
    """Rows that equal all given values; ``None`` means no condition."""
    check_columns(df, equal)
    for name, value in equal.items():
        if value is not None:
            df = df.filter(F.col(name) == value)
    return df


def read_fuzzy(df: DataFrame, **contains) -> DataFrame:
    """Rows that contain all given texts, case-sensitive; ``%`` and ``_`` act as wildcards."""
    check_columns(df, contains)
    for name, value in contains.items():
        if value is not None:
            df = df.filter(F.col(name).cast("string").like(f"%{value}%"))
    return df


def read_any(df: DataFrame, **options: list) -> DataFrame:
    """Rows where any column has one of its listed values (columns are joined by OR). Values are read as the column's type."""
    check_columns(df, options)
    given = {k: v for k, v in options.items() if v is not None}
    if not given:
        return df
    kinds = dict(df.dtypes)
    tests = [F.coalesce(F.col(name).isin(*[F.lit(v).cast(kinds[name]) for v in values]), F.lit(False)) for name, values in given.items()]
    return df.filter(reduce(lambda a, b: a | b, tests))


def read_one_or_none(df: DataFrame, **equal) -> Row | None:
    """The single matching row; several are an error."""
    rows = read(df, **equal).limit(2).collect()
    if len(rows) > 1:
        raise LookupError(f"more than one row for {equal}")
    return rows[0] if rows else None


def read_one(df: DataFrame, **equal) -> Row:
    """The single matching row; none or several are an error."""
    row = read_one_or_none(df, **equal)
    if row is None:
        raise LookupError(f"no row for {equal}")
    return row


def page(df: DataFrame, order: list[str], limit: int | None = None, offset: int = 0, after=None) -> DataFrame:
    """One page in a fixed order. ``after`` (last key of the previous page) reads deep pages without skipping rows."""
    if after is not None:
        df = df.filter(F.col(order[0]) > after)
    out = df.orderBy(*order)
    if offset:
        out = out.offset(offset)
    return out if limit is None else out.limit(limit)


def count(df: DataFrame, **equal) -> DataFrame:
    """Number of matching rows."""
    return read(df, **equal).agg(F.count("*").alias("row_count"))


def columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Projection."""
    check_columns(df, names)
    return df.select(*names)


def distinct(df: DataFrame, name: str, order: list[str] | None = None, limit: int | None = None, offset: int = 0) -> DataFrame:
    """Distinct values of one column, taken after paging."""
    paged = df if limit is None and not offset else page(df, order or df.columns, limit, offset)
    return paged.select(name).distinct()


def insert(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Append rows; columns they lack become NULL."""
    check_columns(target, rows.columns)
    return target.unionByName(rows, allowMissingColumns=True)


def update_rows(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Change rows by key; a NULL in the updates leaves the stored value, unknown keys change nothing."""
    check_columns(target, updates.columns)
    if key not in updates.columns:
        raise ValueError(f"updates need the key {key!r}")
    new = updates.select(*[F.col(c).alias(f"_new_{c}") for c in updates.columns])
    joined = target.join(new, F.col(key) == F.col(f"_new_{key}"), "left")
    return joined.select(*[F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) if c in updates.columns and c != key else F.col(c)
                           for c in target.columns])


def delete_rows(target: DataFrame, **equal) -> DataFrame:
    """Everything but the rows that equal all given values."""
    check_columns(target, equal)
    tests = [F.col(k) == v for k, v in equal.items() if v is not None]
    if not tests:
        return target.limit(0)
    return target.filter(~F.coalesce(reduce(lambda a, b: a & b, tests), F.lit(False)))


def follow(df: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Rows with the columns of the record their foreign key names."""
    return df.join(parent, F.col(fk) == F.col(pk), "left")
