"""Outputs: CSV, JSON rows, table-shaped JSON, snapshots, change-aware writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.sources import versions


def json_rows(df: DataFrame) -> DataFrame:
    """One JSON object per row, null fields included."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("json"))


def json_arrays(df: DataFrame) -> DataFrame:
    """One JSON array of the row's values, in column order."""
    def item(name: str, kind: str) -> Column:
        c = F.col(f"`{name}`")
        if kind in ("float", "double"):  # JSON has no NaN and no infinity
            return F.when(c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")), F.lit("null")).otherwise(c.cast("string"))
        if kind.startswith(("array", "map", "struct", "binary")):
            c = c if not kind.startswith("binary") else F.base64(c)
        elif kind in ("string", "timestamp_ntz", "timestamp", "date"):
            c = c.cast("string")
        else:
            return F.coalesce(c.cast("string"), F.lit("null"))
        text = F.to_json(F.struct(c.alias("v")), {"ignoreNullFields": "false"})
        return F.regexp_extract(text, r'(?s)^\{"v":(.*)\}$', 1)

    return df.select(F.concat(F.lit("["), F.concat_ws(",", *[item(n, k) for n, k in df.dtypes]), F.lit("]")).alias("json"))


def write_csv(df: DataFrame, path: str) -> None:
    """Standard CSV with header."""
    df.write.mode("errorifexists").option("header", "true").option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines."""
    df.write.mode("errorifexists").option("ignoreNullFields", "false").json(path)


def write_json_table(df: DataFrame, path: str, limit: int | None = None, offset: int = 0) -> DataFrame:
    """Table shape: rows as JSON arrays in ``path/rows`` and one header record in ``path/header``, which is returned.

    ``limit`` and ``offset`` take a page of ``df`` in its own order; the header counts the rows of the whole table.
    """
    part = df.offset(offset) if offset else df
    json_arrays(part if limit is None else part.limit(limit)).write.mode("errorifexists").text(f"{path}/rows")
    header = df.agg(F.count("*").alias("row_count")).select(
        F.array(*[F.lit(c) for c in df.columns]).alias("headers"), "row_count",
        F.lit(limit).cast("int").alias("limit"), F.lit(offset).alias("offset"))
    header.write.mode("errorifexists").option("ignoreNullFields", "false").json(f"{path}/header")
    return header


def snapshot(tables: dict[str, DataFrame], path: str, include: list[str] | None = None,
             exclude: list[str] | None = None) -> list[str]:
    """Write every non-empty table as JSON lines below ``path``; returns the names written."""
    written = []
    for name, df in tables.items():
        if (include is not None and name not in include) or name in (exclude or []):
            continue
        if not df.isEmpty():
            write_json(df, f"{path}/{name}")
            written.append(name)
    return written


def row_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows that differ between two versions: ``change`` is ``added`` or ``removed``; duplicates count."""
    columns = new.columns
    counted = (new.withColumn("_d", F.lit(1)).unionByName(old.select(*columns).withColumn("_d", F.lit(-1)))
               .groupBy(*columns).agg(F.sum("_d").alias("surplus")).filter("surplus <> 0"))
    return counted.select(F.when(F.col("surplus") > 0, "added").otherwise("removed").alias("change"),
                          F.abs("surplus").alias("times"), *columns)


def write_if_changed(df: DataFrame, path: str) -> bool:
    """Write a new version of the table at ``path`` only when its content differs; old versions stay."""
    spark = df.sparkSession
    if versions.exists(spark, path) and row_changes(versions.read(spark, path), df).isEmpty():
        return False
    versions.write(df, path)
    return True
