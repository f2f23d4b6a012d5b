"""Versioned parquet tables: every write is a new folder, readers take the newest complete one."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Times a writer takes the next number after another one was faster.
ATTEMPTS = 100


def claim(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file unless there is one; of writers that try at once, the file system lets one through."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        out = fs.create(target, False)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    out.write(bytearray(f"{text}\n", "utf-8"))
    out.close()
    return True


def _marks(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema("version bigint, folder string").json(f"{path}/_versions")
    except AnalysisException:
        return None


def latest(spark: SparkSession, path: str) -> int:
    """Newest complete version, 0 when there is none. A version counts once its mark is written, after the data."""
    marks = _marks(spark, path)
    return 0 if marks is None else (marks.agg(F.max("version")).first()[0] or 0)


def exists(spark: SparkSession, path: str) -> bool:
    return latest(spark, path) > 0


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of the table, the newest by default."""
    marks, version = _marks(spark, path), version or latest(spark, path)
    row = marks.filter(F.col("version") == version).first() if marks is not None else None
    if row is None:
        raise ValueError(f"no version {version} of {path}")
    return spark.read.parquet(f"{path}/{row['folder']}")


def write(df: DataFrame, path: str, partition_by: list[str] | None = None) -> int:
    """Write the next version. Each try has a folder of its own, and its number is claimed when the data is there: an interrupted write leaves no
    mark, and of two writers the later one takes the number after."""
    spark, folder = df.sparkSession, f"v{uuid.uuid4().hex}"
    (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(f"{path}/{folder}")
    for _ in range(ATTEMPTS):
        version = latest(spark, path) + 1
        if claim(spark, f"{path}/_versions/{version:020d}.json", json.dumps({"version": version, "folder": folder})):
            return version
    raise RuntimeError(f"other writers to {path} were faster {ATTEMPTS} times")


def write_observations(df: DataFrame, path: str, buckets: int = 64) -> None:
    """Append observations by stream bucket and year, sorted by stream and time inside the files.

    The shuffle is by bucket, year and a time-derived slice, so a dominant stream is spread over many writers
    while each file still covers a narrow range of streams and times.
    """
    bucket = F.pmod(F.xxhash64("datastream_id"), F.lit(buckets)).cast("int")
    year = F.year(F.timestamp_seconds("utc_time"))
    month = F.month(F.timestamp_seconds("utc_time"))
    (df.withColumns({"bucket": bucket, "year": year, "_month": month})
     .repartition("bucket", "year", "_month").drop("_month")
     .sortWithinPartitions("bucket", "year", "datastream_id", "utc_time")
     .write.mode("append").partitionBy("bucket", "year").parquet(path))
