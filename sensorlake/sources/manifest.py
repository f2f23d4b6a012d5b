"""Files of a source: what is there, what has been read before, and how each file begins and ends.

A listing opens no file. Of a file that is new, or that has another size or time than before, the first block is read for its header
lines, taken by their place, and the last block for its newest reading; both are small reads that the driver does side by side, for new
files only. What is known of a file goes to a manifest, a stored table by file, so the next load opens only what has changed.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.sources import store

#: Bytes read at either end of a file, and files looked at side by side.
BLOCK, AT_ONCE = 1 << 16, 16
ENTRY = "file string, size bigint, modified timestamp, lines array<string>, last_line string"


@dataclass(frozen=True)
class Look:
    """The first lines and the last line of a file."""

    file: str
    lines: tuple[str, ...]
    last_line: str | None


def list_files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """``file, size, modified`` of all files below ``path`` whose names match; none is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    return files.select(F.col("path").alias("file"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def manifest_layout(path: str) -> store.Layout:
    """The stored table of files that have been seen."""
    return store.keyed_layout(path, "file", 8)


def seen_files(spark: SparkSession, manifest: store.Layout) -> DataFrame:
    """What the manifest knows; nothing before the first load."""
    if not store.latest(spark, manifest):
        return spark.createDataFrame([], ENTRY)
    return store.read(spark, manifest)


def unseen(listing: DataFrame, seen: DataFrame) -> DataFrame:
    """Files that are new, or have another size or time than when they were seen."""
    known = ["file", "size", "modified"]
    return listing.join(seen.select(*known), known, "left_anti")


def _look(spark: SparkSession, file: str, size: int, count: int) -> Look:
    path = spark._jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    try:
        head = bytes(stream.readNBytes(BLOCK))
        while head.count(b"\n") < count and len(head) < size:
            head += bytes(stream.readNBytes(len(head)))
        tail = head
        if len(head) < size:
            stream.seek(max(0, size - BLOCK))
            tail = bytes(stream.readNBytes(BLOCK))
    finally:
        stream.close()
    lines = head.decode("utf-8-sig", "replace").splitlines()[:count]
    last = [x for x in tail.decode("utf-8", "replace").splitlines() if x.strip()][-1:]
    return Look(file, tuple(lines), last[0] if last else None)


def look(spark: SparkSession, files: DataFrame, count: int = 1) -> list[Look]:
    """The first ``count`` lines (fewer in a shorter file) and the last line of each of ``files`` (``file, size``)."""
    rows = files.select("file", "size").orderBy("file").collect()
    with ThreadPoolExecutor(AT_ONCE) as pool:
        return list(pool.map(lambda r: _look(spark, r["file"], r["size"], count), rows))


def record(new: DataFrame, looks: list[Look], manifest: store.Layout) -> int:
    """Note the ``new`` files (``file, size, modified``) as seen; the manifest's version."""
    spark = new.sparkSession
    known = spark.createDataFrame([(x.file, list(x.lines), x.last_line) for x in looks], "file string, lines array<string>, last_line string")
    return store.merge(new.join(known, "file").select("file", "size", "modified", "lines", "last_line"), manifest)
