"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def require_utc(spark: SparkSession) -> SparkSession:
    """Fix the session time zone to UTC; every time rule of the library assumes it."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may go without: it gets a fresh temporary folder. On a cluster that would be a folder of the
    driver's machine, so a missing setting is an error there.
    """
    configured = spark.conf.get(CHECKPOINT_SETTING, None)
    if not configured:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"{CHECKPOINT_SETTING} has to name a folder that all executors of {master} share")
        configured = tempfile.mkdtemp(prefix="sensorlake-")
        spark.conf.set(CHECKPOINT_SETTING, configured)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; never reused, so a retried job cannot meet old files."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def durable(df):
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df, name: str):
    """Write a frame that several outputs read to a parquet table in the shared folder, and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


# Largest table, in rows of a few numbers each, that is sent to every executor.
BROADCAST_ROWS = 1_000_000


def small_side(df, max_rows: int = BROADCAST_ROWS):
    """Prepare a derived per-stream table as join side: compute it once, count it, and broadcast it only when it has
    at most ``max_rows`` rows. A larger one joins by shuffle, where adaptive execution splits hot keys.

    Tables read from files need no such help: the optimizer knows their size.
    """
    stable = durable(df)
    return F.broadcast(stable) if stable.count() <= max_rows else stable
