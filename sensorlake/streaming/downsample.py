"""Downsampling and incremental loads as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorlake.functions.flags import qa_predicate
from sensorlake.operators.query import cells_of
from sensorlake.schemas import OBSERVATION
from sensorlake.session import written
from sensorlake.sources import store

AGGREGATES = {"mean": F.avg, "sum": F.sum, "count": F.count, "stddev": F.stddev_samp, "variance": F.var_samp,
              "min": F.min, "max": F.max}


def read_observations(spark: SparkSession, path: str, **options) -> DataFrame:
    """Observation files as they arrive."""
    return spark.readStream.schema(OBSERVATION).options(**options).parquet(path)


def downsample_stream(observations: DataFrame, interval: str, methods: list[str], lateness: str,
                      qa_flag: str = "z", keys: tuple[str, ...] = ("datastream_id",)) -> DataFrame:
    """Tumbling buckets (``"15 minutes"``, ``"1 day"``) of a stream of observations, in UTC.

    The state holds one small aggregate per stream and open bucket and is dropped once the watermark has passed;
    readings later than ``lateness`` are left out in append mode, and the newest reading of any stream moves the watermark of all. Where
    loggers lag behind each other, ``downsample_into`` loses nothing.
    """
    timed = observations.withColumn("event_time", F.timestamp_seconds("utc_time"))
    good = timed.filter(qa_predicate(F.col("qa_flag"), qa_flag)).withWatermark("event_time", lateness)
    grouped = good.groupBy(*keys, F.window("event_time", interval).alias("w"))
    return grouped.agg(*[AGGREGATES[m](F.col("data_value")).alias(m) for m in methods]).select(
        *keys, F.unix_seconds("w.start").alias("bucket_epoch"), *methods)


def append_new(observations: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what has arrived since the last run and stop; the checkpoint is the high-water mark."""
    return (observations.writeStream.outputMode("append").format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def bucket_layout(path: str, buckets: int = 64) -> store.Layout:
    """Downsampled readings by stream bucket and year."""
    return store.Layout(path, {"bucket": f"pmod(xxhash64(datastream_id), {buckets})", "year": "year(timestamp_seconds(bucket_epoch))"},
                        ("datastream_id", "bucket_epoch"), "bucket_epoch", ("datastream_id",))


def downsample_into(observations: DataFrame, readings: store.Layout, buckets: store.Layout, seconds: int, methods: list[str], checkpoint: str,
                    qa_flag: str = "z") -> StreamingQuery:
    """Keep stored ``readings`` and their tumbling ``buckets`` (of ``seconds``, in UTC) up to date with a stream of observations, and stop when
    all that has arrived is in.

    Each batch is loaded against the marks of its own streams: what is newer is appended, what is late is put in place. Then the buckets
    that the batch touches are made anew from the stored readings of their cells and merged into the stored ones. There is no watermark,
    so a logger that lags behind the others, by any time, loses nothing; and a batch that is run again changes nothing. ``n`` counts the
    readings of a bucket, 0 if a change has left none.
    """
    def start(time):
        return time - F.pmod(time, F.lit(seconds))

    def keep(batch: DataFrame, number: int) -> None:
        rows = written(batch, "arrivals")
        touched = written(rows.select("datastream_id", start(F.col("utc_time")).alias("bucket_epoch")).distinct(), "touched")
        span = touched.agg(F.min("bucket_epoch").alias("first"), F.max("bucket_epoch").alias("last")).first()
        if span["first"] is None:
            return
        store.load(rows, readings, "upsert")
        spark = rows.sparkSession
        stored = store.read(spark, readings, where=cells_of(readings, touched.select("datastream_id"), span["first"], span["last"] + seconds))
        good = stored.filter(qa_predicate(F.col("qa_flag"), qa_flag)).withColumn("bucket_epoch", start(F.col("utc_time")))
        made = (good.join(touched, ["datastream_id", "bucket_epoch"], "left_semi").groupBy("datastream_id", "bucket_epoch")
                .agg(F.count("*").alias("n"), *[AGGREGATES[m](F.col("data_value")).alias(m) for m in methods]))
        store.merge(touched.join(made, ["datastream_id", "bucket_epoch"], "left").withColumn("n", F.coalesce("n", F.lit(0))), buckets)

    return observations.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
