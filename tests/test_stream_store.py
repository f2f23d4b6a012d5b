from pyspark.sql import functions as F

from sensorlake.sources import store
from sensorlake.streaming.downsample import bucket_layout, downsample_into, read_observations

OBS = "datastream_id long, utc_time long, data_value double, qa_flag string"


def test_a_lagging_logger_loses_nothing(spark, tmp_path):
    source, state = str(tmp_path / "in"), str(tmp_path / "state")
    layout, buckets = store.observation_layout(str(tmp_path / "readings"), 4), bucket_layout(str(tmp_path / "buckets"), 4)

    def arrive(*rows):
        spark.createDataFrame(rows, OBS).coalesce(1).write.mode("append").parquet(source)
        downsample_into(read_observations(spark, source), layout, buckets, 100, ["sum", "max"], state).awaitTermination()
        return sorted(tuple(r) for r in store.read(spark, buckets).select("datastream_id", "bucket_epoch", "n", "sum", "max").collect())

    live = 10**9
    assert arrive((1, live, 1.0, "z"), (1, live + 1, 5.0, "f"), (2, 5, 2.0, "z")) == [(1, live, 1, 1.0, 1.0), (2, 0, 1, 2.0, 2.0)]
    # Years behind the live one, in an old bucket, in a new one, and once with another value than before.
    assert arrive((2, 7, 3.0, "z"), (2, 105, 4.0, "z"), (1, live, 9.0, "z")) == [(1, live, 1, 9.0, 9.0), (2, 0, 2, 5.0, 3.0), (2, 100, 1, 4.0, 4.0)]
    assert arrive((2, 105, 4.0, "b"))[2] == (2, 100, 0, None, None)
    version = store.latest(spark, buckets)
    assert arrive((2, 7, 3.0, "z")) and store.latest(spark, buckets) == version
    assert store.read(spark, layout).filter(F.col("datastream_id") == 2).count() == 3
