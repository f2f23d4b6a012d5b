import glob
import hashlib
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sensorlake.operators import query as q
from sensorlake.plans.datastream_query import stored_data
from sensorlake.sources import store, versions

OBS = "datastream_id long, utc_time long, data_value double, qa_flag string"
DAY = 86400


def obs(spark, *rows):
    return spark.createDataFrame([(i, t, v, f) for i, t, v, f in rows], OBS)


def files(layout):
    return {f: hashlib.sha256(open(f, "rb").read()).hexdigest() for f in glob.glob(f"{layout.path}/rows/**/*.parquet", recursive=True)}


def rows_of(spark, layout, **options):
    return sorted((tuple(r) for r in store.read(spark, layout, **options).collect()), key=repr)


@pytest.fixture
def layout(tmp_path):
    return store.observation_layout(str(tmp_path / "obs"), 4)


def many(spark, n=3000):
    """Seven streams over four years."""
    return spark.range(n).select((F.col("id") % 7).alias("datastream_id"), (1600000000 + F.col("id") * 40000).alias("utc_time"),
                                 F.col("id").cast("double").alias("data_value"), F.lit("z").alias("qa_flag"))


def test_loads_marks_and_late_rows(spark, layout):
    first = store.load(obs(spark, (1, 100, 1.0, "z"), (1, 200, 2.0, "z"), (2, 50, None, "d"), (None, 7, 1.0, "z"), (3, None, 1.0, "z")), layout)
    assert (first.version, first.rows_read, first.rows_new, first.rows_late, first.rows_without_order) == (1, 5, 4, 0, 1)
    again = obs(spark, (1, 200, 2.0, "z"), (1, 150, 9.0, "z"), (1, 201, 3.0, "z"), (2, 50, 5.0, "f"), (9, 1, 1.0, "z"), (None, 7, 2.0, "z"))
    dropped = store.load(again, layout)
    assert (dropped.version, dropped.rows_new, dropped.rows_late) == (2, 2, 4)
    assert rows_of(spark, layout) == sorted([(1, 100, 1.0, "z"), (1, 200, 2.0, "z"), (1, 201, 3.0, "z"), (2, 50, None, "d"), (9, 1, 1.0, "z"), (None, 7, 1.0, "z")], key=repr)
    # The same again has nothing new: no commit.
    assert store.load(again, layout).version == 2
    merged = store.load(again, layout, "upsert")
    assert (merged.version, merged.rows_new, merged.rows_late) == (3, 0, 6)
    assert rows_of(spark, layout) == sorted([(1, 100, 1.0, "z"), (1, 150, 9.0, "z"), (1, 200, 2.0, "z"), (1, 201, 3.0, "z"), (2, 50, 5.0, "f"), (9, 1, 1.0, "z"), (None, 7, 2.0, "z")], key=repr)
    assert len(rows_of(spark, layout, version=1)) == 4
    marks = {r["datastream_id"]: r["last"] for r in store.marks(spark, layout).collect()}
    assert marks == {1: 201, 2: 50, 9: 1, None: 7}
    assert marks == {r["datastream_id"]: r["last"] for r in store.rebuild_marks(spark, layout).collect()}
    # All of it is stored alike: nothing is rewritten.
    assert store.load(again, layout, "upsert").version == 3
    with pytest.raises(ValueError):
        store.load(again, layout, "keep")


def test_a_load_reads_marks_and_new_rows_only(spark, layout, tmp_path):
    store.load(many(spark), layout)
    path = str(tmp_path / "incoming")
    many(spark, 3100).write.parquet(path)
    marked = store._marked(layout, spark.read.parquet(path), store.marks(spark, layout))
    read = [f.split("/obs/")[-1] for f in marked.inputFiles()]
    assert read and all("/incoming/" in f or f.startswith("_marks/") for f in read)
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert "/rows" not in plan and "BroadcastHashJoin" in plan
    before = files(layout)
    assert store.load(spark.read.parquet(path), layout).rows_new == 100
    after = files(layout)
    assert all(after[f] == before[f] for f in before) and len(after) > len(before)


def test_merge_rewrites_touched_cells_only(spark, layout):
    store.load(many(spark), layout)
    before, stored = files(layout), rows_of(spark, layout)
    target = stored[0]
    changes = obs(spark, (target[0], target[1], -1.0, "b"), (target[0], target[1] + 1, -2.0, "b"))
    assert store.merge(changes, layout) == 2
    assert all(files(layout)[f] == h for f, h in before.items())
    old, new = ({(r["bucket"], r["year"], r["load"]) for r in store._table(spark, layout, "cells", store._state(spark, layout, v)).collect()} for v in (1, 2))
    assert len(old - new) == 1 and len(new - old) == 1 and {c[:2] for c in old - new} == {c[:2] for c in new - old}
    assert rows_of(spark, layout) == sorted([*stored[1:], (target[0], target[1], -1.0, "b"), (target[0], target[1] + 1, -2.0, "b")], key=repr)
    assert rows_of(spark, layout, version=1) == stored
    assert store.merge(changes, layout) == 2
    with pytest.raises(PySparkException, match="more than one row"):
        store.merge(changes.union(changes.withColumn("data_value", F.lit(0.0))), layout)
    assert store.merge(changes.union(changes.withColumn("data_value", F.lit(-5.0))), layout, "greatest") == 2


def test_the_later_of_two_writers_starts_again(spark, layout, monkeypatch):
    store.load(obs(spark, (1, 100, 1.0, "z")), layout)
    seen, state = [], store._state

    def slow(*args):
        found = state(*args)
        if not seen:
            seen.append(1)
            store.load(obs(spark, (1, 150, 2.0, "z"), (2, 10, 1.0, "z")), layout)
        return found

    monkeypatch.setattr(store, "_state", slow)
    done = store.load(obs(spark, (1, 150, 7.0, "z"), (1, 160, 3.0, "z")), layout)
    assert (done.version, done.rows_new, done.rows_late) == (3, 1, 1)
    assert rows_of(spark, layout) == [(1, 100, 1.0, "z"), (1, 150, 2.0, "z"), (1, 160, 3.0, "z"), (2, 10, 1.0, "z")]
    monkeypatch.setattr(store, "claim", lambda *a: False)
    with pytest.raises(store.Conflict):
        store.load(obs(spark, (5, 1, 1.0, "z")), layout)
    # What the beaten writer has left is not read.
    assert len(rows_of(spark, layout)) == 4


def test_versions_of_two_writers(spark, tmp_path, monkeypatch):
    path, latest = str(tmp_path / "t"), versions.latest
    assert versions.write(spark.range(1), path) == 1
    monkeypatch.setattr(versions, "latest", lambda s, p: max(0, latest(s, p) - (1 if len(os.listdir(f"{p}/_versions")) % 4 == 2 else 0)))
    assert versions.claim(spark, f"{path}/_versions/x", "") and not versions.claim(spark, f"{path}/_versions/x", "")
    monkeypatch.setattr(versions, "latest", latest)
    assert versions.write(spark.range(2), path) == 2
    assert versions.read(spark, path).count() == 2 and versions.read(spark, path, 1).count() == 1
    with pytest.raises(ValueError):
        versions.read(spark, path, 7)


def test_pruned_reads(spark, layout):
    store.load(many(spark), layout)
    registry = spark.range(7).select(F.col("id").alias("datastream_id"), F.concat(F.lit("s"), F.col("id").cast("string")).alias("datastream_tablename"))
    df = stored_data(spark, layout, registry, {"datastream_tablename": "s3"}, tz="America/Denver", start_date="2021-12-30", end_date="2022-01-05")
    expected = [(r["datastream_id"], r["data_value"]) for r in many(spark).filter(
        "datastream_id = 3 AND timestamp_seconds(utc_time) >= '2021-12-30 07:00:00' AND timestamp_seconds(utc_time) < '2022-01-06 07:00:00'").collect()]
    assert sorted((r["datastream_id"], r["data_value"]) for r in df.collect()) == sorted(expected) and expected
    cells = {f.split("/obs/rows/")[1].split("/", 1)[1].rsplit("/", 1)[0] for f in df.inputFiles()}
    bucket = spark.range(1).select(F.pmod(F.xxhash64(F.lit(3).cast("long")), F.lit(4))).first()[0]
    assert cells == {f"bucket={bucket}/year=2021", f"bucket={bucket}/year=2022"}
    plan = df._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "bucket" in filters and "year" in filters and "PushedFilters" in plan
    with pytest.raises(LookupError):
        stored_data(spark, layout, registry, {"datastream_tablename": "nobody"})
    everything = stored_data(spark, layout, registry, {})
    assert everything.count() == 3000
    nothing = stored_data(spark, layout, registry, {"datastream_tablename": "s3"}, start_date="1980-01-01", end_date="1981-01-01")
    assert nothing.count() == 0 and nothing.columns == ["datastream_id", "datetime_local", "data_value", "qa_flag"]


def test_epoch_bounds_enclose_every_zone():
    assert q.epoch_bounds() == (None, None)
    assert q.epoch_bounds(start_date="1970-01-02", end_datetime="1970-01-02 00:00:00") == (0, 2 * DAY + 1)


def test_raw_tables_take_new_columns(spark, tmp_path):
    layout = store.feeder_layout(str(tmp_path / "feeder"))
    rows = spark.sql("SELECT * FROM VALUES (TIMESTAMP_NTZ '2023-12-31 23:00:00', 1D), (TIMESTAMP_NTZ '2024-01-01 00:00:00', 2D) AS v(timestamp, x)")
    assert store.load(rows, layout).rows_new == 2
    wider = spark.sql("SELECT * FROM VALUES ('a', TIMESTAMP_NTZ '2024-01-01 00:00:00'), ('b', TIMESTAMP_NTZ '2024-01-02 00:00:00'), ('c', NULL) AS v(y, timestamp)")
    done = store.load(wider, layout)
    assert (done.rows_new, done.rows_late, done.rows_without_order) == (1, 1, 1)
    got = store.read(spark, layout).orderBy("timestamp").collect()
    assert [tuple(r)[1:] for r in got] == [(1.0, None), (2.0, None), (None, "b")]
    # A late row brings the new column and keeps what it does not carry.
    assert store.load(wider.filter("y = 'a'"), layout, "upsert").version == 3
    assert [tuple(r)[1:] for r in store.read(spark, layout).orderBy("timestamp").collect()] == [(1.0, None), (2.0, "a"), (None, "b")]
    assert [r["last"].isoformat() for r in store.marks(spark, layout).collect()] == ["2024-01-02T00:00:00"]


def test_compaction_and_empty_loads(spark, layout):
    assert store.latest(spark, layout) == 0 and store.compact(spark, layout) == 0
    with pytest.raises(ValueError):
        store.read(spark, layout)
    assert store.load(obs(spark), layout).version == 1 and rows_of(spark, layout) == []
    for k in range(3):
        store.load(obs(spark, (1, 100 + k, 1.0, "z"), (2, 40 * 365 * DAY + k, 1.0, "z")), layout)
    before = rows_of(spark, layout)
    assert store.compact(spark, layout) == 5 and store.compact(spark, layout) == 5
    assert rows_of(spark, layout) == before and len(before) == 6
    assert store._table(spark, layout, "cells", store._state(spark, layout)).count() == 2
    assert store.load(obs(spark, (1, 102, 1.0, "z"), (1, 103, 1.0, "z")), layout).rows_late == 1
