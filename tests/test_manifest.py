import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sensorlake.operators import trees
from sensorlake.plans.stages import ingest_files
from sensorlake.sources import manifest, readers, store


def put(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8", newline="")
    return path


def names(files):
    return sorted(f.rsplit("/", 1)[-1] for f in files)


def test_ends_of_files(spark, tmp_path, monkeypatch):
    put(tmp_path, "a.csv", "﻿x,y\r\n1,2\r\n\r\n")
    put(tmp_path, "sub dir/b.CSV", "x,é\n" + "1,2\n" * 50 + "last,line")
    put(tmp_path, "c.csv", "")
    put(tmp_path, "d.csv", "only a header")
    put(tmp_path, "e.txt", "x\n")
    listing = manifest.list_files(spark, str(tmp_path), readers.CSV_GLOB)
    assert "content" not in listing._jdf.queryExecution().executedPlan().toString()
    for block in (1 << 16, 3, 16):
        monkeypatch.setattr(manifest, "BLOCK", block)
        looks = {x.file.rsplit("/", 1)[-1]: x for x in manifest.look(spark, listing)}
        # Spark lists no file without bytes.
        assert names(looks) == ["a.csv", "b.CSV", "d.csv"]
        assert looks["a.csv"].lines == ("x,y",) and looks["b.CSV"].lines == ("x,é",)
        if block > 10:
            assert looks["d.csv"].lines == ("only a header",) and looks["b.CSV"].last_line == "last,line" and looks["a.csv"].last_line == "1,2"


def test_only_new_and_changed_files(spark, tmp_path):
    seen = manifest.manifest_layout(str(tmp_path / "seen"))
    path = str(tmp_path / "files")
    put(tmp_path, "files/a.csv", "x\n1\n")
    put(tmp_path, "files/b.csv", "x\n1\n")

    def step():
        new = manifest.unseen(manifest.list_files(spark, path, "*.csv"), manifest.seen_files(spark, seen))
        looks = manifest.look(spark, new)
        if looks:
            manifest.record(new, looks, seen)
        return names(x.file for x in looks)

    assert step() == ["a.csv", "b.csv"] and step() == []
    put(tmp_path, "files/b.csv", "x\n1\n2\n")
    put(tmp_path, "files/c.csv", "x\n1\n")
    assert step() == ["b.csv", "c.csv"] and step() == []
    known = {r["file"].rsplit("/", 1)[-1]: r for r in manifest.seen_files(spark, seen).collect()}
    assert set(known) == {"a.csv", "b.csv", "c.csv"} and known["b.csv"]["size"] == 6 and known["b.csv"]["last_line"] == "2"


def test_files_are_read_by_their_first_line(spark, tmp_path):
    put(tmp_path, "a.csv", "datetime,note\n2024-01-01 00:00:00,datetime\n2024-01-02 00:00:00,5\n")
    put(tmp_path, "b.csv", "when,datetimes\n2024-01-01 00:00:00,datetime\ndatetime,1\n")
    put(tmp_path, "c.csv", "\n")
    with pytest.raises(readers.MissingTime, match="b.csv") as found:
        readers.read_csv_source(spark, str(tmp_path))
    assert names(found.value.files) == ["b.csv", "c.csv"]
    rows = readers.read_csv_source(spark, str(tmp_path), missing="skip", ordered=True).collect()
    assert [(r.timestamp.day, r.note) for r in rows] == [(1, None), (2, 5.0)]
    left = {r["file"].rsplit("/", 1)[-1]: r["columns"] for r in readers.files_without_time(spark, str(tmp_path)).collect()}
    assert left == {"b.csv": ["when", "datetimes"], "c.csv": []}
    with pytest.raises(ValueError):
        readers.read_csv_source(spark, str(tmp_path), missing="ignore")


HEAD = '"TOA5","st","CR1000"\n"TIMESTAMP","RECORD","Temp_C"\n"TS","RN","Deg C"\n"","","Avg"\n'


def test_logger_rows_without_a_time_are_errors(spark, tmp_path):
    put(tmp_path, "a.dat", HEAD + '"2024-01-01 00:00:00",1,2.5\n\n"2024-01-01 00:15:00",2,3.5\n')
    rows = readers.read_logger_dat(spark, str(tmp_path), ordered=True).collect()
    assert [(r.record, r.temp_c) for r in rows] == [(1.0, 2.5), (2.0, 3.5)]
    put(tmp_path, "b.dat", HEAD + '"2024-01-01 00:00:00",1,2.5\n"yesterday",2,3.5\n')
    with pytest.raises(PySparkException, match="no time in b.dat: yesterday"):
        readers.read_logger_dat(spark, str(tmp_path)).collect()
    put(tmp_path, "b.dat", "no logger file\n")
    with pytest.raises(readers.MissingTime):
        readers.read_logger_dat(spark, str(tmp_path))


def test_the_second_line_has_to_hold_units(spark, tmp_path):
    put(tmp_path, "g.csv", "ph,datetime,flow\nph,timestamp\n1,2024-01-01 00:00:00,timestamp\n")
    samples, units = readers.read_two_row_header(spark, str(tmp_path))
    assert samples.collect() == [(dt.datetime(2024, 1, 1), "1", "timestamp")]
    assert sorted((r[0], r[1] or "") for r in units.collect()) == [("flow", ""), ("ph", "ph")]
    put(tmp_path, "g.csv", "ph,datetime,flow\n1,2024-01-01 00:00:00,2\n")
    with pytest.raises(ValueError, match="no units"):
        readers.read_two_row_header(spark, str(tmp_path))


def test_last_times_and_pruning(spark, tmp_path):
    put(tmp_path, "s/a.csv", "x,datetime\n1,2024-01-01 00:00:00\n1,2024-01-03 00:00:00\n")
    put(tmp_path, "s/b.csv", "datetime,x\n2024-01-05 00:00:00,1\n")
    put(tmp_path, "s/c.csv", "datetime,x\n")
    looks = manifest.look(spark, manifest.list_files(spark, str(tmp_path), "*.csv"))
    ends = readers.last_times(spark, looks, "datetime").withColumn("source", F.lit("s"))
    assert sorted((names([r["file"]])[0], r["last_time"]) for r in ends.collect() if r["last_time"]) == [("a.csv", dt.datetime(2024, 1, 3)), ("b.csv", dt.datetime(2024, 1, 5))]
    water = spark.sql("SELECT 's' AS source, TIMESTAMP_NTZ '2024-01-03 00:00:00' AS stored_time")
    assert names(r["file"] for r in readers.prune_files(ends, water).collect()) == ["b.csv", "c.csv"]


def test_loads_from_a_growing_folder(spark, tmp_path):
    table, seen, path = store.feeder_layout(str(tmp_path / "table")), manifest.manifest_layout(str(tmp_path / "seen")), str(tmp_path / "in")
    put(tmp_path, "in/a.csv", "datetime,x\n2024-01-01 00:00:00,1\n2024-01-02 00:00:00,2\n2024-01-02 00:00:00,3\n")
    put(tmp_path, "in/odd.csv", "when,x\n2024-01-01 00:00:00,1\n")
    first = ingest_files(spark, path, table, seen)
    assert (first.listed, first.new, first.stale, first.without_time, first.rows.rows_new) == (2, 2, 0, 1, 2)
    assert ingest_files(spark, path, table, seen).new == 0
    put(tmp_path, "in/a.csv", "datetime,x\n2024-01-01 00:00:00,1\n2024-01-02 00:00:00,2\n2024-01-02 00:00:00,3\n2024-01-04 00:00:00,4\n")
    put(tmp_path, "in/b.csv", "y,datetime\n9,2024-01-01 12:00:00\n")
    then = ingest_files(spark, path, table, seen)
    assert (then.new, then.stale, then.rows.rows_new, then.rows.rows_late) == (2, 1, 1, 2)
    put(tmp_path, "in/b2.csv", "y,datetime\n9,2024-01-01 12:00:00\n")
    late = ingest_files(spark, path, table, seen, late="upsert")
    assert (late.new, late.stale, late.rows.rows_late) == (1, 0, 1)
    rows = store.read(spark, table).orderBy("timestamp").collect()
    assert [(r.timestamp.day, r.timestamp.hour, r.x, r.y) for r in rows] == [(1, 0, 1.0, None), (1, 12, None, 9.0), (2, 0, 2.0, None), (4, 0, 4.0, None)]


def site(code, *children, **more):
    return {"sampling_feature_code": code, "sampling_feature_uuid": f"u-{code}", "relation_to_parent": "isChildOf", "child_sampling_features": list(children), **more}


def test_documents_of_any_depth(spark):
    chain = site("d39", related_features=[{"relation_to_related_feature": "isNear", "related_feature_id": 7}])
    for k in range(38, -1, -1):
        chain = site(f"d{k}", chain, *([site(f"e{k}")] if k % 10 == 0 else []))
    df = spark.createDataFrame([(json.dumps(chain),), (json.dumps(site("alone")),)], "body string")
    rows = trees.explode_documents(df, "body", "sampling_feature_code:string", "child_sampling_features", "sampling_feature_code", levels=11)
    got = {r["sampling_feature_code"]: (r["depth"], r["parent_key"]) for r in rows.collect()}
    assert got == {"alone": (0, None), **{f"d{k}": (k, f"d{k - 1}" if k else None) for k in range(40)}, **{f"e{k}": (k + 1, f"d{k}") for k in range(0, 39, 10)}}
    out = trees.flatten_feature_tree(df, "body")
    assert out["nodes"].count() == 45 and out["edges"].count() == 43
    assert out["related"].collect() == [("d39", "isNear", 7)]


def test_a_limit_on_the_depth_is_an_error_beyond_it(spark):
    df = spark.createDataFrame([(json.dumps(site("a", site("b", site("c", site("d", site("e", site("f"))))))),)], "body string")
    fields = "sampling_feature_code:string"
    with pytest.raises(ValueError, match="deeper than 4"):
        trees.explode_documents(df, "body", fields, "child_sampling_features", "sampling_feature_code", max_depth=4)
    assert trees.explode_documents(df, "body", fields, "child_sampling_features", "sampling_feature_code", max_depth=5).count() == 6


def test_equipment_owners_and_purchase(spark):
    item = {"equipment_uuid": "u", "equipment_code": "p", "equipment_owner_first_name": "A", "equipment_owner_last_name": "B", "equipment_owner_role": "keeper",
            "equipment_purchase_date": "2020-01-01", "equipment_purchase_order_number": "7", "equipment_documentation_link": "doc", "position_start_date_utc": 1}
    df = spark.createDataFrame([(json.dumps(item | {"equipment_vendor": v, "equipment_uuid": f"u{k}"}),) for k, v in enumerate(("org", "nobody", None))], "body string")
    models = spark.sql("SELECT 3L AS equipment_model_id, 'p' AS equipment_model_part_number")
    orgs = spark.sql("SELECT * FROM VALUES (1L, 'org'), (2L, 'unknown') AS v(organization_id, organization_code)")
    persons = spark.sql("SELECT 5L AS person_id, 'A' AS person_first_name, 'B' AS person_last_name")
    out = trees.flatten_equipment_tree(df, "body", models, orgs, persons)
    assert sorted((r.equipment_uuid, r.equipment_vendor_id, r.equipment_purchase_order_number) for r in out["equipment"].collect()) == [("u0", 1, "7"), ("u1", 2, "7"), ("u2", 2, "7")]
    assert {(r.person_id, r.person_role_cv) for r in out["owners"].collect()} == {(5, "keeper")} and out["owners"].count() == 3


def test_equipment_rows_know_their_parent(spark):
    """Vendors and owners are broadcast, and nothing but the model is looked up by shuffle; edges say the same as the rows."""
    logger = {"equipment_uuid": "l", "equipment_code": "p", "equipment_vendor": "org", "position_start_date_utc": 1,
              "equipment": [{"equipment_uuid": "s", "equipment_code": "p", "equipment_owner_first_name": "A", "equipment_owner_last_name": "B"}]}
    df = spark.createDataFrame([(json.dumps(logger),), (json.dumps(logger | {"equipment_uuid": "m", "equipment": []}),)], "body string")
    models = spark.createDataFrame([(3, "p")], "equipment_model_id long, equipment_model_part_number string")
    orgs = spark.createDataFrame([(1, "org"), (2, "unknown")], "organization_id long, organization_code string")
    persons = spark.createDataFrame([(5, "A", "B")], "person_id long, person_first_name string, person_last_name string")
    out = trees.flatten_equipment_tree(df, "body", models, orgs, persons)
    rows = out["attached"].select("equipment_uuid", "equipment_model_id", "equipment_vendor_id", "equipment_owner_id", "parent_uuid")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 2 and plan.count("SortMergeJoin") <= 1
    assert sorted(map(tuple, rows.collect()), key=repr) == [("l", 3, 1, None, None), ("m", 3, 1, None, None), ("s", 3, 2, 5, "l")]
    ids = {r.equipment_id: r.equipment_uuid for r in out["equipment"].collect()}
    assert [(ids[r.equipment_id], ids[r.related_equipment_id]) for r in out["edges"].collect()] == [("s", "l")]


def test_what_is_written_on_the_way_is_compressed(spark):
    """Documents as files, and the nodes they become, are no larger than they have to be."""
    from sensorlake.session import written
    from suite.metadata import _as_files
    from suite.registry import Tables

    files = _as_files(Tables(spark, ""), spark.range(3).select(F.col("id").cast("string").alias("value")))
    assert all(f.endswith(".gz") for f in files.inputFiles()) and sorted(r.body for r in files.collect()) == ["0", "1", "2"]
    assert all(f.endswith(".zstd.parquet") for f in written(spark.range(3), "nodes").inputFiles())
