import datetime as dt
import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sensorlake.functions.numbers import coerce_numeric, is_number
from sensorlake.operators import shaping
from sensorlake.sources import mappers, readers, sinks, versions, waterml


def put(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_csv_files_with_different_headers(spark, tmp_path):
    put(tmp_path, "a.csv", "datetime,Air Temp [°C],note\n2024-01-01 00:00:00,1.5,x\n2024-01-01 01:00:00,,y\n")
    put(tmp_path, "sub/b.CSV", "note,datetime\n3,2024-01-02 00:00:00\n3,2024-01-02 00:00:00\n")
    put(tmp_path, "c.txt", "datetime,ignored\n2024-01-01 00:00:00,1\n")
    out = readers.read_csv_source(spark, str(tmp_path), ordered=True)
    assert out.columns == ["timestamp", "air_temp_[degc]", "note"]
    rows = out.collect()
    assert len(rows) == 3 and rows[0][1] == 1.5 and math.isnan(rows[1][1]) and rows[0].note is None and rows[2].note == 3.0


def test_csv_needs_the_time_column(spark, tmp_path):
    put(tmp_path, "a.csv", "when,x\n2024-01-01 00:00:00,1\n")
    with pytest.raises(ValueError):
        readers.read_csv_source(spark, str(tmp_path))
    put(tmp_path, "a.csv", "datetime,x\nyesterday,1\n")
    with pytest.raises(PySparkException):
        readers.read_csv_source(spark, str(tmp_path)).collect()


def test_logger_files(spark, tmp_path):
    head = '"TOA5","st","CR1000"\n"TIMESTAMP","RECORD","Temp_C"\n"TS","RN","Deg C"\n"","","Avg"\n'
    put(tmp_path, "one.dat", head + '"2024-01-01 00:00:00",1,"NAN"\n"2024-01-01 00:15:00",2,3.5\n')
    put(tmp_path, "two.dat", head + '"2024-01-01 00:15:00",2,3.5\n"2024-01-01 00:30:00",3,Null\n')
    rows = readers.read_logger_dat(spark, str(tmp_path), ordered=True).collect()
    assert [r.record for r in rows] == [1.0, 2.0, 3.0]
    assert math.isnan(rows[0].temp_c) and rows[1].temp_c == 3.5 and math.isnan(rows[2].temp_c)
    assert {r.source_file for r in rows} <= {"one.dat", "two.dat"}


def test_stale_files_are_skipped(spark):
    manifest = spark.createDataFrame([("s", "a", 5), ("s", "b", 9), ("t", "c", 1)], "source string, file string, last_time long")
    water = spark.createDataFrame([("s", 5)], "source string, stored_time long")
    assert sorted(r.file for r in readers.prune_files(manifest, water).collect()) == ["b", "c"]


def test_split_header_and_bad_epoch(spark, tmp_path):
    header = "time_epoch[s],wind,precipitation_type<none,rain,hail,snow>,battery"
    assert readers.repair_split_header(header.split(","), "precipitation_type", 4) == ["time_epoch[s]", "wind", "precipitation_type<none,rain,hail,snow>", "battery"]
    put(tmp_path, "w.csv", header + "\n1704067200,1.5,0,2.6\n1704067200,1.5,0,2.6\n")
    rows = readers.read_epoch_csv(spark, str(tmp_path), "time_epoch[s]", "precipitation_type", 4).collect()
    assert len(rows) == 1 and rows[0].timestamp == dt.datetime(2024, 1, 1) and rows[0].battery == 2.6
    put(tmp_path, "w.csv", header + "\n99999999999999,1.5,0,2.6\n")
    with pytest.raises(PySparkException):
        readers.read_epoch_csv(spark, str(tmp_path), "time_epoch[s]", "precipitation_type", 4).collect()


def test_two_row_header(spark, tmp_path):
    put(tmp_path, "g.csv", "ph,datetime,flow\nph,timestamp,cfs\n< 0.02,2024-01-01 00:00:00,nan\n")
    samples, units = readers.read_two_row_header(spark, str(tmp_path))
    assert samples.collect() == [(dt.datetime(2024, 1, 1), "< 0.02", "nan")]
    assert sorted(tuple(r) for r in units.collect()) == [("flow", "cfs"), ("ph", "ph")]


def test_units_do_not_shuffle_the_samples(spark, tmp_path):
    put(tmp_path, "g.csv", "ph,datetime,flow\nph,timestamp,cfs\n< 0.02,2024-01-01 00:00:00,nan\n")
    samples, units = readers.read_two_row_header(spark, str(tmp_path))
    joined = samples.unpivot(["timestamp"], ["flow", "ph"], "column_name", "cell").join(units, "column_name")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert sorted((r.column_name, r.cell, r.units_term) for r in joined.collect()) == [("flow", "nan", "cfs"), ("ph", "< 0.02", "ph")]


def test_payload(spark):
    body = '{"parameters":[{"parameterId":"1","unitId":"1","readings":[{"timestamp":5,"value":1.5},{"timestamp":6,"value":2.5}]},' \
           '{"parameterId":"17","unitId":"145","readings":[{"timestamp":6,"value":7.0}]},{"parameterId":"999","unitId":"1","readings":[{"timestamp":9,"value":1}]}]}'
    payloads = spark.createDataFrame([("d", body)], "device string, body string")
    def flatten(payloads):
        return readers.flatten_payload(
            payloads, "body", ["device"], mappers.table(spark, mappers.HYDROVU_PARAMETERS_COLUMNS, mappers.HYDROVU_PARAMETERS),
            mappers.table(spark, mappers.HYDROVU_UNITS_COLUMNS, mappers.HYDROVU_UNITS), ["Temperature[C]", "pH[pH]", "Depth[m]"])

    with pytest.raises(Exception, match="unknown parameterId 999"):
        flatten(payloads).collect()
    wide = flatten(spark.createDataFrame([("d", body.replace('"999"', '"17"').replace('"timestamp":9,"value":1', '"timestamp":6,"value":7.0'))], "device string, body string"))
    assert sorted(tuple(r) for r in wide.collect()) == [("d", 5, 1.5, None, None), ("d", 6, 2.5, 7.0, None)]


def test_coerce_numeric(spark):
    texts = ["1.5", " 2 ", "", "NA", "Null", None, "5d", "0x1p3", "ice", "1e3", "-inf", "NaN", ".5", "5.", "1_0"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(coerce_numeric(F.col("t"))).collect()]
    assert ["nan" if v is not None and math.isnan(v) else v for v in got] == [
        1.5, 2.0, "nan", "nan", "nan", "nan", None, None, None, 1000.0, float("-inf"), "nan", 0.5, 5.0, None]
    assert df.filter(is_number(F.col("t"))).count() == 7


def test_append_is_idempotent_and_counts(spark, values):
    new = spark.sql("SELECT * FROM VALUES (1D, TIMESTAMP_NTZ '2024-01-01'), (2D, TIMESTAMP_NTZ '2024-01-02'), (3D, NULL) AS v(x, timestamp)")
    first, stats = shaping.append_feeder(None, new)
    assert first.columns == ["timestamp", "x"] and first.count() == 2 and tuple(stats.first()) == (3, 1, 0)
    again, stats = shaping.append_feeder(first, new)
    assert again.count() == 0 and tuple(stats.first()) == (3, 1, 2)
    wider, _ = shaping.append_feeder(first.withColumn("old", F.lit(1)), new.withColumn("y", F.lit(1)))
    assert wider.columns == ["timestamp", "x", "y", "old"]
    empty, _ = shaping.append_feeder(first.limit(0), new)
    assert empty.count() == 2


def test_header_policies(spark):
    old, new = spark.createDataFrame([(1, 2)], "a int, b int"), spark.createDataFrame([(1, 2)], "b int, c int")
    assert shaping.reconcile_append(old, new).columns == ["a", "b", "c"]
    for options in ({"ignore_missing": False}, {"update_added": False}):
        with pytest.raises(shaping.HeaderError):
            shaping.reconcile_append(old, new, **options)
    with pytest.raises(shaping.HeaderError):
        shaping.reconcile_append(old, new.select("c"))


def test_copy_incremental(spark):
    src = spark.createDataFrame([(1, "a", "n"), (2, "b", "n")], "id long, x string, extra string")
    dst = spark.createDataFrame([(1, "a", "k")], "id long, x string, y string")
    assert shaping.copy_incremental(src, dst, "id").collect() == [(2, "b", None)]
    assert shaping.copy_incremental(src, dst.limit(0), "id").count() == 2
    assert shaping.copy_incremental(src, None, "id").columns == ["id", "x", "extra"]
    with pytest.raises(ValueError):
        shaping.copy_incremental(src, dst.select("y"), "id")
    with pytest.raises(ValueError):
        shaping.copy_incremental(src, dst, "id", "key")


def test_pruning_reports_skipped():
    kept, skipped = shaping.prune_columns(["datetime", "00010", "00010_cd", "00060_discontinued", "x"], {"00010": "temperature", "00060_discontinued": "q"}, ["datetime"])
    assert kept == {"datetime": "datetime", "00010": "temperature"} and skipped == ["00010_cd", "00060_discontinued", "x"]


def test_outputs(spark, tmp_path):
    df = spark.sql("SELECT 1 AS a, 'say \"hi\",\\nthere' AS b, CAST(NULL AS DOUBLE) AS c, TIMESTAMP_NTZ '2024-01-01 00:00:00' AS d")
    sinks.write_csv(df, str(tmp_path / "csv"))
    back = spark.read.option("header", "true").option("multiLine", "true").option("escape", "\\").csv(str(tmp_path / "csv")).first()
    assert back.b == 'say "hi",\nthere' and back.d == "2024-01-01 00:00:00"
    assert sinks.json_rows(df).first().json.startswith('{"a":1,"b":"say \\"hi\\",\\nthere","c":null')
    assert sinks.json_arrays(df).first().json == '[1,"say \\"hi\\",\\nthere",null,"2024-01-01 00:00:00"]'
    header = sinks.write_json_table(df, str(tmp_path / "table"), limit=5)
    assert tuple(header.first()) == (["a", "b", "c", "d"], 1, 5, 0)


def test_snapshot_leaves_out_empty_tables(spark, tmp_path):
    tables = {"full": spark.range(3), "empty": spark.range(0), "secret": spark.range(1)}
    assert sinks.snapshot(tables, str(tmp_path / "s"), exclude=["secret"]) == ["full"]
    assert sinks.snapshot(tables, str(tmp_path / "t"), include=["secret"]) == ["secret"]


def test_versions(spark, tmp_path):
    path = str(tmp_path / "map")
    assert not versions.exists(spark, path)
    df = spark.range(3)
    assert sinks.write_if_changed(df, path) and not sinks.write_if_changed(df, path)
    assert sinks.write_if_changed(df.union(spark.range(1)), path)
    assert versions.latest(spark, path) == 2 and versions.read(spark, path, 1).count() == 3 and versions.read(spark, path).count() == 4


def test_observation_layout_is_pruned(spark, tmp_path, capsys):
    path = str(tmp_path / "obs")
    df = spark.range(2000).select((F.col("id") % 7).alias("datastream_id"), (1600000000 + F.col("id") * 40000).alias("utc_time"),
                                  F.col("id").cast("double").alias("data_value"), F.lit("z").alias("qa_flag"))
    versions.write_observations(df, path, buckets=4)
    back = spark.read.parquet(path)
    assert back.count() == 2000
    back.filter("year = 2021").select("data_value").explain("formatted")
    assert "PartitionFilters" in capsys.readouterr().out


SERIES = """<timeSeries xmlns="http://www.cuahsi.org/waterML/1.1/"><sourceInfo><siteName>A</siteName><siteCode network="N">1</siteCode></sourceInfo>
<variable><variableCode vocabulary="V">Q</variableCode><variableName>flow</variableName><options><option name="Statistic" optionCode="00003">Mean</option></options></variable>
<values><value dateTime="2024-01-01T00:00:00.700" qualifiers="P">1.5</value><method methodID="11"/><qualifier qualifierID="0"><qualifierCode>P</qualifierCode></qualifier></values>
<values><value dateTime="2024-01-01T00:00:00">2.5</value><method methodID="12"/></values></timeSeries>"""


def test_waterml_methods(spark):
    docs = spark.createDataFrame([(1, SERIES)], "k int, xml string")
    series = waterml.parse_xml(docs, "xml", "timeSeries", waterml.TIME_SERIES, ["k"])
    with pytest.raises(PySparkException):
        waterml.values(series).collect()
    both = {r.variable_code: r for r in waterml.values(series, "all").collect()}
    assert set(both) == {"Q:00003:11", "Q:00003:12"}
    assert both["Q:00003:11"].timestamp == dt.datetime(2024, 1, 1) and both["Q:00003:11"].qualifiers == "P"
    assert [r.value for r in waterml.values(series, "12").collect()] == [2.5]
    assert [r.qualifierCode for r in waterml.side_table(series, "qualifier").collect()] == ["P"]
    assert {r._methodID for r in waterml.side_table(series, "method").collect()} == {"11", "12"}
