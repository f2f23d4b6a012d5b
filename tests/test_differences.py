import json

from pyspark.sql import functions as F

from sensorlake.operators import checks, trees


def test_fields_in_which_repeated_records_differ(spark):
    nodes = spark.createDataFrame([("a", "u1", 1.0, "x"), ("a", "u2", 1.0, None), ("b", "u3", 2.0, "x"), ("b", "u3", 2.0, "x"), ("c", "u3", None, "x"), (None, "u9", 1.0, "x"), (None, "u8", 2.0, "y")],
                                  "sampling_feature_code string, sampling_feature_uuid string, elevation_m double, kind string")
    out = sorted((tuple(r) for r in trees.duplicate_fields(nodes).collect()), key=repr)
    assert out == sorted([
        ("sampling_feature_code", "a", "sampling_feature_uuid", "u1", 1), ("sampling_feature_code", "a", "sampling_feature_uuid", "u2", 1),
        ("sampling_feature_code", "a", "kind", "x", 1), ("sampling_feature_code", "a", "kind", None, 1),
        ("sampling_feature_uuid", "u3", "sampling_feature_code", "b", 2), ("sampling_feature_uuid", "u3", "sampling_feature_code", "c", 1),
        ("sampling_feature_uuid", "u3", "elevation_m", "2.0", 2), ("sampling_feature_uuid", "u3", "elevation_m", None, 1)], key=repr)
    assert trees.duplicate_fields(nodes.limit(0)).count() == 0


def test_a_record_travels_once_for_each_key(spark, monkeypatch):
    nodes = spark.range(4000).select(F.when(F.col("id") % 4 == 0, "hot").otherwise((F.col("id") % 1000).cast("string")).alias("sampling_feature_code"),
                                     F.col("id").cast("string").alias("sampling_feature_uuid"), (F.col("id") % 3).cast("double").alias("elevation_m"))
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    out = trees.duplicate_fields(nodes)
    assert plan(out).count("Exchange hashpartitioning") == 2 and "Join" not in plan(out)
    plain = sorted(map(tuple, out.collect()), key=repr)
    assert ("sampling_feature_code", "hot", "elevation_m", "0.0", 334) in plain
    monkeypatch.setattr(trees, "HOT", 100)
    assert "Join" in plan(trees.duplicate_fields(nodes))
    assert sorted(map(tuple, trees.duplicate_fields(nodes).collect()), key=repr) == plain


def test_registries_are_compared_by_terms(spark):
    old = spark.createDataFrame([("a_wvc_1", 1, 5), ("b", 2, 5), ("c", None, 5), ("d", 9, 5)], "datastream_tablename string, variable_id long, n long")
    new = spark.createDataFrame([("a_wvc(1", 71, 5), ("b", 71, 6), ("c", 72, 5)], "datastream_tablename string, variable_id long, n long")
    terms = spark.createDataFrame([(1, "flow"), (2, "level")], "id long, term string")
    shifted = terms.select((F.col("id") + 70).alias("id"), "term")
    out = checks.registry_differences(old, new, {"wvc_": "wvc("}, ["variable_id", "n"], {"variable_id": (terms, "id", "term")}, {"variable_id": (shifted, "id", "term")})
    assert sorted((tuple(r) for r in out.collect()), key=repr) == sorted([
        ("b", "variable_id", "level", "flow"), ("b", "n", "5", "6"), ("c", "variable_id", None, "level"), ("d", "datastream_tablename", "d", None)], key=repr)
    assert [r.variable_id for r in checks.with_terms(old, {"variable_id": (terms, "id", "term")}).orderBy("datastream_tablename").collect()] == ["flow", "level", None, "unknown 9"]


def test_child_tables_come_back_into_the_documents(spark):
    nodes = spark.createDataFrame([("a", None), ("b", "a"), ("c", "a")], "code string, parent string")
    aliases = spark.createDataFrame([("b", "z", 1), ("b", "y", None), ("x", "q", 1)], "code string, alias string, priority int")
    properties = spark.createDataFrame([("a", "p", "v")], "code string, property_name string, property_value string")
    (root,) = trees.nest_tree(nodes, "code", "parent", children="parts", attachments={"aliases": aliases, "properties": properties}).collect()
    assert root.node_count == 3 and json.loads(root.document) == {
        "code": "a", "aliases": [], "properties": [{"property_name": "p", "property_value": "v"}], "parts": [
            {"code": "b", "aliases": [{"alias": "y", "priority": None}, {"alias": "z", "priority": 1}], "properties": [], "parts": []},
            {"code": "c", "aliases": [], "properties": [], "parts": []}]}
