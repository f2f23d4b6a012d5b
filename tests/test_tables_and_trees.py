import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sensorlake.functions import rules
from sensorlake.operators import checks, mapping, samples, tables, trees, validation
from sensorlake.plans.base_load import load_base_tables


@pytest.fixture
def people(spark):
    return spark.createDataFrame([(1, "ann", "a@x", 5), (2, "bob", "b@x", 6)], "id long, name string, mail string, age int")


def test_upsert_keeps_columns_the_update_lacks(spark, people, values):
    new = spark.createDataFrame([(2, "rob"), (3, "cat")], "id long, name string")
    assert values(tables.upsert(people, new, "id")) == sorted([(1, "ann", "a@x", 5), (2, "rob", "b@x", 6), (3, "cat", None, None)], key=repr)
    assert values(tables.upsert(tables.upsert(people, new, "id"), new, "id")) == values(tables.upsert(people, new, "id"))


def test_natural_keys(spark, people, values):
    new = spark.createDataFrame([("ann", "z@x", 9), ("dan", "b@x", 8), ("eve", "e@x", 7)], "name string, mail string, age int")
    out = values(tables.upsert_natural(people, new, "id", ["name", "mail"], ["name"]))
    assert out == [(1, "ann", "z@x", 9), (2, "dan", "b@x", 8), (3, "eve", "e@x", 7)]
    with pytest.raises(ValueError):
        tables.upsert_natural(people, new, "id", ["name"], ["name"], update_only=True)
    assert tables.upsert_natural(people, new.limit(1), "id", ["name"], ["name"], update_only=True).count() == 2


def test_ids_are_dense_and_ordered(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"), F.lit(1).alias("same"))
    out = tables.assign_ids(df, "n", ["same", "k"], 11)
    assert out.filter(F.col("n") != F.col("k") + 11).isEmpty() and out.count() == 5000


def test_generic_reads(spark, people):
    assert tables.read(people, name="ann", age=None).count() == 1
    assert tables.read_fuzzy(people, mail="_@").count() == 2 and tables.read_fuzzy(people, name="N").count() == 0
    assert tables.read_any(people, name=["ann"], age=[6]).count() == 2
    assert tables.read_any(people, age=list(range(6, 5000)), name=None).count() == 1
    assert tables.read_one(people, id=2).name == "bob" and tables.read_one_or_none(people, id=9) is None
    for bad in ({"id": 9}, {}):
        with pytest.raises(LookupError):
            tables.read_one(people, **bad)
    with pytest.raises(ValueError, match="did you mean 'name'"):
        tables.read(people, nmae="x")
    assert [r.id for r in tables.page(people, ["id"], 1, 1).collect()] == [2]
    assert [r.id for r in tables.page(people, ["id"], 5, after=1).collect()] == [2]
    assert tables.count(people).first().row_count == 2
    assert tables.distinct(people, "age", ["id"], limit=1).collect() == [(5,)]


def test_writes(spark, people, values):
    changed = tables.update_rows(people, spark.createDataFrame([(1, None, 50), (9, "x", 1)], "id long, name string, age int"), "id")
    assert values(changed) == [(1, "ann", "a@x", 50), (2, "bob", "b@x", 6)]
    with pytest.raises(ValueError):
        tables.update_rows(people, spark.createDataFrame([("a",)], "name string"), "id")
    assert tables.delete_rows(people, name="ann").count() == 1
    assert tables.insert(people, spark.createDataFrame([(3,)], "id long")).count() == 3
    filled = tables.bulk_insert(people, spark.createDataFrame([(3, "x", None), (4, None, None)], "id long, name string, age int"), {"age": 1, "name": "none"})
    assert values(filled.filter("id > 2")) == [(3, "x", None, 1), (4, None, None, 1)]


def test_resolve_prefers_the_first_pair(spark):
    dim = spark.createDataFrame([(1, "a", "b"), (2, "b", "c")], "org_id long, name string, code string")
    df = spark.createDataFrame([("b",), ("c",), ("q",)], "x string")
    out = {r.x: r.o for r in tables.resolve_ids(df, dim, [("x", "name"), ("x", "code")], "org_id", "o").collect()}
    assert out == {"b": 2, "c": 2, "q": None}
    with pytest.raises(PySparkException):
        tables.resolve_ids(df, dim, [("x", "name"), ("x", "code")], "org_id", "o", required=True).collect()


def test_base_load_twice_changes_nothing(spark, values):
    incoming = {"organizations": spark.createDataFrame([("Org", "o1")], "organization_name string, organization_code string"),
                "persons": spark.createDataFrame([("Ann",)], "person_name string"),
                "affiliations": spark.createDataFrame([("Ann", "o1")], "person_name string, organization_code string"),
                "equipment_models": spark.createDataFrame([("p1", "Org"), ("p2", "o1")], "equipment_model_part_number string, equipment_manufacturer_name string")}
    once, report = load_base_tables({}, incoming)
    again, _ = load_base_tables(once, incoming)
    assert report.first().orphans == 0
    for name in incoming:
        assert values(once[name]) == values(again[name], *once[name].columns)


def site(code, *children, **more):
    return {"sampling_feature_code": code, "sampling_feature_uuid": "u" + code, "child_sampling_features": list(children), **more}


def related(doc):
    """The document with a relation on every child."""
    return doc | {"child_sampling_features": [related(c) | {"relation_to_parent": "isChildOf"} for c in doc["child_sampling_features"]]}


def test_child_without_relation_is_an_error(spark):
    df = spark.createDataFrame([(json.dumps(site("a", site("b"))),)], "body string")
    with pytest.raises(Exception, match="no relation_to_parent for b"):
        trees.flatten_feature_tree(df, "body", max_depth=2)["edges"].collect()


def test_chain_deeper_than_any_fixed_bound(spark):
    chain = spark.range(150).select("id", F.when(F.col("id") > 0, F.col("id") - 1).alias("parent_id"), F.lit(1).alias("weight"))
    assert {(r.total, r.cyclic) for r in trees.ancestor_sums(chain).collect()} == {(k, False) for k in range(1, 151)}


def test_any_of_long_lists_and_other_types(spark):
    df = spark.range(5000).select(F.col("id").cast("double").alias("v"))
    assert tables.read_any(df, v=list(range(1500))).count() == 1500
    assert tables.read_any(spark.sql("SELECT DATE '2024-01-02' AS d"), d=["2024-01-02"]).count() == 1


def test_two_updates_of_a_key_are_an_error(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    assert sorted(map(tuple, tables.upsert(target, spark.createDataFrame([(2, "c"), (3, "d")], "k long, v string"), "k").collect())) == [(1, "a"), (2, "c"), (3, "d")]
    with pytest.raises(Exception, match="more than one update for k 2"):
        tables.upsert(target, spark.createDataFrame([(2, "c"), (2, "d")], "k long, v string"), "k").collect()


def test_flatten_then_nest_gives_the_tree_back(spark):
    docs = [site("a", site("b", site("d")), site("c")), site("e")]
    df = spark.createDataFrame([(json.dumps(related(d)),) for d in docs], "body string")
    out = trees.flatten_feature_tree(df, "body", max_depth=3)
    assert out["nodes"].count() == 5 and out["edges"].count() == 3
    parents = out["edges"].select("sampling_feature_code", F.col("related_feature_code").alias("parent"))
    nodes = out["nodes"].select("sampling_feature_code", "sampling_feature_uuid").join(parents, "sampling_feature_code", "left")
    nested = trees.nest_tree(nodes, "sampling_feature_code", "parent")
    assert sorted((json.loads(r.document) for r in nested.collect()), key=lambda d: d["sampling_feature_code"]) == docs
    split = trees.nest_tree(nodes, "sampling_feature_code", "parent", cut=2).collect()
    assert sum(r.node_count for r in split) == 5
    assert {r.sampling_feature_code: r.parent for r in split} == {"a": None, "b": "a", "c": "a", "e": None}


def test_deep_and_broken_documents_are_errors(spark):
    deep = spark.createDataFrame([(json.dumps(site("a", site("b", site("c")))),)], "body string")
    with pytest.raises(Exception, match="deeper than 1"):
        trees.flatten_feature_tree(deep, "body", max_depth=1)
    with pytest.raises(Exception, match="MALFORMED"):
        trees.flatten_feature_tree(spark.createDataFrame([("{bad",)], "body string"), "body", max_depth=1)


def test_nesting_a_cycle_is_an_error(spark):
    nodes = spark.createDataFrame([("a", "b", 1), ("b", "a", 1)], "code string, parent string, x int")
    with pytest.raises(ValueError):
        trees.nest_tree(nodes, "code", "parent")


def test_duplicate_sites(spark):
    nodes = spark.createDataFrame([("a", "u1", 1), ("a", "u2", 1), ("b", "u3", 1), ("b", "u3", 1)],
                                  "sampling_feature_code string, sampling_feature_uuid string, elevation_m int")
    out = {(r.field, r.value): (r.n, r.differs) for r in trees.check_feature_tree(nodes).collect()}
    assert out == {("sampling_feature_code", "a"): (2, True), ("sampling_feature_code", "b"): (2, False), ("sampling_feature_uuid", "u3"): (2, False)}


SCHEMA = {"type": "object", "required": ["a"], "additionalProperties": False, "properties": {
    "a": {"type": "integer", "minimum": 1, "maximum": 9}, "b": {"type": ["string", "null"], "minLength": 2, "maxLength": 3, "pattern": "^x"}, "c": {"enum": ["p", None]}}}


@pytest.mark.parametrize("body, expected", [
    ('{"a":1}', []), ('{"a":1.0}', []), ('{"a":1.5}', ["a: type"]), ('{"a":"1"}', ["a: type"]), ('{}', ["a: required"]), ('{"a":0}', ["a: minimum"]), ('{"a":10}', ["a: maximum"]),
    ('{"a":1,"b":null,"c":null}', []), ('{"a":1,"b":"xyzw"}', ["b: maxLength"]), ('{"a":1,"b":"yy"}', ["b: pattern"]), ('{"a":1,"b":"x"}', ["b: minLength"]),
    ('{"a":1,"c":"q"}', ["c: enum"]), ('{"a":1,"z":1}', ["additional property"]), ('{"a":', ["json"]), ('{"a":true}', ["a: type"])])
def test_schema(spark, body, expected):
    df = spark.createDataFrame([(body,)], "body string")
    assert validation.schema_violations(df, "body", SCHEMA).first().violations == expected


def test_rules(spark):
    def ok(rule, *texts):
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        return [r[0] is None for r in df.select(rule(F.col("t"))).collect()]

    assert ok(rules.integer, "3", "3.0", "3.5", "true", None, "nan") == [True, True, False, False, False, False]
    assert ok(lambda c: rules.floating(c, 0, 1), "0.5", "2", "x") == [True, False, False]
    assert ok(rules.boolean, "TRUE", "0", "yes") == [True, True, False]
    assert ok(lambda c: rules.one_of(c, ["A"], fold_case=False), "A", "a") == [True, False]
    assert ok(rules.identifier, "1", "0", "1.5") == [True, False, False]
    assert ok(rules.id_list, "1", "[1, 2]", "[1, 0]", "x", "{}") == [True, True, False, False, False]
    assert ok(lambda c: rules.id_list(c, enforce_list=True), "1", "[1]") == [False, True]
    assert ok(rules.date_time, "2024-02-30", "2024-02-29", "1700000000") == [False, True, True]
    assert ok(lambda c: rules.date_range(c, F.lit("2024-01-02")), "2024-01-02", "2024-01-03") == [True, False]
    assert ok(lambda c: rules.text_length(c, exact=2), "ab", "abc") == [True, False]
    assert ok(rules.port, "0", "65535", "65536") == [False, True, False]
    assert ok(rules.json_text, "{}", "{") == [True, False]
    assert ok(lambda c: rules.timezone_name(c, ["UTC"]), "UTC", "Mars") == [True, False]


def test_annotated_cells(spark):
    cells = ["5.1", "nan", "< 0.02", "E 3.1 d", "3.1 d", "M", "2024-01-01 00:00:00", " 7 "]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, cell string")
    out = [(r.remark, r.value, r.qualifiers) for r in samples.annotate(df, "cell").orderBy("i").collect()]
    assert out == [(None, "5.1", None), (None, "nan", None), ("<", "0.02", None), ("E", "3.1", "d"), (None, "3.1", "d"), ("M", None, None),
                   (None, "2024-01-01 00:00:00", None), (None, "7", None)]
    with pytest.raises(PySparkException):
        samples.annotate(spark.createDataFrame([("a b c d",)], "cell string"), "cell").collect()


def test_unknown_codes_are_reported_and_zero_is_kept(spark):
    from sensorlake.sources import mappers
    dims = (mappers.table(spark, mappers.REMARKS_COLUMNS, mappers.REMARKS), mappers.table(spark, mappers.QUALIFIERS_COLUMNS, mappers.QUALIFIERS))
    df = samples.annotate(spark.createDataFrame([("< 0",), ("Q 1 d1",), ("3 \\",)], "cell string"), "cell")
    out = {r.cell: r for r in samples.expand_qualifiers(df, *dims).collect()}
    assert out["< 0"].censor_code == "lessThan" and out["< 0"].unknown_codes == []
    assert out["Q 1 d1"].unknown_codes == ["Q", "1"] and out["Q 1 d1"].qualifier_names == ["sample was diluted"]
    assert out["3 \\"].qualifier_names[0].startswith("lab control sample")
    assert samples.result_qualifiers(samples.expand_qualifiers(df, *dims), ["cell"]).filter("cell = '< 0'").count() == 1


def test_specimens_are_reused_and_need_a_site(spark):
    taken = spark.sql("SELECT 'S' AS sampling_feature_code, TIMESTAMP_NTZ '2024-01-01 10:00:00' AS timestamp")
    sites = spark.sql("SELECT 'S' AS sampling_feature_code, 'POINT(1 2)' AS feature_geometry_wkt, 5D AS elevation_m, 2D AS latitude, 1D AS longitude")
    made = samples.make_specimens(taken, sites, "isPartOf")["features"]
    row = made.first()
    assert (row.sampling_feature_code, row.sampling_feature_type_cv, row.elevation_m) == ("S_geochem2024-01-01-10-00-00", "depthInterval", 5.0)
    both = sites.unionByName(made.select(*sites.columns))
    assert samples.make_specimens(taken, both)["features"].isEmpty()
    with pytest.raises(PySparkException):
        samples.make_specimens(taken, sites.filter("false"))["features"].collect()
    with pytest.raises(ValueError):
        samples.make_specimens(taken, sites, "isNear")


def test_sensor_map_carries_times_forward(spark):
    config = spark.createDataFrame([("b", 1, None, ["t_1", "t_2", "f"], [
        ("s0", None, "x", 0.1, None, None, ["t*"]), ("s1", "c1", "x", 0.1, 7, None, ["F"]), ("s2", None, "x", 0.1, None, 9, ["t_1"]), ("s3", None, "x", 0.1, None, None, ["f"])])],
        "block string, start_timestamp long, end_timestamp long, columns array<string>, attached_sensors array<struct<sensor_name:string,sensor_code:string,"
        "serial_number:string,sensor_z_offset:double,start_timestamp:long,end_timestamp:long,columns:array<string>>>")
    rows = mapping.attached_sensors(config).orderBy("position").collect()
    assert [(r.equipment_code, r.position_start_date_utc, r.position_end_date_utc, r.columns) for r in rows] == [
        ("s0", 1, None, ["t_1", "t_2"]), ("c1", 7, None, ["f"]), ("s2", 7, 9, ["t_1"]), ("s3", 7, 9, ["f"])]


def test_last_n_of_a_dominant_stream(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")).cast("long").alias("datastream_id"), F.col("id").alias("utc_time"),
                                    F.col("id").cast("double").alias("data_value"), F.lit("z").alias("qa_flag"))
    out = checks.last_n(df, 10).filter("datastream_id = 0").orderBy("rank").collect()
    assert [r.utc_time for r in out] == [19999, 19997, 19996, 19994, 19993, 19991, 19990, 19988, 19987, 19985]


def test_sync_reports(spark):
    def registry(rows):
        return spark.createDataFrame(rows, "datastream_id long, datastream_uuid string, first_measurement_date long, last_measurement_date long, total_measurement_numbers long")

    local = registry([(1, "a", 0, 5, 2), (2, "b", 0, 5, 9), (3, "c", 0, 5, 2), (4, "d", None, None, None)])
    remote = registry([(11, "a", 0, 9, 4), (12, "b", 0, 9, 4), (13, "c", 0, 5, 2), (14, "d", 3, 4, 2), (15, "e", 0, 1, 1), (16, "f", None, None, None)])
    obs = spark.createDataFrame([(11, 5, 1.0, "z"), (11, 6, 2.0, "f"), (11, 9, 3.0, "z"), (11, 10, 4.0, "z"), (14, 3, 1.0, "z"), (14, 4, 1.0, "z")],
                                "datastream_id long, utc_time long, data_value double, qa_flag string")
    out = checks.sync_delta(local, remote, obs)
    assert {r.datastream_uuid: r.action for r in out["report"].collect()} == {
        "a": "update", "b": "local has more", "c": "equal", "d": "update", "e": "not found locally", "f": "not found locally"}
    assert sorted((r.datastream_id, r.utc_time) for r in out["rows"].collect()) == [(1, 6), (1, 9), (4, 3), (4, 4)]
    assert {r.datastream_id: (r.last_measurement_date, r.total_measurement_numbers) for r in out["registry"].collect()} == {1: (9, 4), 2: (5, 9), 3: (5, 2), 4: (4, 2)}
