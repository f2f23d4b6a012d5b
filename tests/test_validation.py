"""JSON schema validation against a plain walk over the parsed documents."""

import json
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from sensorlake.operators import validation

TYPES = {"string": str, "boolean": bool, "null": type(None), "array": list, "object": dict}


def is_kind(v, kind):
    if kind in ("integer", "number"):
        return isinstance(v, int | float) and not isinstance(v, bool) and (kind == "number" or float(v).is_integer())
    return isinstance(v, TYPES[kind])


def same(a, b):
    return isinstance(a, bool) == isinstance(b, bool) and a == b


def plain(v, rule, root, path="", formats=False):
    """Violations of a value as the library words them."""
    if rule is True:
        return []
    if rule is False:
        return [f"{path}: not allowed" if path else "not allowed"]
    if "$ref" in rule:
        target = root
        for step in rule["$ref"].split("/")[1:]:
            target = target[step]
        return plain(v, target, root, path, formats)
    say = lambda name, at=path: f"{at}: {name}" if at else name
    inside = lambda name: f"{path}.{name}" if path else name
    number = isinstance(v, int | float) and not isinstance(v, bool)
    out = []
    if "type" in rule and not any(is_kind(v, k) for k in ([rule["type"]] if isinstance(rule["type"], str) else rule["type"])):
        out.append(say("type"))
    if "enum" in rule and not any(same(v, x) for x in rule["enum"]):
        out.append(say("enum"))
    if "const" in rule and not same(v, rule["const"]):
        out.append(say("const"))
    if isinstance(v, str):
        out += [say(k) for k, bad in (("minLength", len(v) < rule.get("minLength", 0)), ("maxLength", len(v) > rule.get("maxLength", math.inf)),
                                      ("pattern", not re.search(rule.get("pattern", ""), v))) if bad]
        if formats and rule.get("format") == "date" and not re.fullmatch(r"\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])", v):
            out.append(say("format"))
    if number:
        out += [say(k) for k, bad in (("minimum", v < rule.get("minimum", v)), ("maximum", v > rule.get("maximum", v)),
                                      ("exclusiveMinimum", v <= rule.get("exclusiveMinimum", v - 1)), ("exclusiveMaximum", v >= rule.get("exclusiveMaximum", v + 1)),
                                      ("multipleOf", "multipleOf" in rule and v / rule.get("multipleOf", 1) != math.floor(v / rule.get("multipleOf", 1)))) if bad]
    if isinstance(v, list):
        out += [say(k) for k, bad in (("minItems", len(v) < rule.get("minItems", 0)), ("maxItems", len(v) > rule.get("maxItems", math.inf)),
                                      ("uniqueItems", rule.get("uniqueItems") and len({json.dumps(x, sort_keys=True) for x in v}) < len(v))) if bad]
        for k, x in enumerate(v):
            out += plain(x, rule.get("items", True), root, f"{path}[{k}]", formats)
    if isinstance(v, dict):
        out += [say("required", inside(n)) for n in rule.get("required", ()) if n not in v]
        extra = [n for n in v if n not in rule.get("properties", {})]
        if rule.get("additionalProperties") is False and extra:
            out.append(say("additional property"))
        if isinstance(rule.get("additionalProperties"), dict):
            for n in extra:
                out += plain(v[n], rule["additionalProperties"], root, inside(n), formats)
        for n, sub in rule.get("properties", {}).items():
            if n in v:
                out += plain(v[n], sub, root, inside(n), formats)
    for sub in rule.get("allOf", ()):
        out += plain(v, sub, root, path, formats)
    holds = lambda sub: not plain(v, sub, root, path, formats)
    if "anyOf" in rule and not any(map(holds, rule["anyOf"])):
        out.append(say("anyOf"))
    if "oneOf" in rule and sum(map(holds, rule["oneOf"])) != 1:
        out.append(say("oneOf"))
    if "not" in rule and holds(rule["not"]):
        out.append(say("not"))
    return out


def rows(spark, docs):
    return spark.createDataFrame([(k, json.dumps(d)) for k, d in enumerate(docs)], "k int, body string")


def check(spark, docs, schema, **options):
    item = schema["items"] if schema.get("type") == "array" else schema
    got = {r["k"]: sorted(r["violations"]) for r in validation.schema_violations(rows(spark, docs), "body", schema, **options).collect()}
    assert got == {k: sorted(plain(d, item, schema, **options)) for k, d in enumerate(docs)}
    return got


NESTED = {
    "type": "object", "required": ["name", "list"], "additionalProperties": {"type": "integer"},
    "properties": {
        "name": {"type": "string", "minLength": 2, "maxLength": 4, "pattern": "^[a-c]"},
        "list": {"type": ["array", "null"], "minItems": 1, "maxItems": 3, "uniqueItems": True, "items": {
            "type": "object", "required": ["v"], "additionalProperties": False, "properties": {
                "v": {"type": "number", "minimum": 0, "exclusiveMaximum": 5, "multipleOf": 0.5}, "day": {"type": "string", "format": "date"},
                "tags": {"type": "array", "items": {"enum": ["x", 1, None, True]}}}}},
        "pair": {"$ref": "#/definitions/pair"}, "a.b": {"const": 3}, "any": {"anyOf": [{"type": "string"}, {"type": "number", "exclusiveMinimum": 2}]},
        "one": {"oneOf": [{"type": "integer"}, {"type": "number"}]}, "no": {"not": {"type": "null"}}, "all": {"allOf": [{"type": "string"}, {"maxLength": 1}]},
        "gone": False, "free": True, "title": {"title": "a title", "description": "says nothing"}},
    "definitions": {"pair": {"type": "array", "minItems": 2, "maxItems": 2, "items": {"type": "integer"}}},
}


def random_document(rng):
    value = lambda: rng.choice([None, True, False, 0, 1, 2, 2.75, 7, -1, "a", "abc", "x", "zzzzz", "2024-01-31", "2024-13-01", [], {}, [1, 2], [1, "2"]])
    doc = {}
    for name in ("name", "pair", "a.b", "any", "one", "no", "all", "gone", "free", "title", "more", "other"):
        if rng.random() < 0.45:
            doc[name] = value()
    if rng.random() < 0.85:
        doc["list"] = rng.choice([value(), [{k: value() for k in ("v", "day", "tags", "odd") if rng.random() < 0.5} for _ in range(rng.randint(0, 4))]])
    return doc if rng.random() < 0.95 else value()


@pytest.mark.parametrize("formats", [False, True])
def test_random_nested_documents(spark, formats):
    rng = random.Random(11)
    got = check(spark, [random_document(rng) for _ in range(500)], NESTED, formats=formats)
    rules = {v.rsplit(": ", 1)[-1] for found in got.values() for v in found}
    assert rules >= {"type", "enum", "const", "minLength", "maxLength", "pattern", "minimum", "exclusiveMaximum", "multipleOf", "minItems", "maxItems", "uniqueItems",
                     "required", "additional property", "anyOf", "oneOf", "not", "not allowed"} and ("format" in rules) == formats


TREE = {"type": "array", "items": {
    "type": "object", "required": ["code"], "properties": {"code": {"type": "string"}, "size": {"type": "number", "minimum": 0},
                                                           "parts": {"type": ["array", "null"], "items": {"$ref": "#/items"}}, "twin": {"$ref": "#/items"}}}}


def random_tree(rng, depth):
    node = {}
    if rng.random() < 0.8:
        node["code"] = rng.choice(["a", "b", 7])
    if rng.random() < 0.5:
        node["size"] = rng.choice([1, -1, "x"])
    if depth and rng.random() < 0.8:
        node["parts"] = [random_tree(rng, depth - 1) for _ in range(rng.randint(0, 2))]
    if depth and rng.random() < 0.3:
        node["twin"] = random_tree(rng, depth - 1)
    return node


def test_schemas_that_refer_to_themselves(spark):
    rng = random.Random(5)
    chain = {"size": -1}
    for _ in range(20):
        chain = {"code": "c", "parts": [chain]}
    got = check(spark, [*(random_tree(rng, 5) for _ in range(120)), chain, {}, 5], TREE)
    assert got[120] == sorted(["parts[0]." * 19 + "parts[0].code: required", "parts[0]." * 19 + "parts[0].size: minimum"])


def test_a_round_checks_and_goes_on_in_one_pass(spark, monkeypatch):
    """What is wrong is written with what lies below, so no level is read twice, and records are not kept as values."""
    tables, written = [], validation.written
    monkeypatch.setattr(validation, "written", lambda df, name: tables.append(written(df, name)) or tables[-1])
    df = validation.schema_violations(rows(spark, [{"code": "a", "parts": [{"size": -1, "parts": [{"code": 7}]}]}, {"code": "b"}]), "body", TREE)
    assert [sorted(t.columns) for t in tables] == [["_below", "_found", "_row", "body", "k"]] + [["_below", "_found", "_row"]] * 2
    assert [r["_found"] for r in tables[2].collect()] == [["parts[0].parts[0].code: type"]]
    plan = tables[0]._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().optimizedPlan().toString()
    assert "variant" not in plan.lower().replace("node:variant", "")
    assert {r["k"]: r["violations"] for r in df.collect()} == {
        0: ["parts[0].code: required", "parts[0].parts[0].code: type", "parts[0].size: minimum"], 1: []}


def test_a_record_is_parsed_once(spark):
    df = validation.schema_violations(rows(spark, [{"name": "abc", "list": [{"v": 1}]}]), "body", NESTED)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().replace("_", "").count("parsejson(") == 1
    assert df.first()["violations"] == []


@pytest.mark.parametrize("schema", [
    {"type": "object", "patternProperties": {}}, {"properties": {"a": {"if": {}}}}, {"type": "text"}, {"$ref": "other.json#/a"}, {"properties": {"a": {"$ref": "#/nowhere"}}},
    {"enum": [[1]]}, {"items": [{"type": "string"}]}, {"properties": {"it's": {"type": "string"}}}])
def test_what_is_not_known_is_refused(spark, schema):
    with pytest.raises(ValueError):
        validation.schema_violations(rows(spark, [{}]), "body", schema)


def test_broken_texts_and_rows(spark):
    df = spark.createDataFrame([(1, "{"), (2, None), (3, '{"code":"a"}'), (3, '{"code":"a"}')], "k int, body string")
    for schema in (TREE, TREE["items"]["properties"]["code"] | {"type": "object"}):
        found = sorted((r["k"], r["violations"]) for r in validation.schema_violations(df, "body", schema).collect())
        assert found == [(1, ["json"]), (2, ["json"]), (3, []), (3, [])]
    good, bad = validation.validate_records(df, "body", TREE)
    assert good.count() == 2 and bad.select(F.col("violation")).distinct().collect() == [("json",)]
