"""Record validation: JSON schema of nested records, value rules.

A record is parsed once, as VARIANT, so ``"1"`` and ``1`` stay apart; the schema is walked when the plan is made. Members, array items and
local references become expressions over that one value. A schema that refers to itself is unrolled once per round: what lies below
the reference goes on as rows of its own, until no record has anything left, so documents of any depth are checked to the end.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.session import written

_KIND_PATTERN = {
    "string": "^STRING$",
    "integer": "^(BIGINT|DECIMAL\\(\\d+,0\\))$",
    "number": "^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$",
    "boolean": "^BOOLEAN$",
    "null": "^VOID$",
    "array": "^ARRAY.*$",
    "object": "^OBJECT.*$",
}
#: Keywords that say something about a schema but restrict nothing.
ANNOTATIONS = {"title", "description", "$schema", "$id", "$comment", "default", "examples", "definitions", "$defs"}
RULES = {"type", "enum", "const", "minLength", "maxLength", "pattern", "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "multipleOf", "required",
         "properties", "additionalProperties", "items", "minItems", "maxItems", "uniqueItems", "allOf", "anyOf", "oneOf", "not", "format"}
_FORMATS = {
    "date-time": r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])[Tt]([01]\d|2[0-3]):[0-5]\d:([0-5]\d|60)(\.\d+)?([Zz]|[+-]([01]\d|2[0-3]):[0-5]\d)$",
    "date": r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])$",
    "time": r"^([01]\d|2[0-3]):[0-5]\d:([0-5]\d|60)(\.\d+)?([Zz]|[+-]([01]\d|2[0-3]):[0-5]\d)?$",
    "uuid": r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
}
_PENDING = "array<struct<path:string,ref:string,node:variant>>"
Path = str | Column


def _member(path: Path, name: str | Column) -> Path:
    if isinstance(path, str) and isinstance(name, str):
        return f"{path}.{name}" if path else name
    name = F.lit(name) if isinstance(name, str) else name
    return F.concat(_text(path), F.lit("."), name) if not isinstance(path, str) or path else name


def _item(path: Path, place: Column) -> Path:
    return F.concat(_text(path), F.lit("["), place.cast("string"), F.lit("]"))


def _text(path: Path) -> Column:
    return F.lit(path) if isinstance(path, str) else path


def _message(path: Path, rule: str) -> Column:
    if isinstance(path, str):
        return F.lit(f"{path}: {rule}" if path else rule)
    # Below a reference the path of the record itself is empty.
    return F.when(path == "", rule).otherwise(F.concat(path, F.lit(f": {rule}")))


def _get(value: Column, name: str) -> Column:
    if "'" in name or "\\" in name:
        raise ValueError(f"property names cannot hold quotes: {name}")
    return F.try_variant_get(value, f"$['{name}']", "variant")


def _kind(value: Column) -> Column:
    """Name of the type of a value. Objects and arrays are not looked into: ``schema_of_variant`` alone would merge the types of all that lies in them."""
    is_object = F.try_variant_get(value, "$", "struct<>").isNotNull()
    is_array = F.try_variant_get(value, "$", "array<struct<>>").isNotNull()
    return F.when(is_object, "OBJECT").when(is_array, "ARRAY").otherwise(F.schema_of_variant(value))


def _equals(value: Column, kind: Column, constant) -> Column:
    if constant is None:
        return kind == "VOID"
    if isinstance(constant, bool):
        return kind.rlike(_KIND_PATTERN["boolean"]) & (F.try_variant_get(value, "$", "boolean") == constant)
    if isinstance(constant, int | float):
        return kind.rlike(_KIND_PATTERN["number"]) & (F.try_variant_get(value, "$", "double") == float(constant))
    if isinstance(constant, str):
        return (kind == "STRING") & (F.try_variant_get(value, "$", "string") == constant)
    raise ValueError(f"only plain values can be listed: {constant!r}")


def _any(conditions: list[Column]) -> Column:
    return reduce(Column.__or__, conditions, F.lit(False))


class SchemaWalk:
    """A schema as expressions. ``recursive`` holds the references that lead back to where they are."""

    def __init__(self, root: dict, formats: bool = False):
        self.root, self.formats = root, formats
        self.recursive: dict[str, dict] = {}
        #: In how many arrays the walk is. There, no engine notices that a value is computed before.
        self.depth = 0

    def resolve(self, ref: str) -> dict:
        if not ref.startswith("#"):
            raise ValueError(f"only references within the schema are known: {ref}")
        rule = self.root
        for step in ref[1:].split("/")[1:]:
            step = step.replace("~1", "/").replace("~0", "~")
            if not isinstance(rule, dict) or step not in rule:
                raise ValueError(f"the schema has no {ref}")
            rule = rule[step]
        return rule

    def own(self, value: Column, kind: Column, rule: dict) -> list[tuple[Column, str]]:
        """Conditions on the value itself that must not hold, each with the name of its rule."""
        present = value.isNotNull()
        is_text, is_number = kind == "STRING", kind.rlike(_KIND_PATTERN["number"])
        text, number = F.try_variant_get(value, "$", "string"), F.try_variant_get(value, "$", "double")
        items = F.try_variant_get(value, "$", "array<variant>")
        checks = []
        if "type" in rule:
            kinds = [rule["type"]] if isinstance(rule["type"], str) else rule["type"]
            unknown = [k for k in kinds if k not in _KIND_PATTERN]
            if unknown:
                raise ValueError(f"unknown types {unknown}")
            checks.append((~kind.rlike("|".join(_KIND_PATTERN[k] for k in kinds)), "type"))
        if "enum" in rule:
            checks.append((~_any([_equals(value, kind, v) for v in rule["enum"]]), "enum"))
        if "const" in rule:
            checks.append((~_equals(value, kind, rule["const"]), "const"))
        if "minLength" in rule:
            checks.append((is_text & (F.char_length(text) < rule["minLength"]), "minLength"))
        if "maxLength" in rule:
            checks.append((is_text & (F.char_length(text) > rule["maxLength"]), "maxLength"))
        if "pattern" in rule:
            checks.append((is_text & ~text.rlike(rule["pattern"]), "pattern"))
        if self.formats and rule.get("format") in _FORMATS:
            checks.append((is_text & ~text.rlike(_FORMATS[rule["format"]]), "format"))
        if "minimum" in rule:
            checks.append((is_number & (number < rule["minimum"]), "minimum"))
        if "maximum" in rule:
            checks.append((is_number & (number > rule["maximum"]), "maximum"))
        if "exclusiveMinimum" in rule:
            checks.append((is_number & (number <= rule["exclusiveMinimum"]), "exclusiveMinimum"))
        if "exclusiveMaximum" in rule:
            checks.append((is_number & (number >= rule["exclusiveMaximum"]), "exclusiveMaximum"))
        if "multipleOf" in rule:
            quotient = number / F.lit(float(rule["multipleOf"]))
            checks.append((is_number & (quotient != F.floor(quotient).cast("double")), "multipleOf"))
        if "minItems" in rule:
            checks.append((F.size(items) < rule["minItems"], "minItems"))
        if "maxItems" in rule:
            checks.append((F.size(items) > rule["maxItems"], "maxItems"))
        if rule.get("uniqueItems"):
            texts = F.transform(items, lambda x: F.to_json(x))
            checks.append((F.size(F.array_distinct(texts)) < F.size(texts), "uniqueItems"))
        found = [(present & bad, name) for bad, name in checks]
        is_object = present & kind.rlike(_KIND_PATTERN["object"])
        for name in rule.get("required", ()):
            found.append((is_object & _get(value, name).isNull(), (name, "required")))
        if rule.get("additionalProperties") is False:
            known = F.array(*map(F.lit, rule.get("properties", {}))).cast("array<string>")
            keys = F.map_keys(F.try_variant_get(value, "$", "map<string,variant>"))
            found.append((is_object & (F.size(F.array_except(keys, known)) > 0), "additional property"))
        return found

    def branches(self, value: Column, rule: dict, path: Path, stack: tuple) -> list[tuple[Column, str]]:
        """Conditions of ``anyOf``, ``oneOf`` and ``not``, which count the branches that hold."""
        found = []
        for name in ("anyOf", "oneOf", "not"):
            if name not in rule:
                continue
            subs = [rule[name]] if name == "not" else rule[name]
            before = set(self.recursive)
            messages = [self.walk(value, sub, path, stack, False) for sub in subs]
            if set(self.recursive) != before:
                raise ValueError(f"{name} cannot lead back to itself")
            holds = [F.lit(True) if m is None else F.size(m) == 0 for m in messages]
            count = reduce(Column.__add__, [h.cast("int") for h in holds])
            bad = {"anyOf": count == 0, "oneOf": count != 1, "not": count > 0}[name]
            found.append((value.isNotNull() & bad, name))
        return found

    def walk(self, value: Column, rule, path: Path, stack: tuple, pending: bool) -> Column | None:
        """Messages of a value and all that lies in it (None: there can be none); or, with ``pending``, what lies below references that lead
        back, as ``path, ref, node``."""
        if rule is True or rule == {}:
            return None
        if rule is False:
            return None if pending else F.when(value.isNotNull(), F.array(_message(path, "not allowed"))).otherwise(F.array().cast("array<string>"))
        if "$ref" in rule:
            target = self.resolve(rule["$ref"])
            if id(target) not in stack:
                return self.walk(value, target, path, stack, pending)
            self.recursive[rule["$ref"]] = target
            here = F.array(F.struct(_text(path).alias("path"), F.lit(rule["$ref"]).alias("ref"), value.alias("node"))).cast(_PENDING)
            return F.when(value.isNotNull(), here).otherwise(F.array().cast(_PENDING)) if pending else None
        unknown = set(rule) - RULES - ANNOTATIONS
        if unknown:
            raise ValueError(f"unsupported schema keywords {sorted(unknown)}")
        stack = (*stack, id(rule))
        parts: list[Column] = []
        if not pending:
            others = self.branches(value, rule, path, stack)

            def broken(kind: Column) -> Column | None:
                checks = [(F.coalesce(bad, F.lit(False)), name) for bad, name in self.own(value, kind, rule) + others]
                named = [F.when(bad, _message(path, name) if isinstance(name, str) else _message(_member(path, name[0]), name[1])) for bad, name in checks]
                # Most values are as they should be: only the others have messages put together.
                return F.when(_any([bad for bad, _ in checks]), F.filter(F.array(*named), lambda m: m.isNotNull())).otherwise(
                    F.array().cast("array<string>")) if checks else None

            parts.append(self.once(_kind(value), broken))
        for sub in rule.get("allOf", ()):
            parts.append(self.walk(value, sub, path, stack, pending))
        for name, sub in rule.get("properties", {}).items():
            parts.append(self.once(_get(value, name), lambda v, n=name, r=sub: self.walk(v, r, _member(path, n), stack, pending)))
        more = rule.get("additionalProperties")
        if isinstance(more, dict) and more:
            parts.append(self.others(value, rule, more, path, stack, pending))
        if "items" in rule:
            parts.append(self.items(value, rule["items"], path, stack, pending))
        parts = [p for p in parts if p is not None]
        return (parts[0] if len(parts) == 1 else F.concat(*parts)) if parts else None

    def once(self, value: Column, fn) -> Column | None:
        """``fn`` of a value that is computed once, wherever ``fn`` uses it; None if ``fn`` gives that."""
        if not self.depth:
            return fn(value)
        results = []

        def run(x):
            results.append(fn(x))
            return F.array() if results[-1] is None else results[-1]

        whole = F.transform(F.array(value), run)[0]
        return None if results[-1] is None else whole

    def _each(self, values: Column, fn, pending: bool) -> Column | None:
        """The results of ``fn`` over the items and places of an array, one after the other; None if they are always empty."""
        nothing: list[bool] = []

        def run(x, i):
            self.depth += 1
            result = fn(x, i)
            self.depth -= 1
            nothing.append(result is None)
            return F.array() if result is None else result

        results = F.flatten(F.transform(values, run))
        return None if nothing[-1] else F.coalesce(results, F.array().cast(_PENDING if pending else "array<string>"))

    def items(self, value: Column, rule, path: Path, stack: tuple, pending: bool) -> Column | None:
        if not isinstance(rule, dict | bool):
            raise ValueError("items has to be one schema")
        values = F.try_variant_get(value, "$", "array<variant>")
        return self._each(values, lambda x, i: self.walk(x, rule, _item(path, i), stack, pending), pending)

    def others(self, value: Column, rule: dict, more: dict, path: Path, stack: tuple, pending: bool) -> Column | None:
        known = list(rule.get("properties", {}))
        entries = F.map_entries(F.try_variant_get(value, "$", "map<string,variant>"))
        unknown = F.filter(entries, lambda e: ~e["key"].isin(known)) if known else entries
        return self._each(unknown, lambda e, _: self.walk(e["value"], more, _member(path, e["key"]), stack, pending), pending)


def schema_violations(df: DataFrame, body: str, schema: dict, formats: bool = False) -> DataFrame:
    """Add ``violations`` (array of ``path: rule``, such as ``ranges[2].flag: required``) for a JSON text column checked against the schema of one
    record (``items`` of an array schema).

    Malformed JSON gives the single entry ``json``. ``format`` is an annotation unless ``formats`` asks for date-time, date, time and
    uuid to be checked. Keywords that are not known are refused. A schema that refers to itself takes one job per level of nesting.
    """
    item = schema["items"] if schema.get("type") == "array" and "items" in schema else schema
    walk = SchemaWalk(schema, formats)
    empty = F.array().cast("array<string>")
    parsed = df.withColumn("_record", F.try_parse_json(body))
    broken = F.col("_record").isNull()

    def check(rule: dict, node: Column, path: Path) -> tuple[Column, Column | None]:
        messages = walk.walk(node, rule, path, (), False)
        return empty if messages is None else messages, walk.walk(node, rule, path, (), True)

    messages, below = check(item, F.col("_record"), "")
    if not walk.recursive:
        return parsed.withColumn("violations", F.when(broken, F.array(F.lit("json"))).otherwise(messages)).drop("_record")
    nothing = F.array().cast(_PENDING)

    def found_in(level: DataFrame) -> DataFrame:
        return level.select("_row", F.explode("_found").alias("violation"))

    # A round finds what is wrong and what lies below in one pass, and writes both.
    rows = written(parsed.withColumns({
        "_row": F.monotonically_increasing_id(), "_found": F.when(broken, F.array(F.lit("json"))).otherwise(messages),
        "_below": F.when(broken, nothing).otherwise(below)}).drop("_record"), "records")
    level, found = rows, found_in(rows)
    while not level.filter(F.size("_below") > 0).isEmpty():
        frontier, deeper = level.select("_row", F.explode("_below").alias("p")).select("_row", "p.*"), None
        for ref, rule in list(walk.recursive.items()):
            messages, below = check(rule, F.col("node"), F.col("path"))
            here = frontier.filter(F.col("ref") == ref).select("_row", messages.alias("_found"), (nothing if below is None else below).alias("_below"))
            deeper = here if deeper is None else deeper.unionByName(here)
        level = written(deeper, "below")
        found = found.unionByName(found_in(level))
    listed = found.groupBy("_row").agg(F.array_sort(F.collect_list("violation")).alias("violations"))
    return rows.drop("_found", "_below").join(listed, "_row", "left").withColumn("violations", F.coalesce("violations", empty)).drop("_row")


def validate_records(df: DataFrame, body: str, schema: dict, formats: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(valid rows, one row per violation)``."""
    checked = schema_violations(df, body, schema, formats)
    good = checked.filter(F.size("violations") == 0).drop("violations")
    bad = checked.select(*df.columns, F.explode("violations").alias("violation"))
    return good, bad
