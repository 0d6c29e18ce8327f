"""JSON Schema (draft 2020-12) as checks: of whole documents, and of tables row by row.

Keywords: type, enum, const, required, properties, additionalProperties,
patternProperties, propertyNames, items, prefixItems, minItems, maxItems, uniqueItems,
contains, minProperties, maxProperties, minLength, maxLength, pattern, minimum, maximum,
exclusiveMinimum, exclusiveMaximum, multipleOf, allOf, anyOf, oneOf, not, if/then/else,
and $ref into the same document. Others are refused, never passed over.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_NOTES = {"$schema", "$id", "$defs", "$comment", "title", "description", "default", "examples", "deprecated", "format"}
_TYPES = {"null": type(None), "boolean": bool, "string": str, "array": list, "object": dict}
_BOUNDS = {
    "minimum": (lambda v, b: v >= b), "maximum": (lambda v, b: v <= b), "exclusiveMinimum": (lambda v, b: v > b), "exclusiveMaximum": (lambda v, b: v < b),
    "multipleOf": (lambda v, b: Fraction(str(v)) % Fraction(str(b)) == 0),
}
_SIZES = {"minLength": (str, 1), "maxLength": (str, -1), "minItems": (list, 1), "maxItems": (list, -1), "minProperties": (dict, 1), "maxProperties": (dict, -1)}
_KNOWN = _NOTES | {*_BOUNDS, *_SIZES} | {"type", "enum", "const", "required", "properties", "additionalProperties", "patternProperties", "propertyNames", "items", "prefixItems", "uniqueItems", "contains", "pattern", "allOf", "anyOf", "oneOf", "not", "if", "then", "else", "$ref"}


def _number(value) -> bool:
    return isinstance(value, (int, float)) and not isinstance(value, bool)


def _is(value, kind: str) -> bool:
    if kind == "number":
        return _number(value)
    if kind == "integer":
        return _number(value) and float(value).is_integer()
    return isinstance(value, _TYPES[kind])


def _same(value) -> str:
    """Equal JSON values have equal text; numbers by value, true not 1."""
    if _number(value):
        return str(Fraction(str(value)))
    if isinstance(value, list):
        return "[" + ",".join(map(_same, value)) + "]"
    if isinstance(value, dict):
        return "{" + ",".join(f"{json.dumps(k)}:{_same(v)}" for k, v in sorted(value.items())) + "}"
    return json.dumps(value)


def violations(value, schema: dict | bool, root: dict | None = None, at: str = "") -> Iterator[tuple[str, str]]:
    """(path, what is wrong) for everything in ``value`` that breaks the schema."""
    root = schema if root is None else root
    if isinstance(schema, bool):
        if not schema:
            yield at, "nothing is allowed here"
        return
    if unknown := set(schema) - _KNOWN:
        raise ValueError(f"keywords that are not supported: {sorted(unknown)}")
    ok = lambda s, v=value: next(violations(v, s, root, at), None) is None
    if "$ref" in schema:
        target = root
        for part in schema["$ref"].removeprefix("#").strip("/").split("/"):
            target = target[part.replace("~1", "/").replace("~0", "~")] if part else target
        yield from violations(value, target, root, at)
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_is(value, k) for k in kinds):
        yield at, f"not of type {' or '.join(kinds)}"
        return
    if "enum" in schema and _same(value) not in map(_same, schema["enum"]):
        yield at, "not one of the allowed values"
    if "const" in schema and _same(value) != _same(schema["const"]):
        yield at, "not the required value"
    for name, (kind, sign) in _SIZES.items():
        if name in schema and isinstance(value, kind) and sign * len(value) < sign * schema[name]:
            yield at, f"breaks {name} {schema[name]}"
    if _number(value):
        yield from ((at, f"breaks {name} {schema[name]}") for name, holds in _BOUNDS.items() if name in schema and not holds(value, schema[name]))
    if isinstance(value, str) and "pattern" in schema and not re.search(schema["pattern"], value):
        yield at, f"does not match {schema['pattern']}"
    if isinstance(value, list):
        first = schema.get("prefixItems", [])
        for i, v in enumerate(value):
            rule = first[i] if i < len(first) else schema.get("items", True)
            yield from violations(v, rule, root, f"{at}/{i}")
        if schema.get("uniqueItems") and len(set(map(_same, value))) < len(value):
            yield at, "has equal items"
        if "contains" in schema and not any(ok(schema["contains"], v) for v in value):
            yield at, "has no item of the required kind"
    if isinstance(value, dict):
        yield from ((at, f"lacks {name}") for name in schema.get("required", []) if name not in value)
        named, matched = schema.get("properties", {}), schema.get("patternProperties", {})
        for k, v in value.items():
            rules = [named[k]] if k in named else []
            rules += [r for p, r in matched.items() if re.search(p, k)]
            for rule in rules or [schema.get("additionalProperties", True)]:
                yield from violations(v, rule, root, f"{at}/{k}")
            if "propertyNames" in schema:
                yield from violations(k, schema["propertyNames"], root, f"{at}/{k}")
    for rule in schema.get("allOf", []):
        yield from violations(value, rule, root, at)
    if "anyOf" in schema and not any(map(ok, schema["anyOf"])):
        yield at, "fits none of the choices"
    if "oneOf" in schema and sum(map(ok, schema["oneOf"])) != 1:
        yield at, "does not fit exactly one of the choices"
    if "not" in schema and ok(schema["not"]):
        yield at, "is of a kind that is not allowed"
    if "if" in schema:
        yield from violations(value, schema.get("then" if ok(schema["if"]) else "else", True), root, at)


def row_violations(rows: DataFrame, schema: dict, key: str) -> DataFrame:
    """(key, field, rule): rows of a table that break the schema of an object, by Catalyst
    expressions: required, enum, const, pattern, lengths and bounds of its own fields."""
    checks: list[Column] = []
    required = set(schema.get("required", []))
    columns = set(rows.columns)
    if absent := required - columns:
        raise ValueError(f"columns that the schema requires are absent: {sorted(absent)}")
    if schema.get("additionalProperties") is False and (more := columns - set(schema["properties"]) - {key}):
        raise ValueError(f"columns that the schema does not have: {sorted(more)}")

    def put(name: str, rule: str, broken: Column) -> None:
        checks.append(F.when(F.coalesce(broken, F.lit(False)), F.struct(F.lit(name).alias("field"), F.lit(rule).alias("rule"))))

    for name, rule in schema["properties"].items():
        if name not in columns:
            continue
        c = F.col(f"`{name}`")
        if name in required and "null" not in str(rule.get("type")):
            put(name, "required", c.isNull())
        if "enum" in rule:
            put(name, "enum", ~c.isin(*[v for v in rule["enum"] if v is not None]))
        if "const" in rule:
            put(name, "const", c != F.lit(rule["const"]))
        if "pattern" in rule:
            put(name, "pattern", ~c.rlike(rule["pattern"]))
        for bound, broken in {"minimum": lambda b, c=c: c < b, "maximum": lambda b, c=c: c > b, "exclusiveMinimum": lambda b, c=c: c <= b, "exclusiveMaximum": lambda b, c=c: c >= b, "minLength": lambda b, c=c: F.length(c) < b, "maxLength": lambda b, c=c: F.length(c) > b, "minItems": lambda b, c=c: F.size(c) < b, "maxItems": lambda b, c=c: F.size(c) > b}.items():
            if bound in rule:
                put(name, bound, broken(rule[bound]))
        if rule.get("uniqueItems"):
            put(name, "uniqueItems", F.size(F.array_distinct(c)) < F.size(c))
    return rows.select(key, F.explode(F.array_compact(F.array(*checks))).alias("v")).select(key, "v.field", "v.rule")
