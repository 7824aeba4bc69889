"""A JSON schema as checks on VARIANT values.

A schema (the ``parameters`` form of a function call) is walked once, while the
plan is built; out comes one column of violations, evaluated in the scan stage:

- ``missing:<path>``: a required value is not there, or null;
- ``not_<type>:<path>``: a value of another JSON type (a number as a string, an
  object where an array belongs, ...);
- ``enum:<path>``: a text outside the listed ones;
- ``format:<path>``: a text that the ``pattern`` does not match (an empty one is
  a value that was not found, and fits).

Paths are dotted, without array places: every item of an array is checked and a
violation told once. Values stay VARIANT on the way, so a wrong type is told as
such and does not pass for a missing value.
"""
from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: JSON type -> pattern of the type that Spark names for a VARIANT value.
SCALARS = {"string": "^STRING$", "number": r"^(?:BIGINT|DOUBLE|FLOAT|DECIMAL\(.*\))$", "integer": r"^(?:BIGINT|DECIMAL\([0-9]+,0\))$",
           "boolean": "^BOOLEAN$"}
#: JSON type -> the Spark type that its values alone convert to.
NESTED = {"object": "map<string,variant>", "array": "array<variant>"}


def _let(x: Column, use: Callable[[Column], Column]) -> Column:
    """``use(x)`` with ``x`` computed once, however often it is used."""
    return F.get(F.transform(F.array(x), use), F.lit(0))


def _types(rule: dict) -> list[str]:
    t = rule.get("type", [])
    return [t] if isinstance(t, str) else list(t)


def _has_type(v: Column, types: list[str]) -> Column:
    scalars = "|".join(SCALARS[t] for t in types if t in SCALARS)
    # an object or array is known by its conversion: its type would be spelled out from all of it
    found = [F.try_variant_get(v, "$", NESTED[t]).isNotNull() for t in types if t in NESTED]
    if scalars:
        found.append(F.schema_of_variant(v).rlike(scalars))
    return reduce(lambda a, b: a | b, found)


def _value(v: Column, rule: dict, path: str) -> list[Column]:
    """Violations of a value that is there: arrays of strings, null for none."""
    out, types = [], [t for t in _types(rule) if t != "null"]
    if types:
        out.append(F.when(~_has_type(v, types), F.array(F.lit(f"not_{types[0]}:{path or '$'}"))))
    if "enum" in rule:
        listed = [x for x in rule["enum"] if x is not None]
        out.append(F.when(~F.try_variant_get(v, "$", "string").isin(*listed), F.array(F.lit(f"enum:{path}"))))
    if "pattern" in rule:
        out.append(_let(F.try_variant_get(v, "$", "string"), lambda text: F.when(
            (text != "") & ~text.rlike(rule["pattern"]), F.array(F.lit(f"format:{path}")))))
    if "object" in types:
        out.append(F.when(F.try_variant_get(v, "$", NESTED["object"]).isNotNull(), _object(v, rule, path)))
    if "array" in types and rule.get("items"):
        items = F.try_variant_get(v, "$", NESTED["array"])
        found = F.flatten(F.transform(items, lambda item: _joined(_value(item, rule["items"], path))))
        out.append(F.array_distinct(found))
    return out


def _joined(parts: list[Column]) -> Column:
    none = F.array().cast("array<string>")
    return F.concat(none, *(F.coalesce(p, none) for p in parts))


def _object(v: Column, rule: dict, path: str) -> Column:
    def checked(name: str, child: dict) -> Column:
        at = f"{path}.{name}" if path else name

        def of(value: Column) -> Column:
            there = value.isNotNull() & ~F.coalesce(F.is_variant_null(value), F.lit(True))
            missing = F.array().cast("array<string>")
            if name in rule.get("required", ()):
                allowed = value.isNotNull() if "null" in _types(child) else there
                missing = F.when(~allowed, F.array(F.lit(f"missing:{at}"))).otherwise(missing)
            return F.when(there, _joined(_value(value, child, at))).otherwise(missing)

        return _let(F.try_variant_get(v, f"$.{name}", "variant"), of)

    return _joined([checked(n, c) for n, c in rule.get("properties", {}).items()])


#: JSON types of plain schemas: the Spark type, and what no value of the type begins with.
PLAIN = {"string": ("string", r'[^"\s]'), "number": ("double", r"[^-0-9\s]"), "array": (None, r"[^\[\s]")}


def _plain(rule: dict, kinds: dict[str, str]) -> str | None:
    """Spark type of an object of texts, numbers and arrays of such objects, its
    names put into ``kinds``; None for any other schema, and where a name stands
    for values of two types."""
    fields = []
    for name, child in rule.get("properties", {}).items():
        kind = child.get("type")
        if kind not in PLAIN or not re.fullmatch("[A-Za-z_]+", name) or kinds.setdefault(name, kind) != kind:
            return None
        of = PLAIN[kind][0]
        if kind == "array":
            item = child.get("items") or {}
            inner = _plain(item, kinds) if item.get("type") == "object" else None
            if inner is None or {"enum", "pattern"} & {*child, *item}:
                return None
            of = f"array<{inner}>"
        fields.append(f"{name}: {of}")
    return f"struct<{', '.join(fields)}>" if fields else None


def _wrong_start(kinds: dict[str, str]) -> str:
    """Pattern of a name whose value begins as none of its type does (null too)."""
    found = []
    for kind, (_, start) in PLAIN.items():
        names: dict[str, list[str]] = {}
        for n in sorted(n for n, k in kinds.items() if k == kind):
            names.setdefault(n[0], []).append(n[1:])
        if names:
            found.append("(?:" + "|".join(f"{first}(?:{'|'.join(rest)})" for first, rest in names.items()) + rf')"\s*+:\s*+{start}')
    return f'"(?=[{"".join(sorted({n[0] for n in kinds}))}])(?:{"|".join(found)})'


def _fits(d: Column, rule: dict) -> Column:
    """Whether a parsed object has what is required, and listed and formatted texts fit."""
    tests = [d.isNotNull()]

    def all_fit(items: Column, of: dict) -> Column:
        return F.forall(items, lambda item: _fits(item, of))

    for name, child in rule["properties"].items():
        value = d[name]
        if name in rule.get("required", ()):
            tests.append(value.isNotNull())
        if "enum" in child:
            tests.append(value.isNull() | value.isin(*[x for x in child["enum"] if x is not None]))
        if "pattern" in child:
            tests.append(value.isNull() | (value == "") | value.rlike(child["pattern"]))
        if child["type"] == "array":
            tests.append(value.isNull() | all_fit(value, child["items"]))
    return reduce(lambda a, b: a & b, tests)


def _sound(json: Column, schema: dict) -> Column | None:
    """A test that only JSON records without violations pass (records with codes for
    letters or nulls may fail it too), far cheaper than to find the violations: one
    search of the text shows that values are of their types, one parse the rest."""
    kinds: dict[str, str] = {}
    parsed = _plain(schema, kinds)
    if parsed is None:
        return None
    # a name could be written with codes for its letters
    spelled_out = ~json.contains("\\u00") | ~json.rlike(r"\\u00[3-7]")
    # an array of one record would be parsed as the record
    fits = _let(F.from_json(json, parsed), lambda d: F.coalesce(_fits(d, schema), F.lit(False)))
    return json.rlike(r"^\s*+\{") & spelled_out & ~json.rlike(_wrong_start(kinds)) & fits


def violations(json: Column, schema: dict) -> Column:
    """Sorted array of what a JSON text breaks of a schema; a text that is no
    JSON (or null) has the one violation ``malformed_json``, one that is not an
    object ``not_object:$``."""
    def of(v: Column) -> Column:
        found, sound = F.when(v.isNull(), F.array(F.lit("malformed_json"))), _sound(json, schema)
        if sound is not None:
            found = found.when(sound, F.array().cast("array<string>"))
        return found.otherwise(F.array_sort(_joined(_value(v, {"type": "object", **schema}, ""))))

    return _let(F.try_parse_json(json), of)
