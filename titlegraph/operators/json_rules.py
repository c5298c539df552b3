"""JSON Schema as a column: the errors of JSON values, with built-in functions over VARIANT only.

A schema is compiled once, on the driver, to an expression over the column; no row reaches Python, and nothing is shuffled.
Rules: type, const, enum, pattern, minLength, maxLength, minimum, maximum, required, properties, additionalProperties
(false), items, minItems, maxItems, uniqueItems, $ref to #/$defs, allOf, and if (const properties, required) with then.
Others, such as format and descriptions, are annotations here.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_RULES = {"type", "const", "enum", "pattern", "minLength", "maxLength", "minimum", "maximum", "required", "properties", "additionalProperties", "items", "minItems", "maxItems", "uniqueItems", "$ref", "allOf", "if", "then"}
_NOTES = {"$schema", "$id", "$defs", "$comment", "title", "description", "default", "examples", "format", "deprecated"}


def none() -> Column:
    return F.array().cast("array<string>")


def value_of(v: Column, name: str) -> Column:
    """A field's VARIANT; null if there is none, or v is no object."""
    return F.try_variant_get(v, "$['" + name.replace("\\", "\\\\").replace("'", "\\'") + "']", "variant")


def text_of(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def items_of(v: Column) -> Column:
    """An array's items; null for what is no array."""
    return F.try_variant_get(v, "$", "array<variant>")


def keys_of(v: Column) -> Column:
    """An object's field names, in alphabetical order; null for what is no object."""
    return F.map_keys(F.try_variant_get(v, "$", "map<string,variant>"))


def is_null(v: Column) -> Column:
    """Absent, or null."""
    return v.isNull() | F.is_variant_null(v)


def _kind(v: Column) -> Column:
    """VOID, BOOLEAN, BIGINT, DECIMAL(p,s), DOUBLE, STRING, ARRAY<...> or OBJECT<...>."""
    return F.schema_of_variant(v)


def is_text(v: Column) -> Column:
    return F.coalesce(_kind(v) == "STRING", F.lit(False))


def is_array(v: Column) -> Column:
    return F.coalesce(F.startswith(_kind(v), F.lit("ARRAY")), F.lit(False))


def is_object(v: Column) -> Column:
    return F.coalesce(F.startswith(_kind(v), F.lit("OBJECT")), F.lit(False))


def is_type(v: Column, name: str) -> Column:
    if name == "integer":
        number = F.try_variant_get(v, "$", "double")
        return is_type(v, "number") & F.coalesce(number == F.floor(number), F.lit(False))
    kinds = {"string": "STRING", "object": "OBJECT", "array": "ARRAY", "boolean": "BOOLEAN", "null": "VOID", "number": "^(BIGINT|INT|SMALLINT|TINYINT|DECIMAL|DOUBLE|FLOAT)"}
    return F.coalesce(_kind(v).rlike(kinds[name]) if name == "number" else F.startswith(_kind(v), F.lit(kinds[name])), F.lit(False))


def equals(v: Column, wanted: Any) -> Column:
    """Whether v is the JSON value wanted; numbers by value."""
    if isinstance(wanted, bool) or not isinstance(wanted, (int, float)):
        return F.coalesce(F.to_json(v) == F.to_json(F.parse_json(F.lit(json.dumps(wanted)))), F.lit(False))
    return is_type(v, "number") & F.coalesce(F.try_variant_get(v, "$", "double") == float(wanted), F.lit(False))


def say(wrong: Column, *message: str | Column) -> Column:
    """One message if it is wrong, else none."""
    return F.when(wrong, F.array(F.concat(*[F.lit(m) if isinstance(m, str) else m for m in message]))).otherwise(none())


def all_of(*errors: Column) -> Column:
    return F.concat(*errors) if errors else none()


def each(v: Column, check, path: Column) -> Column:
    """check(item, path[i]) of every item of an array."""
    return F.flatten(F.transform(items_of(v), lambda x, i: check(x, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")))))


def compile_schema(v: Column, schema: dict, path: Column | str = "$", root: dict | None = None) -> Column:
    """array<string> of the errors of the VARIANT v, in the schema's order; empty if it is valid. An absent v has none."""
    root = root if root is not None else schema
    path = F.lit(path) if isinstance(path, str) else path
    unknown = set(schema) - _RULES - _NOTES
    if unknown:
        raise ValueError(f"rules that are not known: {sorted(unknown)}")
    found = []
    if "$ref" in schema:
        target: Any = root
        for part in schema["$ref"].removeprefix("#/").split("/"):
            target = target[part]
        found.append(compile_schema(v, target, path, root))
    if "type" in schema:
        kinds = [schema["type"]] if isinstance(schema["type"], str) else schema["type"]
        fits = F.lit(False)
        for k in kinds:
            fits = fits | is_type(v, k)
        found.append(say(~fits, path, f" must be of type {' or '.join(kinds)}"))
    if "const" in schema:
        found.append(say(~equals(v, schema["const"]), path, f" must be {json.dumps(schema['const'], ensure_ascii=False)}"))
    if "enum" in schema:
        fits = F.lit(False)
        for x in schema["enum"]:
            fits = fits | equals(v, x)
        found.append(say(~fits, path, f" must be one of {json.dumps(schema['enum'], ensure_ascii=False)}"))
    text, number, size = text_of(v), F.try_variant_get(v, "$", "double"), F.size(items_of(v))
    if "pattern" in schema:
        found.append(say(is_text(v) & ~text.rlike(schema["pattern"]), path, f" must match {schema['pattern']}"))
    for rule, wrong, what in (
        ("minLength", lambda n: is_text(v) & (F.length(text) < n), "must have at least {} characters"),
        ("maxLength", lambda n: is_text(v) & (F.length(text) > n), "must have at most {} characters"),
        ("minimum", lambda n: is_type(v, "number") & (number < n), "must be at least {}"),
        ("maximum", lambda n: is_type(v, "number") & (number > n), "must be at most {}"),
        ("minItems", lambda n: is_array(v) & (size < n), "must have at least {} items"),
        ("maxItems", lambda n: is_array(v) & (size > n), "must have at most {} items"),
    ):
        if rule in schema:
            found.append(say(wrong(schema[rule]), path, " " + what.format(schema[rule])))
    if schema.get("uniqueItems"):
        texts = F.transform(items_of(v), lambda x: F.to_json(x))
        found.append(say(is_array(v) & (F.size(F.array_distinct(texts)) < F.size(texts)), path, " must have unique items"))
    if schema.get("additionalProperties") is False:
        own = F.filter(keys_of(v), lambda k: ~k.isin(list(schema.get("properties", {}))))
        found.append(F.when(is_object(v), F.transform(own, lambda k: F.concat(path, F.lit("."), k, F.lit(" is not allowed")))).otherwise(none()))
    for name in schema.get("required", []):
        found.append(say(is_object(v) & value_of(v, name).isNull(), path, f".{name} is required"))
    for name, rule in schema.get("properties", {}).items():
        found.append(compile_schema(value_of(v, name), rule, F.concat(path, F.lit(f".{name}")), root))
    if "items" in schema:
        found.append(F.when(is_array(v), each(v, lambda x, p: compile_schema(x, schema["items"], p, root), path)).otherwise(none()))
    for rule in schema.get("allOf", []):
        found.append(compile_schema(v, rule, path, root))
    if "if" in schema:
        holds = F.lit(True)
        for name, rule in schema["if"].get("properties", {}).items():
            holds = holds & (value_of(v, name).isNull() | equals(value_of(v, name), rule["const"]))
        for name in schema["if"].get("required", []):
            holds = holds & value_of(v, name).isNotNull()
        found.append(F.when(holds, compile_schema(v, schema.get("then", {}), path, root)).otherwise(none()))
    return F.when(v.isNull(), none()).otherwise(all_of(*found))


def schema_errors(raw: Column, schema: dict, path: str = "$") -> Column:
    """The errors of JSON text: not JSON (also null, and fields told twice), or those of compile_schema()."""
    v = F.try_parse_json(raw)
    return F.when(v.isNull(), F.array(F.lit(f"{path} is not JSON"))).otherwise(compile_schema(v, schema, path))


def with_errors(rows: DataFrame, raw_col: str, schema: dict, path: str = "$") -> DataFrame:
    """rows with errors, those of schema_errors(), each text parsed once: a generator ends what may be merged above it."""
    v = F.col("__v")
    errors = F.when(v.isNull(), F.array(F.lit(f"{path} is not JSON"))).otherwise(compile_schema(v, schema, path))
    return rows.withColumn("__v", F.explode(F.array(F.try_parse_json(F.col(raw_col))))).withColumn("errors", errors).drop("__v")
