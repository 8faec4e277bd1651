"""A JSON schema compiled to one Column of checks over VARIANT documents, and to Spark types.

The document tree is walked once, when the plan is made; at run time there are only built-in expressions. Supported:
type, enum, required, properties, additionalProperties, propertyNames (enum), items, minimum, maximum and
references to ``#/$defs``. An unknown keyword raises, so that no check is left out unseen.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, DecimalType, DoubleType, FloatType, IntegralType, LongType, MapType, StringType, StructField, StructType

from tessera.functions.text import let

Schema = dict[str, Any]
_CHECKED = {"type", "enum", "required", "properties", "additionalProperties", "propertyNames", "items", "minimum", "maximum", "$ref"}
_SAID = {"$schema", "$defs", "title", "description", "default"}
_ATOMS: dict[str, type[DataType]] = {"number": DoubleType, "integer": LongType, "boolean": BooleanType, "string": StringType}


def kind(value: Column) -> Column:
    """object, array, string, boolean, null, integer or number (with a fraction); null for a value that is absent."""
    numeric = F.when(F.try_variant_get(value, "$", "double") % 1 == 0, "integer").otherwise("number")
    return let(F.schema_of_variant(value), lambda shape: (
        F.when(shape.startswith("OBJECT"), "object").when(shape.startswith("ARRAY"), "array").when(shape == "STRING", "string")
        .when(shape == "BOOLEAN", "boolean").when(shape == "VOID", "null").when(shape.isNotNull(), numeric)
    ))


def members(value: Column) -> Column:
    """The members of an object by name; null for any other value."""
    return value.try_cast("map<string,variant>")


def elements(value: Column) -> Column:
    return value.try_cast("array<variant>")


def _resolved(schema: Schema, root: Schema) -> Schema:
    while "$ref" in schema:
        head, *steps = schema["$ref"].split("/")
        if head != "#":
            raise ValueError(f"a reference out of the document: {schema['$ref']}")
        schema = root
        for step in steps:
            schema = schema[step]
    unknown = schema.keys() - _CHECKED - _SAID
    if unknown:
        raise ValueError(f"not supported: {sorted(unknown)}")
    return schema


def _types(schema: Schema) -> list[str]:
    kinds = schema.get("type", [])
    return [kinds] if isinstance(kinds, str) else list(kinds)


def struct_of(schema: Schema, root: Schema | None = None) -> DataType:
    """The Spark type of valid documents: objects with properties are structs, others maps."""
    root = root or schema
    schema = _resolved(schema, root)
    of = next((x for x in _types(schema) if x != "null"), "string")
    if of == "array":
        return ArrayType(struct_of(schema["items"], root))
    if of != "object":
        return _ATOMS[of]()
    if schema.get("properties"):
        return StructType([StructField(name, struct_of(part, root)) for name, part in schema["properties"].items()])
    more = schema.get("additionalProperties")
    return MapType(StringType(), struct_of(more, root) if isinstance(more, dict) else StringType())


def _child(path: Column | str, name: Column | str) -> Column | str:
    """The path of a member; a text while all of it is known when the plan is made."""
    if isinstance(path, str) and isinstance(name, str):
        return f"{path}.{name}" if path else name
    name = F.lit(name) if isinstance(name, str) else name
    return name if isinstance(path, str) and not path else F.concat(F.lit(path) if isinstance(path, str) else path, F.lit("."), name)


def _said(path: Column | str, what: str) -> Column:
    return F.lit(f"{path or 'document'}: {what}") if isinstance(path, str) else F.concat(path, F.lit(f": {what}"))


def _if(test: Column, error: Column) -> Column:
    return F.when(test, F.array(error)).otherwise(F.array().cast("array<string>"))


def _values(value: Column, own: Column, schema: Schema, path: Column | str) -> list[Column]:
    out = []
    if kinds := _types(schema):
        out.append(_if(~own.isin(*kinds, *(["integer"] if "number" in kinds else [])), _said(path, "type")))
    if "enum" in schema:
        texts = [x for x in schema["enum"] if isinstance(x, str)]
        if any(x is not None and not isinstance(x, str) for x in schema["enum"]):
            raise ValueError("only texts and null are supported in enum")
        good = (own == "string") & F.try_variant_get(value, "$", "string").isin(*texts)
        out.append(_if(~(good | (own == "null") if None in schema["enum"] else good), _said(path, "not allowed")))
    number = F.try_variant_get(value, "$", "double")
    for word, wrong in (("minimum", lambda x: number < x), ("maximum", lambda x: number > x)):
        if word in schema:
            out.append(_if(own.isin("integer", "number") & wrong(float(schema[word])), _said(path, word)))
    return out


def _errors(value: Column, schema: Schema, root: Schema, path: Column | str) -> Column:
    schema = _resolved(schema, root)

    def of_object(held: Column) -> Column:
        out = [_if(~F.map_contains_key(held, F.lit(name)), _said(_child(path, name), "required")) for name in schema.get("required", [])]
        known = schema.get("properties", {})
        for name, part in known.items():
            member = F.try_element_at(held, F.lit(name))
            out.append(F.when(F.map_contains_key(held, F.lit(name)), _errors(member, part, root, _child(path, name))).otherwise(F.array()))
        names = F.filter(F.map_keys(held), lambda k: ~k.isin(*known)) if known else F.map_keys(held)
        more = schema.get("additionalProperties", True)
        if more is False:
            out.append(F.transform(names, lambda k: _said(_child(path, k), "not expected")))
        elif isinstance(more, dict):
            out.append(F.flatten(F.transform(names, lambda k: _errors(F.try_element_at(held, k), more, root, _child(path, k)))))
        if "propertyNames" in schema:
            out.append(F.transform(F.filter(F.map_keys(held), lambda k: ~k.isin(*schema["propertyNames"]["enum"])), lambda k: _said(_child(path, k), "name not allowed")))
        return F.concat(*out) if out else F.array().cast("array<string>")

    def of_array(held: Column) -> Column:
        at = F.lit(path) if isinstance(path, str) else path
        return F.flatten(F.transform(held, lambda x, i: _errors(x, schema["items"], root, F.concat(at, F.lit("["), i.cast("string"), F.lit("]")))))

    parts = [let(kind(value), lambda own: F.concat(F.array().cast("array<string>"), *_values(value, own, schema, path)))]
    none = F.array().cast("array<string>")
    if {"required", "properties", "additionalProperties", "propertyNames"} & schema.keys():
        parts.append(F.coalesce(let(members(value), of_object), none))
    if "items" in schema:
        parts.append(F.coalesce(let(elements(value), of_array), none))
    return F.concat(*parts)


def errors(document: Column, schema: Schema) -> Column:
    """The checks that a VARIANT document fails as ``path: rule``, sorted; none for a valid one, null for a null document."""
    return F.when(document.isNotNull(), F.array_sort(_errors(document, schema, schema, "")))


# --- typed records -------------------------------------------------------------------------------------------------


def _kinds(of: DataType) -> set[str]:
    if isinstance(of, (StructType, MapType)):
        return {"object"}
    if isinstance(of, ArrayType):
        return {"array"}
    if isinstance(of, (StringType, BooleanType)):
        return {"string"} if isinstance(of, StringType) else {"boolean"}
    return {"number"} if isinstance(of, (DoubleType, FloatType, DecimalType)) else {"integer", "number"} if isinstance(of, IntegralType) else set()


class _Record:
    """The checks of a typed value: those of known paths as texts that may be null, those of lists and maps as arrays."""

    def __init__(self, root: Schema) -> None:
        self.root, self.one, self.many = root, [], []

    def check(self, value: Column, of: DataType, schema: Schema, path: Column | str) -> None:
        """A null value is absent, so its type is known when the plan is made and its other checks are plain comparisons."""
        schema = _resolved(schema, self.root)
        there, kinds, allowed = value.isNotNull(), _kinds(of), set(_types(schema))
        if allowed and not kinds & allowed:
            whole = "integer" in allowed and kinds == {"number"}
            self.one.append(F.when(value % 1 != 0 if whole else there, _said(path, "type")))
        if "enum" in schema:
            texts = [x for x in schema["enum"] if isinstance(x, str)]
            self.one.append(F.when(~value.isin(*texts) if kinds == {"string"} else there, _said(path, "not allowed")))
        for word, wrong in (("minimum", lambda x: value < x), ("maximum", lambda x: value > x)):
            if word in schema and "number" in kinds:
                self.one.append(F.when(wrong(float(schema[word])), _said(path, word)))
        if isinstance(of, StructType):
            self._struct(value, of, schema, path)
        elif isinstance(of, MapType):
            self._map(value, of, schema, path)
        elif isinstance(of, ArrayType) and "items" in schema:
            at = F.lit(path) if isinstance(path, str) else path
            self._each(value, lambda x, i: _record(x, of.elementType, schema["items"], self.root, F.concat(at, F.lit("["), i.cast("string"), F.lit("]")), True))

    def _struct(self, value: Column, of: StructType, schema: Schema, path: Column | str) -> None:
        known, more = schema.get("properties", {}), schema.get("additionalProperties", True)
        held = {f.name: f.dataType for f in of.fields}
        for name in schema.get("required", []):
            lacks = value.isNotNull() & value[name].isNull() if name in held else value.isNotNull()
            self.one.append(F.when(lacks, _said(_child(path, name), "required")))
        for name, kind_ in held.items():
            if name in known:
                self.check(value[name], kind_, known[name], _child(path, name))
            elif more is False:
                self.one.append(F.when(value[name].isNotNull(), _said(_child(path, name), "not expected")))
            elif isinstance(more, dict):
                self.check(value[name], kind_, more, _child(path, name))

    def _map(self, value: Column, of: MapType, schema: Schema, path: Column | str) -> None:
        more = schema.get("additionalProperties", True)
        if isinstance(more, dict):
            self._each(F.map_entries(value), lambda e, _: _record(e["value"], of.valueType, more, self.root, _child(path, e["key"]), True))
        if "propertyNames" in schema:
            wrong = F.filter(F.map_keys(value), lambda k: ~k.isin(*schema["propertyNames"]["enum"]))
            self.many.append(F.transform(wrong, lambda k: _said(_child(path, k), "name not allowed")))

    def _each(self, held: Column, checks) -> None:
        self.many.append(F.flatten(F.transform(held, checks)))

    def errors(self) -> Column:
        none = F.array().cast("array<string>")
        return F.concat(F.filter(F.array(*self.one), lambda e: e.isNotNull()) if self.one else none, *[F.coalesce(x, none) for x in self.many])


def _record(value: Column, of: DataType, schema: Schema, root: Schema, path: Column | str, element: bool = False) -> Column:
    checks = _Record(root)
    checks.check(value, of, schema, path)
    out = checks.errors()
    if not element:
        return out
    # a list holds its nulls, a document leaves its null fields out
    own = _resolved(schema, root)
    refused = [_said(path, "not allowed")] * (None not in own.get("enum", [None])) + [_said(path, "type")] * ("null" not in _types(own))
    return F.when(value.isNull(), F.array(*refused).cast("array<string>")).otherwise(out)


def record_errors(record: Column, of: StructType, schema: Schema) -> Column:
    """What ``errors`` tells of the document that a typed record is published as, in which null fields are left out.

    Types and names are compared when the plan is made; what is left for run time are comparisons of fields.
    """
    return F.when(record.isNotNull(), F.array_sort(_record(record, of, schema, schema, "")))
